"""Packing of tokenized documents into sequences: shortest-pack-first over the histogram of piece lengths.

Documents are tokenized and cut into pieces of at most ``max_len`` ids.  The histogram of piece lengths (at most
``max_len`` rows) goes to the driver, which places lengths longest first, each on the shortest packs that still
have room, and keeps only counts of packing patterns.  Patterns are joined back by the rank of a piece among
the pieces of its length.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lastro.llm.text import text_of
from lastro.session import stored

MAX_LEN = 2048
END_ID = 1
#: Pieces of one length that are ranked in one window.
RANKED_TOGETHER = 50_000
_KNOWN_CHUNKS = 1 << 18
#: White space before a space that more white space or nothing follows: there, a cut at spaces would tear one token.
_TORN = re.compile(r"\s (?:\s|\Z)")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@cache
def _encoding(path: str) -> tiktoken.Encoding:
    """The vocabulary of a byte-level BPE file, read from the rank file beside it, which is the faster to apply."""
    import public_tokenizers

    with open(path.removesuffix(".json") + ".tiktoken", "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Ids of a text.  Strings of special tokens in it are ordinary text.

    The splitting pattern of the vocabulary never joins a space to what stands before it, so a text can be cut
    before single spaces; most chunks are then known from before.
    """

    def __init__(self, path: str) -> None:
        self.whole = _encoding(path).encode_ordinary
        self.known: dict[str, list[int]] = {}

    def __call__(self, text: str) -> list[int]:
        if _TORN.search(text):
            return self.whole(text)
        first, *chunks = text.split(" ")
        ids, known, whole = self.whole(first), self.known, self.whole
        for chunk in chunks:
            found = known.get(chunk)
            if found is None:
                if len(known) >= _KNOWN_CHUNKS:
                    known.clear()
                found = known[chunk] = whole(" " + chunk)
            ids += found
        return ids


@cache
def added_tokens(path: str) -> dict[str, int]:
    """Strings that the vocabulary file maps to one id each wherever a text holds them."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    for token in added:
        if token["single_word"] or token["lstrip"] or token["rstrip"]:
            raise ValueError(f"added token with conditions on its surroundings: {token}")
    return {token["content"]: token["id"] for token in added if token["content"]}


class Tokenizer:
    """Ids of a text as ``tokenizers`` gives them by default without adding any: the first and longest added tokens
    in it are ids of their own, and the stretches between them are encoded each by itself."""

    def __init__(self, path: str) -> None:
        self.encode, self.added = Encoder(path), added_tokens(path)
        longest_first = sorted(self.added, key=len, reverse=True)
        self.pattern = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.added else None

    def __call__(self, text: str) -> list[int]:
        if self.pattern is None or self.pattern.search(text) is None:
            return self.encode(text)
        ids: list[int] = []
        for i, part in enumerate(self.pattern.split(text)):
            ids += [self.added[part]] if i % 2 else self.encode(part)
        return ids


def _pieces(path: str, max_len: int, end_id: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Tokenizer(path)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for at in range(0, batch.num_rows, 256):
                of, start, length, crc, total = [], [], [], [], []
                for i in range(at, min(at + 256, batch.num_rows)):
                    tokens = np.array(encode(texts[i].as_py()) + [end_id], "<u4")
                    for begin in range(0, len(tokens), max_len):
                        piece = tokens[begin : begin + max_len]
                        of.append(i)
                        start.append(begin)
                        length.append(len(piece))
                        crc.append(zlib.crc32(piece.tobytes()))
                        total.append(len(tokens))
                columns = [ids.take(pa.array(of, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
                yield pa.RecordBatch.from_arrays(columns, ["id", "start", "length", "ids_crc32", "doc_tokens"])

    return cut


def patterns(histogram: dict[int, int], max_len: int = MAX_LEN) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in one sequence) with their counts.

    At most two new entries arise for each length, so that the size of the plan depends on ``max_len`` only.
    """
    packs: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            used = min((u for u, held in packs.items() if held and u + length <= max_len), default=None)
            if used is None:
                packs[length].append(((length,), left))
                break
            pattern, count = packs[used].pop()
            taken = min(left, count)
            if count > taken:
                packs[used].append((pattern, count - taken))
            packs[used + length].append(((*pattern, length), taken))
            left -= taken
    return [entry for used in sorted(packs) for entry in packs[used]]


def slots(plan: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, list[tuple[int, int, int, int]]]]:
    """Per length: ranges of ranks (from, to), the first sequence of the range and the offset in it."""
    ranges: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    ranked: dict[int, int] = defaultdict(int)
    sequence = 0
    for pattern, count in plan:
        offset = 0
        for length in pattern:
            ranges[length].append((ranked[length], ranked[length] + count, sequence, offset))
            ranked[length] += count
            offset += length
        sequence += count
    return sorted(ranges.items())


def pack(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    path: str | None = None,
    max_len: int = MAX_LEN,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    A null or empty text is the end id alone.  Longer documents are cut every ``max_len`` ids.  Null ids and
    repeated rows are packed like any others; an empty table gives no rows.  Other columns are ignored.
    Added tokens of the vocabulary, such as ``<|endoftext|>``, are ids of their own where a text holds their strings.
    ``path`` is the vocabulary file, on every executor; a rank file of the same name lies beside it.
    """
    spark, id_type = docs.sparkSession, docs.schema[id_column].dataType.simpleString()
    texts = docs.select(docs[id_column].alias("id"), text_of(docs[text_column]).alias("text"))
    shape = f"id {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    pieces = stored(texts.mapInArrow(_pieces(path or tokenizer_path(), max_len, end_id), shape), "pieces")

    histogram = dict(map(tuple, pieces.groupBy("length").count().collect()))  # max_len rows at most
    chunks = max(histogram.values(), default=0) // RANKED_TOGETHER + 1
    pieces = pieces.withColumn("chunk", F.pmod(F.xxhash64("id", "start"), F.lit(chunks)))
    before = pieces.groupBy("length", "chunk").count().select(
        F.col("length").alias("length_"), F.col("chunk").alias("chunk_"),
        (F.sum("count").over(Window.partitionBy("length").orderBy("chunk")) - F.col("count")).alias("before"),
    )
    place = F.row_number().over(Window.partitionBy("length", "chunk").orderBy("id", "start", "ids_crc32"))
    ranked = pieces.withColumn("place", place - 1).join(
        before, (F.col("length") == F.col("length_")) & (F.col("chunk") == F.col("chunk_"))
    ).withColumn("rank", F.col("place") + F.col("before"))
    ranges = spark.createDataFrame(
        slots(patterns(histogram, max_len)),
        "of bigint, ranges array<struct<from: bigint, to: bigint, sequence: bigint, offset: bigint>>",
    )
    # Bounded by max_len, whatever the number of documents.
    found = ranked.join(F.broadcast(ranges), F.col("length") == F.col("of")).withColumn(
        "slot", F.expr("filter(ranges, x -> rank >= x.from AND rank < x.to)[0]")
    )
    return found.select(
        F.col("id").alias(id_column), "start", "length", "ids_crc32", "doc_tokens",
        (F.col("slot.sequence") + F.col("rank") - F.col("slot.from")).alias("sequence_id"),
        F.col("slot.offset").alias("offset"),
    )
