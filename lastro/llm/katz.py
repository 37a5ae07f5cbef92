"""Katz backoff model of n-grams: Good-Turing discounts, exactly normalised backoff weights, scores of whole texts.

    P(w)       = d1(c) / N                for words seen in training, c = c(w)
    P(unknown) = what the discounts leave
    Pk(w | h)  = dk(c) / c(h)             for a seen k-gram, c = c(h w)
    Pk(w | h)  = a(h) Pk-1(w | h')        for an unseen one, h' is h without its first word; Pk-1(w | h') where h was never seen
    a(h)       = (1 - sum of seen Pk(w | h)) / (1 - sum of Pk-1(w | h') over the same w)

A seen k-gram has a seen end, so both sums of a(h) need counts only, and all orders are evaluated at once.

N-grams are known by 64-bit hashes.  Texts are read once into blocks of about ``BLOCK_TOKENS`` tokens, each a
row of a table in the shared folder.  The blocks send their distinct n-grams of each order with their training counts,
cut by hash into buckets; a bucket sums what the blocks sent and answers each block with the totals.  A frequent
n-gram is one number per block, whatever its frequency, so no bucket is hot.  One of the blocks that hold an n-gram is
its owner and adds it to the sums of its history, so every n-gram enters a(h) once.  A history that one block alone holds
is followed by n-grams of this block alone: its weight is found where it is needed, and only those that several blocks
hold, one of them in a text that is held out, are exchanged.  All that is sent is packed into as few bytes as the numbers need.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lastro.llm.text import split_words, text_of
from lastro.session import discard, stored

BLOCK_TOKENS = 1 << 20
BUCKET_KEYS = 1 << 20
#: Parts in which blocks meet their answers one after the other, so that only a part of them lies in shuffle files.
PARTS = 4
#: Counts up to this one are discounted.
DISCOUNTED = 5
#: What larger counts lose.
LARGE = 0.5
_MIX = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xC2B2AE3D27D4EB4F)
#: Hash of the end of a text; of a word: its own, salted.
END = np.uint64(xxhash.xxh3_64_intdigest(b"", seed=1))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def _packed(values: np.ndarray) -> bytes:
    """64-bit numbers: the lowest bytes of all, then the next ones, as many as the largest needs, compressed."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    narrow = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(data[0], -1)
    wide = np.zeros((narrow.shape[1], 8), np.uint8)
    wide[:, : data[0]] = narrow.T
    return wide.view("<u8").ravel()




def _packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as the steps between them."""
    return _packed(np.diff(keys, prepend=np.uint64(0)))


def _unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data), dtype=np.uint64)


def _joined(first: bytes, second: bytes) -> bytes:
    return len(first).to_bytes(4, "little") + first + second


def _parted(data: bytes) -> tuple[bytes, bytes]:
    end = 4 + int.from_bytes(data[:4], "little")
    return data[4:end], data[end:]


def _packed_floats(values: np.ndarray) -> bytes:
    """As they are, or as numbers of the distinct ones where many are equal."""
    bits = np.ascontiguousarray(values, np.float64).view(np.uint64)
    distinct, numbers = np.unique(bits, return_inverse=True)
    if 2 * len(distinct) > len(bits):
        return _joined(b"", _packed(bits))
    return _joined(_packed_keys(distinct), _packed(numbers))


def _unpacked_floats(data: bytes) -> np.ndarray:
    distinct, rest = _parted(data)
    bits = _unpacked_keys(distinct)[_unpacked(rest).astype(np.int64)] if distinct else _unpacked(rest)
    return bits.view(np.float64)


def _packed_numbers(numbers: np.ndarray) -> bytes:
    """Numbers 0, 1, ... that all occur: how often each does, and their ranks by that, small where they are frequent."""
    often = np.bincount(numbers)
    ranks = np.empty(len(often), np.uint32)
    ranks[np.argsort(-often, kind="stable")] = np.arange(len(often))
    return _joined(_packed(often), _packed(ranks[numbers]))


def _unpacked_numbers(data: bytes) -> np.ndarray:
    often, ranks = map(_unpacked, _parted(data))
    return np.argsort(-often.view(np.int64), kind="stable").astype(np.uint32)[ranks.view(np.int64)]


def discounts(of_counts: dict[int, int], k: int = DISCOUNTED) -> np.ndarray:
    """Discounted counts of r = 0..k from the numbers of items seen r times.

    Katz: r (r*/r - x) / (1 - x), r* = (r + 1) n(r+1) / n(r), x = (k + 1) n(k+1) / n(1).  Where the counts of counts
    are too sparse for a ratio between 0 and 1, n(1) / (n(1) + 2 n(2)) of a count goes instead (absolute
    discounting).  Larger counts lose ``LARGE``, where Katz leaves them whole: else a history with large counts
    only would leave nothing for words it was not seen with.
    """
    n = {r: of_counts.get(r, 0) for r in range(1, k + 2)}
    x = (k + 1) * n[k + 1] / n[1] if n[1] else 1.0
    plain = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
    left = np.zeros(k + 1)
    for r in range(1, k + 1):
        ratio = ((r + 1) * n[r + 1] / (r * n[r]) - x) / (1 - x) if n[r] and x < 1 else -1.0
        left[r] = r * ratio if 0 < ratio < 1 else r - min(plain, 0.999)
    return left


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 19:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word, seed=2)
        return found


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``id, text, train`` -> one row per block: its name, rows, lengths, distinct words and words by number."""
    hashes, name, held, size = _Hashes(), None, [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            found = split_words(batch.column(1)[i].as_py())
            coded = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
            held.append((batch.column(0).slice(i, 1), np.append(coded, END), batch.column(2)[i].as_py()))
            size += len(found) + 1
            if size >= BLOCK_TOKENS:
                yield _block(held)
                held, size = [], 0
    if held:
        yield _block(held)


def _block(held: list) -> pa.RecordBatch:
    words, numbers = np.unique(np.concatenate([tokens for _, tokens, _ in held]), return_inverse=True)
    ids = pa.concat_arrays([i for i, _, _ in held])
    lengths = [len(tokens) for _, tokens, _ in held]
    return pa.record_batch({
        "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
        "lengths": pa.array([lengths], pa.list_(pa.int32())),
        "train": pa.array([[t for _, _, t in held]], pa.list_(pa.bool_())),
        "words": pa.array([_packed_keys(words)], pa.binary()),
        "numbers": pa.array([_packed_numbers(numbers)], pa.binary()),
        "distinct": pa.array([len(words)], pa.int32()),
    })


@dataclass
class _Block:
    """The tokens of a block: sorted keys of its words, the words by number, texts one after the other."""

    words: np.ndarray
    numbers: np.ndarray
    lengths: np.ndarray
    train: np.ndarray

    @classmethod
    def read(cls, row: dict) -> "_Block":
        lengths = np.array(row["lengths"], np.int64)
        return cls(
            _unpacked_keys(row["words"]), _unpacked_numbers(row["numbers"]).astype(np.int32), lengths,
            np.repeat(np.array(row["train"], bool), lengths),
        )

    def grams(self, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each order: sorted keys of the distinct n-grams, and at each token the number of the one that ends
        there, -1 where its text has too few tokens."""
        place = np.arange(len(self.numbers)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        found = [(self.words, self.numbers)]
        for n in range(2, order + 1):
            keys, numbers = found[-1]
            at = np.flatnonzero(place >= n - 1)
            distinct, number = np.unique(
                _mix(keys[numbers[at - 1]] * _ODD + self.words[self.numbers[at]]), return_inverse=True
            )
            longer = np.full(len(numbers), -1, np.int32)
            longer[at] = number
            found.append((distinct, longer))
        return found


def _cut(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins among sorted keys: buckets are ranges of keys of one width."""
    edges = (np.arange(buckets + 1, dtype=object) * (1 << 64) // buckets)[1:-1].astype(np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _some(ends: np.ndarray) -> list[int]:
    return np.flatnonzero(np.diff(ends)).tolist()


def _send(order: int, buckets: int, histories: bool):
    """Blocks -> per bucket: the block's distinct n-grams, their training counts and, of ``histories``, whether they
    occur in texts that are held out: the weights of others are never wanted."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                block = _Block.read(row)
                keys, numbers = block.grams(order)[-1]
                counts = np.bincount(numbers[block.train & (numbers >= 0)], minlength=len(keys))
                counts *= 2
                if histories:
                    counts[numbers[~block.train & (numbers >= 0)]] |= 1
                ends = _cut(keys, buckets)
                some = _some(ends)
                yield pa.record_batch({
                    "bucket": pa.array(some, pa.int32()),
                    "block": pa.array([row["block"]] * len(some), pa.int64()),
                    "keys": pa.array([_packed_keys(keys[ends[b] : ends[b + 1]]) for b in some], pa.binary()),
                    "counts": pa.array([_packed(counts[ends[b] : ends[b + 1]]) for b in some], pa.binary()),
                })

    return send


def _sum(table: pa.Table) -> pa.Table:
    """The totals of one bucket, sent back to its blocks; items that the block owns are marked, and those that several
    blocks hold and some block holds in a text that is held out."""
    table = table.sort_by("block")
    keys = [_unpacked_keys(x.as_py()) for x in table["keys"]]
    counts = [_unpacked(x.as_py()) for x in table["counts"]]
    distinct, number = np.unique(np.concatenate(keys), return_inverse=True)
    added = np.concatenate(counts)
    held_out = np.bincount(number, weights=added & np.uint64(1), minlength=len(distinct)) > 0
    added = added >> np.uint64(1)
    totals = np.bincount(number, weights=added, minlength=len(distinct)).astype(np.uint64)
    trained = np.flatnonzero(added)
    owner = np.zeros(len(number), np.uint64)
    owner[trained[np.unique(number[trained], return_index=True)[1]]] = 1
    shared = ((np.bincount(number, minlength=len(distinct)) > 1) & held_out).astype(np.uint64)
    of_counts = np.bincount(np.minimum(totals, DISCOUNTED + 2).astype(np.int64), minlength=DISCOUNTED + 3)
    answers, at = [], 0
    for part in keys:
        span = slice(at, at + len(part))
        answers.append(_packed((totals[number[span]] * np.uint64(2) + shared[number[span]]) * np.uint64(2) + owner[span]))
        at += len(part)
    rows = table.num_rows
    # The bucket's own figures travel with its first row.
    return pa.table({
        "bucket": table["bucket"], "block": table["block"], "answer": pa.array(answers, pa.binary()),
        "of_counts": pa.array([of_counts.tolist()] + [None] * (rows - 1), pa.list_(pa.int64())),
        "distinct": pa.array([int(np.count_nonzero(totals))] + [0] * (rows - 1), pa.int64()),
        "total": pa.array([int(totals.sum())] + [0] * (rows - 1), pa.int64()),
    })


def _exchange(blocks: DataFrame, order: int, buckets: int, histories: bool) -> DataFrame:
    sent = blocks.mapInArrow(_send(order, buckets, histories), "bucket int, block bigint, keys binary, counts binary")
    answers = sent.groupBy("bucket").applyInArrow(
        _sum, "bucket int, block bigint, answer binary, of_counts array<bigint>, distinct bigint, total bigint"
    )
    return stored(answers.withColumn("part", _part()), f"katz-{order}", "part")


def _part() -> Column:
    return F.pmod(F.xxhash64("block"), F.lit(PARTS)).cast("int")


def _gathered(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    """The blocks with all answers to them, by kind and in order of their buckets."""
    lists = answers.groupBy(F.col("block").alias("block_")).agg(
        F.sort_array(F.collect_list(F.struct("kind", "bucket", "answer"))).alias("answers")
    )
    return blocks.join(lists, F.col("block") == F.col("block_"), "left").drop("block_")


def _answers(row: dict, kind: str) -> list[bytes]:
    return [x["answer"] for x in row["answers"] or () if x["kind"] == kind]


def _totals(row: dict, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Training counts of the block's n-grams, which of them it owns, and whose weights are exchanged if wanted."""
    pieces = [_unpacked(x) for x in _answers(row, f"count{order}")]
    both = np.concatenate(pieces) if pieces else np.zeros(0, np.uint64)
    return (both >> np.uint64(2)).astype(np.float64), (both & np.uint64(1)).astype(bool), (both & np.uint64(2)).astype(bool)


@dataclass
class _Model:
    """What every task needs to know: a few numbers for each order."""

    order: int
    tables: list[np.ndarray]
    tokens: int = 0
    distinct: int = 0
    unknown: float = 1.0

    def discounted(self, order: int, counts: np.ndarray) -> np.ndarray:
        table = self.tables[order - 1]
        return np.where(counts > DISCOUNTED, counts - LARGE, table[np.minimum(counts, DISCOUNTED).astype(np.int64)])

    def unigrams(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, self.discounted(1, counts) / max(self.tokens, 1), self.unknown)


_EVALUATED = (
    "block bigint, longer int, bucket int, keys binary, freed binary, lower binary, wanted binary, ids array<{id}>, "
    "held_out array<boolean>, n_tokens array<int>, n_known array<int>, base array<double>, partial array<double>, "
    "text array<binary>, weight array<binary>"
)


def _evaluate(model: _Model, buckets: dict[int, int], shape: pa.Schema):
    """Blocks with their totals -> one row with the scores of the block's texts but for backoff weights, and one
    row per order and bucket of histories: what the block's own n-grams freed and their lower probabilities, and the
    histories whose weight the block wants.  ``buckets``: by the order of the n-grams that follow the histories."""

    def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from _evaluated(model, buckets, batch.slice(i, 1), shape)

    return evaluate


def _evaluated(model: _Model, buckets: dict[int, int], rows: pa.RecordBatch, shape: pa.Schema) -> Iterator[pa.RecordBatch]:
    row = rows.drop_columns(["ids"]).to_pylist()[0]
    block, totals = _Block.read(row), [_totals(row, n) for n in range(1, model.order + 1)]
    grams = block.grams(model.order)
    counts = totals[0][0]
    unigrams = model.unigrams(counts)
    logs = np.log10(unigrams)[block.numbers]
    starts = np.cumsum(block.lengths) - block.lengths
    of_text = np.repeat(np.arange(len(starts)), block.lengths)
    texts, weights = [], []
    for n in range(2, model.order + 1):
        (keys, histories), (_, numbers) = grams[n - 2], grams[n - 1]
        (before, _, shared), (followed, owned, _) = totals[n - 2], totals[n - 1]
        at = np.flatnonzero(numbers >= 0)
        history, c = histories[at - 1], followed[numbers[at]]
        seen, there = before[history], c > 0
        logs[at[there]] = np.log10(model.discounted(n, c[there]) / seen[there])
        # Unseen after a seen history: log a(h) is added later, without its division by c(h).
        backed = ~there & (seen > 0)
        logs[at[backed]] -= np.log10(seen[backed])
        # One token of each distinct n-gram that the block owns stands for it.
        first = np.unique(numbers[at], return_index=True)[1]
        first = first[owned[numbers[at[first]]]]
        own, ends_at = history[first], at[first]
        if n == 2:
            lower = unigrams[block.numbers[ends_at]]
        else:
            lower = model.discounted(n - 1, before[histories[ends_at]]) / totals[n - 3][0][grams[n - 3][1][ends_at - 1]]
        freed = np.bincount(own, weights=c[first] - model.discounted(n, c[first]), minlength=len(keys))
        below = np.bincount(own, weights=lower, minlength=len(keys))
        # The block holds all that follows a history of its own.
        alone = backed & ~shared[history]
        logs[at[alone]] += np.log10(freed[history[alone]] / np.maximum(1 - below[history[alone]], 1e-12))
        backed &= shared[history]
        wanted, weight = np.unique(history[backed], return_inverse=True)
        texts.append(_packed(of_text[at[backed]]))
        weights.append(_packed(weight))
        some = np.flatnonzero((np.bincount(own, minlength=len(keys)) > 0) & shared)
        ends, ends_wanted = _cut(keys[some], buckets[n]), _cut(keys[wanted], buckets[n])
        used = sorted({*_some(ends), *_some(ends_wanted)})
        yield _shaped({
            "block": [row["block"]] * len(used), "longer": [n] * len(used), "bucket": used,
            "keys": [_packed_keys(keys[some[ends[b] : ends[b + 1]]]) for b in used],
            "freed": [_packed_floats(freed[some[ends[b] : ends[b + 1]]]) for b in used],
            "lower": [_packed_floats(below[some[ends[b] : ends[b + 1]]]) for b in used],
            "wanted": [_packed_keys(keys[wanted[ends_wanted[b] : ends_wanted[b + 1]]]) for b in used],
        }, len(used), shape)
    known = counts[block.numbers]
    base = np.log10((known + 0.5) / (model.tokens + 0.5 * (model.distinct + 1)))
    listed = lambda x: pa.array([x.tolist()])
    yield _shaped({
        "block": [row["block"]], "bucket": [-1], "ids": rows.column("ids"), "held_out": listed(~np.array(row["train"], bool)),
        "n_tokens": listed(block.lengths), "n_known": listed(np.add.reduceat((known > 0).astype(np.int64), starts)),
        "base": listed(np.add.reduceat(base, starts)), "partial": listed(np.add.reduceat(logs, starts)),
        "text": [texts], "weight": [weights],
    }, 1, shape)


def _shaped(columns: dict, rows: int, shape: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        (columns[f.name].cast(f.type) if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type))
        if f.name in columns else pa.nulls(rows, f.type)
        for f in shape
    ], schema=shape)


def _backoff(table: pa.Table) -> pa.Table:
    """log10(c(h) a(h)) of the histories that the blocks want from one bucket."""
    table = table.sort_by("block")
    keys = np.concatenate([_unpacked_keys(x.as_py()) for x in table["keys"]])
    distinct, number = np.unique(keys, return_inverse=True)
    freed, lower = (
        np.bincount(number, weights=np.concatenate([_unpacked_floats(x.as_py()) for x in table[c]]), minlength=len(distinct))
        for c in ("freed", "lower")
    )
    logs = np.log10(freed / np.maximum(1 - lower, 1e-12))
    # A wanted history was seen in training, so some block owns one of its n-grams.
    answers = [_packed_floats(logs[np.searchsorted(distinct, _unpacked_keys(x.as_py()))]) for x in table["wanted"]]
    return pa.table({
        "longer": table["longer"], "bucket": table["bucket"], "block": table["block"], "answer": pa.array(answers, pa.binary()),
    })


def _score(model: _Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = batch.slice(i, 1)
                row = rows.drop_columns(["ids"]).to_pylist()[0]
                n = len(row["partial"])
                added = np.zeros(n)
                for order, (text, weight) in enumerate(zip(row["text"], row["weight"]), 2):
                    weights = [_unpacked_floats(x) for x in _answers(row, f"weight{order}")]
                    if weights:
                        found = np.concatenate(weights)[_unpacked(weight).astype(np.int64)]
                        added += np.bincount(_unpacked(text).astype(np.int64), weights=found, minlength=n)
                yield pa.record_batch({
                    "id": rows.column("ids").flatten(),
                    "held_out": pa.array(row["held_out"], pa.bool_()),
                    "n_tokens": pa.array(row["n_tokens"], pa.int64()),
                    "n_known": pa.array(row["n_known"], pa.int64()),
                    "train_tokens": pa.array([model.tokens] * n, pa.int64()),
                    "base_score": pa.array(row["base"], pa.float64()),
                    "score": pa.array(np.array(row["partial"]) + added),
                })

    return score


def score(
    docs: DataFrame, train: Column, id_column: str = "doc_id", text_column: str = "text", order: int = 2
) -> DataFrame:
    """One row per input row: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    The model learns the n-grams of up to ``order`` tokens of the rows for which ``train`` is true.  Tokens are words with A-Z in lower case and one
    end per text.  A null or empty text is its end alone.  Without training text all tokens are unknown, and base
    and model both give log10(1).  Null ids and repeated rows are scored like others; an empty table gives
    no rows.  Other columns are ignored.
    """
    kind = docs.schema[id_column].dataType
    id_type = kind.simpleString()
    held = F.coalesce(train, F.lit(False))
    texts = docs.select(docs[id_column].alias("id"), text_of(docs[text_column]).alias("text"), held.alias("train"))
    layout = f"ids array<{id_type}>, lengths array<int>, train array<boolean>, words binary, numbers binary, distinct int"
    numbered = texts.mapInArrow(_blocks, layout).withColumn("block", F.monotonically_increasing_id())
    blocks = stored(numbered.withColumn("part", _part()), "katz-blocks", "part")
    size = blocks.agg(F.sum(F.expr("aggregate(lengths, 0L, (a, x) -> a + x)")), F.sum("distinct")).first()
    tokens, model, counts, exchanged = int(size[0] or 0), _Model(order, []), [], []
    buckets = {n: (int(size[1] or 0) if n == 1 else tokens) // BUCKET_KEYS + 1 for n in range(1, order + 1)}
    for n in range(1, order + 1):
        counted = _exchange(blocks, n, buckets[n], n < order)
        exchanged.append(counted)
        figures = counted.where("of_counts IS NOT NULL").agg(
            F.sum("distinct"), F.sum("total"), *[F.sum(F.col("of_counts")[r]) for r in range(DISCOUNTED + 2)]
        ).first()
        of_counts = {r: int(figures[2 + r] or 0) for r in range(DISCOUNTED + 2)}
        table = discounts(of_counts)
        model.tables.append(table)
        if n == 1:
            model.distinct, model.tokens = int(figures[0] or 0), int(figures[1] or 0)
            large = model.distinct - sum(of_counts[r] for r in range(1, DISCOUNTED + 1))
            left = sum((r - table[r]) * of_counts[r] for r in range(1, DISCOUNTED + 1)) + LARGE * large
            model.unknown = float(left / model.tokens) if model.tokens else 1.0
        counts.append(counted.select("block", F.lit(f"count{n}").alias("kind"), "bucket", "answer", "part"))
    shape = _EVALUATED.format(id=id_type)
    arrow = to_arrow_schema(StructType.fromDDL(shape))
    evaluate = _evaluate(model, {n: buckets[n - 1] for n in range(2, order + 1)}, arrow)
    evaluated = []
    for number in range(PARTS):
        own, answered = (
            t.where(F.col("part") == number).drop("part") for t in (blocks, reduce(DataFrame.unionByName, counts))
        )
        gathered = _gathered(own, answered).select("block", "ids", "lengths", "train", "words", "numbers", "answers")
        evaluated.append(stored(gathered.mapInArrow(evaluate, shape), "katz-evaluated"))
    evaluated = reduce(DataFrame.unionByName, evaluated)
    discard(blocks, *exchanged)
    weights = evaluated.where("bucket >= 0").select("longer", "bucket", "block", "keys", "freed", "lower", "wanted")
    weights = weights.groupBy("longer", "bucket").applyInArrow(_backoff, "longer int, bucket int, block bigint, answer binary")
    kind = F.concat(F.lit("weight"), "longer").alias("kind")
    weights = stored(weights.select("block", kind, "bucket", "answer"), "katz-weights")
    whole = evaluated.where("bucket < 0").select(
        "block", "ids", "held_out", "n_tokens", "n_known", "base", "partial", "text", "weight"
    )
    scored = _gathered(whole, weights).mapInArrow(
        _score(model),
        f"id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    )
    return scored.withColumnRenamed("id", id_column)
