"""Quality scores: random-indexing word vectors, pooled per document, and a small network with calibrated output.

1. Random indexing over all documents.  Every token has a sparse random index vector, made from its hash; the context
   vector of a token is the sum of the index vectors around it, wherever it occurs.  Tokens are known by 64-bit hashes.
   Texts are read once into blocks of about ``BLOCK_TOKENS`` tokens; the blocks send the sums of their distinct tokens, cut
   by hash into buckets, and a bucket answers each block with the totals of the tokens that it holds.
2. A document is the mean of its tokens' vectors (context and index), with its length and two shares of repeats.
3. A two-layer network in numpy learns ``quality`` from at most about ``LABELLED`` labelled documents; a fifth of
   these is kept apart to fit a temperature, by which the logits are divided.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastro.llm.katz import (
    _answers, _cut, _gathered, _packed, _packed_keys, _packed_numbers, _some, _unpacked, _unpacked_keys, _unpacked_numbers,
)
from lastro.llm.text import text_of
from lastro.session import discard, stored

#: Rows from which index vectors are made, by turning a row and by its sign.
SLOTS = 1 << 14
BLOCK_TOKENS = 1 << 22
BUCKET_KEYS = 1 << 17
SIZE = 32
NONZERO = 4
WINDOW = 2
HIDDEN = 24
#: Labelled documents that the network learns from, about.
LABELLED = 20_000
EPOCHS = 30
#: Parts in which blocks meet their answers one after the other, so that only a part of them lies in shuffle files.
PARTS = 8
_RUN = 1 << 17
#: Tokens, or keys, whose vectors are held at once.
_STRETCH = 1 << 16
_KNOWN_WORDS = 1 << 18
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def index_vectors() -> np.ndarray:
    """``SLOTS`` rows with ``NONZERO`` entries of 1 or -1, and a last row of zeros that stands between texts."""
    rng = np.random.default_rng(20240601)
    table = np.zeros((SLOTS + 1, SIZE), np.int8)
    places = np.argsort(rng.random((SLOTS, SIZE)), axis=1)[:, :NONZERO]
    np.put_along_axis(table[:-1], places, rng.choice(np.array([-1, 1], np.int8), (SLOTS, NONZERO)), axis=1)
    return table


_TABLE = index_vectors()


def index_of(keys: np.ndarray) -> np.ndarray:
    """Index vectors of tokens by their hashes, and a last row of zeros."""
    rows = np.zeros((len(keys) + 1, SIZE), np.int8)
    for begin in range(0, len(keys), _STRETCH):
        some = keys[begin : begin + _STRETCH]
        turn = (np.arange(SIZE) + (some >> np.uint64(32)).astype(np.int64)[:, None]) % SIZE
        sign = 1 - 2 * ((some >> np.uint64(48)) & np.uint64(1)).astype(np.int8)
        found = np.take_along_axis(_TABLE[(some % np.uint64(SLOTS)).astype(np.int64)], turn, axis=1)
        rows[begin : begin + len(some)] = found * sign[:, None]
    return rows


class _Tokens(dict):
    """A word of a text -> the numbers of its tokens, in order of their first use: letters in lower case, marks around
    them, capitals or digits.  ``keys``: hashes of the tokens by number."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.keys: list[int] = []

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        core = word.strip(_MARKS)
        found = [core.lower()] if core else []
        if len(core) < len(word):
            found.append(b"\x00" + word.replace(core, b" ", 1) if core else b"\x00" + word)
        if len(core) > 1 and core.isupper():
            found.append(b"\x01")
        if any(48 <= c < 58 for c in core):
            found.append(b"\x02")
        for token in found:
            if token not in self.numbers:
                self.numbers[token] = len(self.keys)
                self.keys.append(xxhash.xxh3_64_intdigest(token))
        self[word] = numbers = tuple(map(self.numbers.__getitem__, found))
        return numbers


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``id, text`` -> one row per block: ids, lengths, figures, hashes of its distinct tokens and tokens by number."""
    known, ids, held, figures, size = _Tokens(), [], [], [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            words = batch.column(1)[i].as_py().encode().split()
            held.append(np.fromiter(chain.from_iterable(map(known.__getitem__, words)), np.uint32))
            ids.append(batch.column(0).slice(i, 1))
            n = max(len(words), 1)
            figures += [np.log1p(len(words)), len(set(words)) / n, sum(map(eq, words, words[1:])) / n]
            size += len(held[-1]) + 1
            if size >= BLOCK_TOKENS:
                yield _block(known, ids, held, figures)
                known, ids, held, figures, size = known if len(known) < _KNOWN_WORDS else _Tokens(), [], [], [], 0
    if held:
        yield _block(known, ids, held, figures)


def _block(known: _Tokens, ids: list[pa.Array], held: list[np.ndarray], figures: list[float]) -> pa.RecordBatch:
    tokens = np.concatenate(held)
    used = np.flatnonzero(np.bincount(tokens, minlength=len(known.keys)))
    keys = np.array(known.keys, np.uint64)[used]
    order = np.argsort(keys)
    place = np.empty(len(known.keys), np.uint32)
    place[used[order]] = np.arange(len(keys))
    whole = pa.concat_arrays(ids)
    return pa.record_batch({
        "ids": pa.ListArray.from_arrays(pa.array([0, len(whole)], pa.int32()), whole),
        "lengths": pa.array([[len(x) for x in held]], pa.list_(pa.int32())),
        "figures": pa.array([figures], pa.list_(pa.float32())),
        "keys": pa.array([_packed_keys(keys[order])], pa.binary()),
        "numbers": pa.array([_packed_numbers(place[tokens])], pa.binary()),
        "distinct": pa.array([len(keys)], pa.int32()),
    })


def _texts(row: dict) -> list[np.ndarray]:
    return np.split(_unpacked_numbers(row["numbers"]).astype(np.uint32, copy=False), np.cumsum(row["lengths"])[:-1])


def context_sums(slots: list[np.ndarray], table: np.ndarray) -> np.ndarray:
    """Sum of the index vectors in the window around each token's occurrences, a row per row of the table but the last."""
    gap = np.full(WINDOW, len(table) - 1, np.uint32)
    line = np.concatenate([gap, *chain.from_iterable((s, gap) for s in slots)])
    sums = np.zeros((len(table), SIZE), np.int32 if 2 * WINDOW * len(line) < 1 << 31 else np.int64)
    for begin in range(0, len(line) - 2 * WINDOW, _STRETCH):
        stretch = line[begin : begin + _STRETCH + 2 * WINDOW]
        near = np.zeros((len(stretch) - 2 * WINDOW, SIZE), np.int8)
        for step in range(2 * WINDOW + 1):
            if step != WINDOW:
                near += table[stretch[step : len(stretch) - 2 * WINDOW + step]]
        middle = stretch[WINDOW : len(stretch) - WINDOW]
        order = np.argsort(middle, kind="stable")
        held, starts = np.unique(middle[order], return_index=True)
        sums[held] += np.add.reduceat(near[order], starts, axis=0, dtype=sums.dtype)
    return sums[:-1]


def _packed_sums(sums: np.ndarray) -> bytes:
    """Small numbers in few bytes, whatever their sign."""
    sums = sums.astype(np.int64, copy=False)
    return _packed(((sums << 1) ^ (sums >> 63)).view(np.uint64).ravel())


def _unpacked_sums(data: bytes) -> np.ndarray:
    coded = _unpacked(data).reshape(-1, SIZE)
    return (coded >> np.uint64(1)).astype(np.int64) ^ -(coded & np.uint64(1)).astype(np.int64)


def _send(buckets: int):
    """Blocks -> per bucket: the block's distinct tokens and the sums around them."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                keys = _unpacked_keys(row["keys"])
                sums = context_sums(_texts(row), index_of(keys))
                ends = _cut(keys, buckets)
                some = _some(ends)
                yield pa.record_batch({
                    "bucket": pa.array(some, pa.int32()),
                    "block": pa.array([row["block"]] * len(some), pa.int64()),
                    "keys": pa.array([_packed_keys(keys[ends[b] : ends[b + 1]]) for b in some], pa.binary()),
                    "sums": pa.array([_packed_sums(sums[ends[b] : ends[b + 1]]) for b in some], pa.binary()),
                })

    return send


def _sum(table: pa.Table) -> pa.Table:
    """The totals of one bucket's tokens, sent back to the blocks that hold them."""
    keys = [_unpacked_keys(x.as_py()) for x in table["keys"]]
    distinct, number = np.unique(np.concatenate(keys), return_inverse=True)
    places = np.split(number, np.cumsum([len(k) for k in keys])[:-1])
    totals = np.zeros((len(distinct), SIZE), np.int64)
    for place, sums in zip(places, table["sums"]):
        totals[place] += _unpacked_sums(sums.as_py())
    answers = [_packed_sums(totals[place]) for place in places]
    return pa.table({"bucket": table["bucket"], "block": table["block"], "answer": pa.array(answers, pa.binary())})


def _pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with their answers -> the mean of each text's vectors, context beside index, and its figures."""
    for batch in batches:
        for i in range(batch.num_rows):
            rows = batch.slice(i, 1)
            row = rows.drop_columns(["ids"]).to_pylist()[0]
            index = index_of(_unpacked_keys(row["keys"]))[:-1]
            vectors, texts, done = np.empty((len(index), 2 * SIZE), np.float32), _texts(row), 0
            np.divide(index, np.float32(np.sqrt(NONZERO)), out=vectors[:, SIZE:])
            for packed in _answers(row, "sums"):
                sums = _unpacked_sums(packed)
                vectors[done : done + len(sums), :SIZE] = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1)
                done += len(sums)
            if done < len(index):
                raise ValueError(f"answers for {done} of {len(index)} tokens")
            means, lengths = np.zeros((len(texts), 2 * SIZE), np.float32), np.array(row["lengths"])
            parted = np.cumsum(lengths) // _RUN
            for part in np.unique(parted):
                full = np.flatnonzero((parted == part) & (lengths > 0))
                if len(full):
                    starts = np.cumsum(lengths[full]) - lengths[full]
                    sums = np.add.reduceat(vectors[np.concatenate([texts[t] for t in full])], starts, axis=0)
                    means[full] = sums / lengths[full, None]
            x = np.hstack([means, np.array(row["figures"], np.float32).reshape(-1, 3)])
            yield pa.record_batch({
                "id": rows.column("ids").flatten(),
                "x": pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel(), pa.float32())),
            })


def _discard_part(read: DataFrame, whole: DataFrame, number: int) -> None:
    read.stored_at = f"{whole.stored_at}/part={number}"
    discard(read)


def document_vectors(texts: DataFrame) -> DataFrame:
    """``id, text`` -> ``id, x``: the mean of the text's token vectors, with its length and two shares of repeats."""
    id_type = texts.schema["id"].dataType.simpleString()
    shape = f"ids array<{id_type}>, lengths array<int>, figures array<float>, keys binary, numbers binary, distinct int"
    part = F.pmod(F.xxhash64("block"), F.lit(PARTS)).cast("int")
    numbered = texts.mapInArrow(_blocks, shape).withColumn("block", F.monotonically_increasing_id())
    blocks = stored(numbered.withColumn("part", part), "quality-blocks", "part")
    buckets = int(blocks.agg(F.sum("distinct")).first()[0] or 0) // BUCKET_KEYS + 1
    sent = blocks.select("block", "lengths", "keys", "numbers").mapInArrow(
        _send(buckets), "bucket int, block bigint, keys binary, sums binary"
    )
    # Sums lie in files by part of their buckets and go once they are answered, so that sums, their shuffle files and
    # answers never lie there in full at the same time.
    sent = stored(sent.withColumn("part", F.col("bucket") % PARTS), "quality-sums", "part")
    answers = []
    for number in range(min(PARTS, buckets)):
        own = sent.where(F.col("part") == number).drop("part")
        answered = own.groupBy("bucket").applyInArrow(_sum, "bucket int, block bigint, answer binary")
        answered = answered.select("block", F.lit("sums").alias("kind"), "bucket", "answer", part.alias("part"))
        answers.append(stored(answered, "quality-answers", "part"))
        _discard_part(own, sent, number)
    pooled = []
    for number in range(PARTS):
        own, *answered = (t.where(F.col("part") == number).drop("part") for t in (blocks, *answers))
        gathered = _gathered(own, reduce(DataFrame.unionByName, answered)).select("ids", "lengths", "figures", "keys", "numbers", "answers")
        pooled.append(stored(gathered.mapInArrow(_pooled, f"id {id_type}, x array<float>"), "quality-vectors"))
        for read, whole in zip((own, *answered), (blocks, *answers)):
            _discard_part(read, whole, number)
    return reduce(DataFrame.unionByName, pooled)


class Network:
    """Two layers, tanh and logistic, on standardised inputs; deterministic for given rows in given order."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.temperature, self.trained = 1.0, len(np.unique(y)) == 2
        if not self.trained:  # nothing to tell apart
            self.constant = float(y.mean()) if len(y) else 0.5
            return
        apart = rng.permutation(len(x)) % 5 == 0
        if len(np.unique(y[apart])) < 2 or len(np.unique(y[~apart])) < 2:
            apart = np.zeros(len(x), bool)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        self.weights = [
            rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
            rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 1)), np.zeros(1),
        ]
        self._fit(((x - self.mean) / self.scale)[~apart], y[~apart], rng)
        self._calibrate(x[apart] if apart.any() else x, y[apart] if apart.any() else y)

    def _fit(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator, rate: float = 3e-3, decay: float = 1e-4) -> None:
        first, second = [np.zeros_like(w) for w in self.weights], [np.zeros_like(w) for w in self.weights]
        steps = max(EPOCHS, 600 * 128 // max(len(x), 1))
        t = 0
        for _ in range(steps):
            order = rng.permutation(len(x))
            for begin in range(0, len(x), 128):
                rows = order[begin : begin + 128]
                a, b, c, d = self.weights
                hidden = np.tanh(x[rows] @ a + b)
                error = (self._logistic(hidden @ c + d) - y[rows, None]) / len(rows)
                back = (error @ c.T) * (1 - hidden**2)
                slopes = [x[rows].T @ back + decay * a, back.sum(axis=0), hidden.T @ error + decay * c, error.sum(axis=0)]
                t += 1
                for i, slope in enumerate(slopes):
                    first[i] = 0.9 * first[i] + 0.1 * slope
                    second[i] = 0.999 * second[i] + 0.001 * slope**2
                    self.weights[i] = self.weights[i] - rate * (first[i] / (1 - 0.9**t)) / (
                        np.sqrt(second[i] / (1 - 0.999**t)) + 1e-8
                    )

    def _calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        logits = self.logits(x)
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 200))
        loss = [np.mean(np.logaddexp(0, logits / t) - y * logits / t) for t in grid]
        self.temperature = float(grid[int(np.argmin(loss))])

    @staticmethod
    def _logistic(z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return (np.tanh((x - self.mean) / self.scale @ a + b) @ c + d).ravel()

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.trained:
            return np.full(len(x), self.constant)
        return self._logistic(self.logits(x) / self.temperature)


def _scored(network: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                yield pa.record_batch({"id": batch.column(0), "score": pa.array(network.scores(x.astype(np.float64)))})

    return run


def score(
    docs: DataFrame, labels: DataFrame, train: Column, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "quality", labelled: int = LABELLED, threshold: float = 0.3,
) -> DataFrame:
    """One row per input row: id, ``held_out``, ``score`` (0 to 1) and ``predicted``.

    The network learns from labelled documents whose id satisfies ``train`` (an expression of the id column); texts
    are its only input.  A null text counts as empty and is scored too.  A document with several labels has their
    mean, rounded; labels that are null or of no document are ignored.  Without labels of both kinds every score
    is their share, 0.5 without any.  Null ids and repeated rows get a row each; an empty table gives no
    rows.  Other columns are ignored.
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    texts = docs.select(docs[id_column].alias("id"), text_of(docs[text_column]).alias("text"))
    vectors = document_vectors(texts)

    held = docs.select(docs[id_column].alias("id"), F.coalesce(train, F.lit(False)).alias("train")).where("train")
    truth = labels.where(labels[label_column].isNotNull()).groupBy(labels[id_column].alias("of")).agg(
        F.round(F.avg(labels[label_column])).alias("y")
    )
    truth = truth.join(held.select("id").distinct(), F.col("of") == F.col("id"), "left_semi")
    share = min(1.0, labelled / max(truth.count(), 1))
    hashed = F.shiftrightunsigned(F.xxhash64("of"), 1)
    picked = truth if share >= 1 else truth.where(hashed < F.lit(int(share * float(1 << 63))))
    rows = vectors.join(picked, F.col("id") == F.col("of")).select("id", "x", "y").toArrow().sort_by("id")
    x = np.array(rows["x"].to_pylist(), np.float64).reshape(rows.num_rows, 2 * SIZE + 3)
    network = Network(x, rows["y"].to_numpy().astype(np.float64))
    done = vectors.mapInArrow(_scored(network), f"id {id_type}, score double")
    known = done.withColumnRenamed("id", id_column)
    return known.select(
        id_column, (~F.coalesce(train, F.lit(False))).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
