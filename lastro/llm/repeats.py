"""Repeated byte windows of a corpus by a depth-limited radix sort of suffixes, and texts without them.

Two suffixes that agree through ``length`` bytes are a repeat, so suffixes are ordered to that depth only, by passes
over digits, the most significant first.  After a pass a suffix alone in its group is unique and drops out; what is
together after the last pass is exactly the repeated windows.

* The first digit is the window's anchor: of its substrings of ``GRAM`` bytes the one with the least hash, leftmost
  where hashes tie, and how far it lies inside.  Equal windows have equal anchors at equal distances.  Neighbouring
  suffixes have the same anchor, about 70 of them, and travel as one row; most rows are alone after this pass.
* The second digit is all the text that the suffixes of such a row see.  Rows that agree in it are repeated in full, and
  one of them stands for all from here on.
* Where a group of one anchor holds rows that nothing agreed with (at the ends of repeated passages), its suffixes go
  on in stretches of ``STRETCH`` neighbours: the digits of such a row are what all its suffixes see, then all they see.
* What is still open, hardly more than the stretches in which passages end, goes through the last pass suffix by suffix,
  each to its full depth.

Groups are counted by aggregates with map-side combine and joined back, so a passage that a third of all documents
share is a number, not a group in a task; adaptive execution splits its rows in the joins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastro.llm.text import text_of
from lastro.session import stored

#: Bytes of an anchor, for windows of 400; others use the same share of their length.
GRAM = 273
LENGTH = 400
#: Suffixes that the middle pass takes together.
STRETCH = 16
#: Windows of a text that are hashed at once, which bounds the memory that a long text takes.
SEGMENT = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_FINAL = np.uint64(0xBF58476D1CE4E5B9)
_HIGH = np.uint64(0xFFFFFFFF00000000)
_LOW = np.uint64(0xFFFFFFFF)


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


@dataclass
class _Anchors:
    """Hashes of all substrings of ``gram`` bytes, and the anchor of every window of ``length`` bytes."""

    length: int
    gram: int

    def __post_init__(self) -> None:
        most = SEGMENT + self.length
        self.up, self.down = _powers(_BASE, most), _powers(_INVERSE, most)

    def hashes(self, data: np.ndarray) -> np.ndarray:
        terms = (data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        mixed = (sums[self.gram :] - sums[: -self.gram]) * self.down[: len(data) - self.gram + 1]
        mixed ^= mixed >> np.uint64(29)
        mixed *= _FINAL
        return mixed ^ (mixed >> np.uint64(32))

    def least(self, hashes: np.ndarray) -> np.ndarray:
        """The leftmost least one of every ``length - gram + 1`` neighbours."""
        span = self.length - self.gram + 1
        best = (hashes & _HIGH) | np.arange(len(hashes), dtype=np.uint64)
        width = 1
        while width * 2 <= span:
            best = np.minimum(best[:-width], best[width:])
            width *= 2
        rest = span - width
        if rest:
            best = np.minimum(best[:-rest], best[rest:])
        return (best & _LOW).astype(np.int64)

    def rows(self, text: bytes) -> tuple[np.ndarray, ...]:
        """``gram, rest, at, lo, hi``: an anchor's hash, that of all its windows see, its place, and how far before
        it its windows begin, from ``lo`` to ``hi`` bytes."""
        data, windows = np.frombuffer(text, np.uint8), len(text) - self.length + 1
        found = []
        for start in range(0, max(windows, 0), SEGMENT):
            count = min(SEGMENT, windows - start)
            hashes = self.hashes(data[start : start + count + self.length - 1])
            at = self.least(hashes)
            first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            last = np.append(first[1:], count) - 1
            place = at[first]
            seen = np.fromiter(
                map(xxhash.xxh3_64_intdigest, map(
                    text.__getitem__, map(slice, (first + start).tolist(), (last + start + self.length).tolist())
                )), np.uint64, len(first),
            )
            lo, hi = place - last, place - first
            seen ^= (lo * 1024 + hi).astype(np.uint64) * _FINAL
            found.append((hashes[place], seen, place + start, lo, hi))
        if not found:
            empty = np.zeros(0, np.int64)
            return empty.astype(np.uint64), empty.astype(np.uint64), empty, empty, empty
        return tuple(np.concatenate(x) for x in zip(*found))


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the bytes that half-open spans cover."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > reach[:-1]])
    return starts[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _listed(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0] + [len(x) for x in parts])
    values = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.astype(kind.to_pandas_dtype())))


def _find_anchors(length: int, gram: int):
    """Texts -> their anchors, each once.  One that a text holds twice is repeated already: its spans in this text are
    merged here and it counts as two."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = _Anchors(length, gram)
        for batch in batches:
            columns, own = [[] for _ in range(6)], ([], [])
            for value in batch.column(2):
                hashes, rest, at, lo, hi = anchors.rows(value.as_buffer().to_pybytes())
                pairs = hashes
                if len(np.unique(hashes)) < len(hashes):
                    pairs = np.stack([hashes, rest], axis=1)
                _, first, number, times = np.unique(pairs, axis=0, return_index=True, return_inverse=True, return_counts=True)
                again = times[number.ravel()] > 1
                starts, ends = merged((at - hi)[again], (at - lo + length)[again])
                own[0].append(starts)
                own[1].append(ends)
                for column, values in zip(columns, (
                    hashes[first].view(np.int64), rest[first].view(np.int64), at[first], lo[first], hi[first], np.minimum(times, 2),
                )):
                    column.append(values)
            wide = (pa.int64(), pa.int64(), pa.int64(), pa.int16(), pa.int16(), pa.int16())
            yield pa.record_batch({
                "id": batch.column(0), "key": batch.column(1),
                **{n: _listed(c, t) for n, c, t in zip(("gram", "rest", "at", "lo", "hi", "times"), columns, wide)},
                "starts": _listed(own[0], pa.int64()), "ends": _listed(own[1], pa.int64()),
            })

    return find


def _contexts(length: int):
    """Texts with their open rows -> the bytes that the suffixes of each row see."""

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, rows in zip(batch.column(0), batch.column(1)):
                data, rows = text.as_buffer().to_pybytes(), rows.as_py()
                names = ("gram", "rest", "lo", "hi", "times")
                seen = [data[r["at"] - r["hi"] : r["at"] - r["lo"] + length] for r in rows]
                yield pa.record_batch({
                    **{n: pa.array([r[n] for r in rows], pa.int16() if n in ("lo", "hi") else pa.int64()) for n in names},
                    "seen": pa.array(seen, pa.binary()),
                })

    return contexts


def _halves(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)


_ROW = ("gram", "rest", "times")


def _find_stretches(length: int):
    """Rows with what they see -> one row per stretch of suffixes: hashes of what all of them see, and of all they see."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inner, outer, of, steps = [], [], [], []
            for i, row in enumerate(batch.to_pylist()):
                seen, lo, hi = row["seen"], row["lo"], row["hi"]
                for step in range(lo // STRETCH, hi // STRETCH + 1):
                    near, far = step * STRETCH, step * STRETCH + STRETCH - 1
                    inner.append(xxhash.xxh3_128_digest(seen[hi - near : hi - far + length], seed=step))
                    near, far = max(near, lo), min(far, hi)
                    outer.append(xxhash.xxh3_64_digest(seen[hi - far : hi - near + length], seed=near * 1024 + far))
                    of.append(i)
                    steps.append(step)
            halves, at = _halves(inner), pa.array(of, pa.int32())
            yield pa.record_batch({
                "w0": pa.array(halves[:, 0]), "w1": pa.array(halves[:, 1]),
                "outer": pa.array(np.frombuffer(b"".join(outer), "<i8")), "step": pa.array(steps, pa.int16()),
                **{n: batch.column(n).take(at) for n in _ROW},
            })

    return find


def _find_windows(length: int):
    """Rows with what they see and their open stretches -> one row per suffix: its bytes to full depth."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, of, before, times = [], [], [], []
            for i, row in enumerate(batch.to_pylist()):
                seen, lo, hi = row["seen"], row["lo"], row["hi"]
                for s in row["steps"]:
                    own = range(max(s["step"] * STRETCH, lo), min(s["step"] * STRETCH + STRETCH - 1, hi) + 1)
                    digests += [xxhash.xxh3_128_digest(seen[hi - d : hi - d + length]) for d in own]
                    of += [i] * len(own)
                    times += [s["total"]] * len(own)
                    before += own
            halves, at = _halves(digests), pa.array(of, pa.int32())
            yield pa.record_batch({
                "w0": pa.array(halves[:, 0]), "w1": pa.array(halves[:, 1]), "before": pa.array(before, pa.int16()),
                "times": pa.array(times, pa.int64()), "gram": batch.column("gram").take(at), "rest": batch.column("rest").take(at),
            })

    return find


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the spans found in them -> maximal spans, and the bytes outside."""
    for batch in batches:
        kept, sizes, bounds = [], [], ([], [])
        for value, spans in zip(batch.column(1), batch.column(2)):
            data = value.as_buffer().to_pybytes()
            sizes.append(len(data))
            flat = spans.values if spans.is_valid else None
            if flat is None or not len(flat):
                starts = ends = np.zeros(0, np.int64)
            else:
                starts, ends = merged(flat.field("start").to_numpy(), flat.field("end").to_numpy())
            edges = [0, *np.stack([starts, ends], axis=1).ravel().tolist(), len(data)]
            kept.append(b"".join(data[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2)))
            bounds[0].append(starts)
            bounds[1].append(ends)
        yield pa.record_batch({
            "id": batch.column(0), "n_bytes": pa.array(sizes, pa.int64()), "starts": _listed(bounds[0], pa.int64()),
            "ends": _listed(bounds[1], pa.int64()), "kept": pa.array(kept, pa.binary()),
        })


def _texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Id, digest and bytes of every text; equal rows have equal repeats, so the first two name them."""
    data = text_of(docs[text_column]).cast("binary")
    return docs.select(docs[id_column].alias("id"), F.unhex(F.md5(data)).alias("key"), data.alias("data"))


def _same_text(left: DataFrame, right: DataFrame) -> Column:
    return left["id"].eqNullSafe(right["id"]) & (left["key"] == right["key"])


def _left_after(rows: DataFrame, digit: list[str], rest: str) -> DataFrame:
    """Groups of rows that agree in two digits, with their number: those of several rows, and those that are alone or
    not alone in an ``open`` group of the first digit, where some row is without company in the second."""
    groups = stored(rows.groupBy(*digit, rest).agg(F.sum("times").alias("total")), "repeats-groups")
    shared = groups.groupBy(*digit).agg(
        F.sum("total").alias("all"), F.count("*").alias("kinds"), F.min("total").alias("least")
    ).where("all > 1")
    left = groups.join(shared, digit).select(*digit, rest, "total", ((F.col("kinds") > 1) & (F.col("least") == 1)).alias("open"))
    return stored(left.where("total > 1 OR open"), "repeats-left")


def repeated_spans(docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, key, spans``: for texts with repeats, spans of bytes that hold them, unordered and overlapping."""
    gram = max(1, length * GRAM // LENGTH)
    texts = _texts(docs, id_column, text_column)
    id_type = docs.schema[id_column].dataType.simpleString()
    layout = (
        f"id {id_type}, key binary, gram array<bigint>, rest array<bigint>, at array<bigint>, lo array<smallint>, "
        "hi array<smallint>, times array<smallint>, starts array<bigint>, ends array<bigint>"
    )

    def span(far: Column | str, near: Column | str) -> Column:
        start, end = F.col("at") - F.col(far), F.col("at") - F.col(near) + length
        return F.struct(start.alias("start"), end.alias("end")).alias("span")

    found = stored(texts.mapInArrow(_find_anchors(length, gram), layout), "repeats-anchors")
    rows = found.select(
        "id", "key", F.explode(F.arrays_zip("gram", "rest", "at", "lo", "hi", "times")).alias("a")
    ).select("id", "key", "a.*")
    hits = stored(rows.drop("times").join(_left_after(rows, ["gram"], "rest"), ["gram", "rest"]), "repeats-hits")
    whole = hits.where("total > 1").select("id", "key", span("hi", "lo"))

    # One row stands for those that agree so far.
    spokesman = hits.where("open").groupBy("gram", "rest").agg(
        F.min(F.struct("id", "key", "at", "lo", "hi")).alias("row"), F.max("total").alias("times")
    )
    asked = stored(
        spokesman.groupBy("row.id", "row.key").agg(
            F.collect_list(F.struct("gram", "rest", "row.at", "row.lo", "row.hi", "times")).alias("rows")
        ), "repeats-asked",
    )
    seen = texts.join(asked, _same_text(texts, asked)).select("data", "rows").mapInArrow(
        _contexts(length), "gram bigint, rest bigint, lo smallint, hi smallint, times bigint, seen binary"
    )
    # A repeated row of the table would speak twice.
    seen = stored(seen.dropDuplicates(["gram", "rest"]), "repeats-contexts")
    stretches = stored(seen.mapInArrow(
        _find_stretches(length), "w0 bigint, w1 bigint, outer bigint, step smallint, gram bigint, rest bigint, times bigint"
    ), "repeats-stretches")
    left = _left_after(stretches, ["w0", "w1"], "outer")
    parts = stored(stretches.join(left, ["w0", "w1", "outer"]), "repeats-parts")
    open_parts = parts.where("open").groupBy("w0", "w1", "outer").agg(
        F.min(F.struct("gram", "rest", "step")).alias("row"), F.max("total").alias("total")
    )
    steps = open_parts.groupBy("row.gram", "row.rest").agg(F.collect_list(F.struct("row.step", "total")).alias("steps"))
    windows = stored(
        seen.drop("times").join(steps, ["gram", "rest"]).mapInArrow(
            _find_windows(length), "w0 bigint, w1 bigint, before smallint, times bigint, gram bigint, rest bigint"
        ), "repeats-windows",
    )
    equal = windows.groupBy("w0", "w1").agg(F.sum("times").alias("all")).where("all > 1")
    single = windows.where("times = 1").join(equal, ["w0", "w1"]).select("gram", "rest", F.col("before").alias("near"), F.col("before").alias("far"))
    near, far = F.col("step").cast("int") * STRETCH, F.col("step").cast("int") * STRETCH + (STRETCH - 1)
    grown = parts.where("total > 1 AND times = 1").select("gram", "rest", near.alias("near"), far.alias("far"))
    alone = hits.where("open AND total = 1").select("id", "key", "gram", "rest", "at", "lo", "hi")
    ends = alone.join(single.unionByName(grown), ["gram", "rest"]).withColumns(
        {"near": F.greatest("near", "lo"), "far": F.least("far", "hi")}
    ).select("id", "key", span("far", "near"))
    own = found.where("size(starts) > 0").select("id", "key", F.explode(F.arrays_zip("starts", "ends")).alias("s")).select(
        "id", "key", F.struct(F.col("s.starts").alias("start"), F.col("s.ends").alias("end")).alias("span")
    )
    every = whole.unionByName(ends).unionByName(own)
    return stored(every.groupBy("id", "key").agg(F.collect_list("span").alias("spans")), "repeats-spans")


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: id, ``n_bytes``, ``starts`` and ``ends`` of the removed runs in bytes, ``kept`` bytes.

    A byte is removed when a string of ``length`` bytes that covers it starts anywhere else too, in the same document
    (overlaps count) or another; strings never cross documents and are judged on the input.  What is kept may end inside a
    UTF-8 character, so it is bytes, not text.

    A null text is an empty one; texts shorter than ``length`` have no such string.  Repeated rows are documents like
    others, so a long one is removed in all of them.  Null ids are kept.  An empty table gives no rows.  Other columns
    are ignored, whatever their names.  Suffixes are compared by 128-bit hashes.
    """
    if length < 1 or length > 1 << 14:
        raise ValueError(f"length must be between 1 and {1 << 14}, not {length}")
    spans = repeated_spans(docs, length, id_column, text_column)
    texts = _texts(docs, id_column, text_column)
    id_type = docs.schema[id_column].dataType.simpleString()
    joined = texts.join(spans, _same_text(texts, spans), "left").select(texts["id"], "data", "spans")
    return joined.mapInArrow(
        _cut, f"id {id_type}, n_bytes bigint, starts array<bigint>, ends array<bigint>, kept binary"
    ).withColumnRenamed("id", id_column)
