"""Near-duplicates by tensored MinHash: table keys are pairs of keys from two small collections.

A document is the set of its distinct 5-word shingles.  Two collections of ``SIDE`` keys are computed, each key
from ``ROWS`` MinHash values, 2 * SIDE * ROWS values in all.  Every pair of a key of the first and one of the
second collection is a key of one of SIDE * SIDE tables of 2 * ROWS rows each: plain banding would need
SIDE * SIDE * 2 * ROWS MinHash values for as many tables.

A pair of documents with similarity s shares a table with probability (1 - (1 - s^ROWS)^SIDE)^2: all but 4 in
100,000 at s = 0.75 and all but 1 in a million at 0.8.  Every candidate is verified on the full shingle sets.

No bucket is expanded into all pairs.  Equal sets are one node.  Each bucket first ties its nodes to its most
central one, whose keys are the most frequent: among edited copies that is the text they were made from.  Nodes that
verified links have joined need no more tests.  Only nodes of a bucket that are still in different components can
add a link between components; tasks compare those that share a key of the first collection, block by block, by
``CHECKS`` more MinHash values of one byte and hand on the pairs only that agree in ``AGREE`` of 100.  A pair with
similarity 0.75 fails that once in 30,000 times, and one with 0.77 never in practice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastro.llm.components import components
from lastro.llm.text import split_words, text_of
from lastro.session import stored

SHINGLE = 5
SIDE = 20
ROWS = 3
PERCENT = 75
#: MinHash bytes that two nodes are compared by before their full sets are, and the share that has to agree, in percent.
CHECKS = 512
AGREE = 67
#: Nodes with one key that are compared in one task, with as many others.
BLOCK = 1024

_MULTIPLIERS = np.random.default_rng(20240501).integers(0, 1 << 63, 2 * SIDE * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CHECKERS = np.random.default_rng(20240503).integers(0, 1 << 63, CHECKS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = np.random.default_rng(20240502).integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Shingles hashed at a time, so that the working arrays stay in the processor's cache.
_RUN = 1 << 16
_KNOWN_WORDS = 1 << 19


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def shingle_set(text: str | None, hashes: dict) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text."""
    found = split_words(text)
    if not found:
        return np.empty(0, np.uint64)
    coded = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    width = min(SHINGLE, len(coded))
    total = np.full(len(coded) - width + 1, width, np.uint64)
    for place in range(width):
        total += coded[place : len(coded) - width + 1 + place] * _PLACES[place]
    return np.unique(_mix(total))


def _min_hashes(sets: list[np.ndarray], multipliers: np.ndarray) -> np.ndarray:
    values = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    least = np.empty((len(multipliers), len(sets)), np.uint64)
    for row, multiplier in enumerate(multipliers):
        least[row] = np.minimum.reduceat(values * multiplier, starts)
    return least


def min_hash_bytes(sets: list[np.ndarray]) -> np.ndarray:
    """``CHECKS`` bytes of each (non-empty) set."""
    return (_mix(_min_hashes(sets, _CHECKERS)) & np.uint64(255)).astype(np.uint8).T


def min_hash_keys(sets: list[np.ndarray]) -> np.ndarray:
    """2 * SIDE keys of each (non-empty) set."""
    least = _min_hashes(sets, _MULTIPLIERS)
    keys = np.zeros((2 * SIDE, len(sets)), np.uint64)
    for row in range(ROWS):
        keys = _mix(keys + least[row::ROWS] + np.arange(1, 2 * SIDE + 1, dtype=np.uint64)[:, None] * _MIX)
    return keys.T


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _WordHashes()
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        at, sets, size = 0, [], 0
        for i in range(batch.num_rows):
            sets.append(shingle_set(texts[i].as_py(), hashes))
            size += len(sets[-1])
            if size >= _RUN or i == batch.num_rows - 1:
                yield _sketch_batch(ids.slice(at, len(sets)), sets)
                at, sets, size = i + 1, [], 0


def _sketch_batch(ids: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
    full = [s for s in sets if len(s)]
    keys = iter(min_hash_keys(full) if full else ())
    digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
    return pa.record_batch({
        "id": ids,
        "n": pa.array([len(s) for s in sets], pa.int64()),
        "digest": pa.array(digests, pa.binary()),
        "keys": pa.array([next(keys).tobytes() if len(s) else None for s in sets], pa.binary()),
    })


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes with their key blobs -> one row per key."""
    for batch in batches:
        nodes = batch.column(0)
        for at in range(0, batch.num_rows, 4096):
            part = batch.column(1).slice(at, 4096).to_pylist()
            keys = np.frombuffer(b"".join(part), np.int64)
            place = np.repeat(np.arange(len(part)), 2 * SIDE)
            yield pa.record_batch({
                "node": nodes.slice(at, 4096).take(pa.array(place)),
                "key": pa.array(keys),
                "first": pa.array(np.tile(np.arange(2 * SIDE) < SIDE, len(part))),
            })


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _WordHashes()
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for at in range(0, batch.num_rows, 64):
            sets = [shingle_set(x.as_py(), hashes).tobytes() for x in texts.slice(at, 64)]
            yield pa.record_batch({"node": ids.slice(at, 64), "shingles": pa.array(sets, pa.binary())})


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for left, right in zip(batch.column(2), batch.column(3)):
            a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (left, right))
            if len(a) > len(b):
                a, b = b, a
            found = np.searchsorted(b, a)
            shared = int(np.count_nonzero(b[np.minimum(found, len(b) - 1)] == a)) if len(a) else 0
            keep.append(bool(shared) and 100 * shared >= PERCENT * (len(a) + len(b) - shared))
        yield pa.RecordBatch.from_arrays(batch.columns[:2], ["u", "v"]).filter(pa.array(keep, pa.bool_()))


def _first_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open nodes with their sets -> one row per key of the first collection, with all these keys and MinHash bytes."""
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in part.column("shingles")]
            codes = [x.tobytes() for x in min_hash_bytes(sets)]
            keys = np.frombuffer(b"".join(part.column("keys").to_pylist()), np.int64).reshape(len(sets), -1)[:, :SIDE]
            place = pa.array(np.repeat(np.arange(len(sets)), SIDE))
            known = pa.array([x.tobytes() for x in keys.astype(np.int32)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), pa.array(np.tile(np.arange(SIDE, dtype=np.int32), len(sets)))]
                + [part.column(c).take(place) for c in ("node", "component", "n")]
                + [known.take(place), pa.array(codes, pa.binary()).take(place)],
                ["key", "place", "node", "component", "n", "keys", "bytes"],
            )


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of key and part -> pairs of one part whose MinHash bytes agree well, across components.

    A part holds two blocks of the nodes with a key, or one: pairs within a block belong to the part of that block
    alone.  A pair with several keys in common is taken where the first of these is.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        marks = np.flatnonzero(np.diff(batch.column("key").to_numpy()) | np.diff(batch.column("part").to_numpy())) + 1
        at = 0
        for mark in [*marks, batch.num_rows]:
            run = batch.slice(at, mark - at)
            if held and (held[-1].column("key")[0], held[-1].column("part")[0]) != (run.column("key")[0], run.column("part")[0]):
                yield from _close_pairs(held)
                held = []
            held.append(run)
            at = mark
    if held:
        yield from _close_pairs(held)


def _close_pairs(runs: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(runs)
    component, n, block = (table[c].to_numpy() for c in ("component", "n", "block"))
    names, sizes = np.unique(component, return_counts=True)
    if len(names) < 2:
        return
    codes = np.frombuffer(b"".join(table["bytes"].to_pylist()), np.uint8).reshape(table.num_rows, -1)
    keys = np.frombuffer(b"".join(table["keys"].to_pylist()), np.int32).reshape(table.num_rows, -1)
    place, least, two = table["place"][0].as_py(), codes.shape[1] * AGREE // 100, block.min() != block.max()
    # Every pair across components has a member outside the largest one.
    small = np.flatnonzero(component != names[sizes.argmax()])
    us, vs = [], []
    for i in small:
        fits = (component != component[i]) & (100 * np.minimum(n, n[i]) >= PERCENT * np.maximum(n, n[i]))
        if two:
            fits &= block != block[i]
        others = np.flatnonzero(fits)
        others = others[~(keys[others, :place] == keys[i, :place]).any(axis=1)]
        # A few of the bytes sort most of them out.
        others = others[(codes[others, :64] == codes[i, :64]).sum(axis=1) >= 26]
        others = others[(codes[others] == codes[i]).sum(axis=1) >= least]
        us.append(np.full(len(others), i))
        vs.append(others)
    u, v = np.concatenate(us).astype(np.int64), np.concatenate(vs).astype(np.int64)
    nodes = table["node"].combine_chunks()
    yield pa.RecordBatch.from_arrays([nodes.take(pa.array(u)), nodes.take(pa.array(v))], ["u", "v"])


def _full_sets(pairs: DataFrame, texts: DataFrame, id_type: str) -> DataFrame:
    needed = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    # Always by a shuffle of ids and texts, whatever the number of ids: no broadcast that grows with the corpus.
    wanted = texts.join(needed.hint("merge"), texts["id"] == needed["node"], "left_semi")
    return stored(wanted.mapInArrow(_sets, f"node {id_type}, shingles binary"), "near-sets")


def _verified(pairs: DataFrame, sets: DataFrame, id_type: str) -> DataFrame:
    """Those pairs ``u, v`` whose full sets are similar enough."""
    # The set of v travels with each pair; that of u, which many pairs can share, is met last.
    half = pairs.join(sets.withColumnRenamed("shingles", "right"), F.col("v") == F.col("node")).drop("node")
    full = half.join(sets.withColumnRenamed("shingles", "left"), F.col("u") == F.col("node"))
    checked = full.select("u", "v", "left", "right").mapInArrow(_confirm, f"u {id_type}, v {id_type}")
    return stored(checked.distinct(), "near-links")


def cluster(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id`` and ``kept``.

    Words are runs of anything but ASCII white space, A-Z in lower case; a text of fewer than five words is one
    shingle of all its words.  Documents are linked when 100 * shared >= 75 * distinct shingles of both, and a
    component is named by the smallest id in it.  Null, empty and blank texts have no shingles and are alone.
    A row with a null id is alone too, its ``component_id`` is null and it is kept.  Rows that repeat an id
    share its component and are all kept or not.  An empty table gives no rows.  Other columns are ignored.

    Shingles are compared by 64-bit hashes, sets by 128-bit digests.
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    texts = docs.select(docs[id_column].alias("id"), text_of(docs[text_column]).alias("text"))
    sketches = stored(
        texts.mapInArrow(_sketches, f"id {id_type}, n bigint, digest binary, keys binary"), "near-sketches"
    )
    filled = sketches.where("id IS NOT NULL AND n > 0")
    # Equal sets have equal keys, whichever row they are taken from.
    nodes = stored(
        filled.groupBy("digest").agg(F.min("id").alias("node"), F.min("keys").alias("keys"), F.min("n").alias("n")), "near-nodes"
    )
    keys = nodes.select("node", "keys").mapInArrow(_expand, f"node {id_type}, key bigint, first boolean")
    shared = keys.groupBy("key").agg(F.count("*").alias("times")).where("times > 1").withColumnRenamed("key", "live")
    live = keys.join(shared, F.col("key") == F.col("live")).groupBy("node").agg(
        F.collect_set(F.when(F.col("first"), F.col("key"))).alias("a"),
        F.collect_set(F.when(~F.col("first"), F.col("key"))).alias("b"),
        F.sum("times").alias("central"),
    )
    tables = live.where("size(a) > 0 AND size(b) > 0").select("node", "central", F.explode("a").alias("a"), "b").select(
        "node", "central", "a", F.explode("b").alias("b")
    ).select("node", "central", F.xxhash64("a", "b").alias("bucket"))
    tables = stored(tables, "near-tables")
    leaders = tables.groupBy("bucket").agg(
        F.max_by("node", "central").alias("leader"), F.min("node").alias("least"), F.max("node").alias("last")
    )
    leaders = stored(leaders.where("least <> last").select(F.col("bucket").alias("met"), "leader"), "near-leaders")
    members = tables.join(leaders, F.col("bucket") == F.col("met")).select("bucket", "leader", "node")
    pairs = members.where("node <> leader").select(F.col("leader").alias("u"), F.col("node").alias("v")).distinct()
    pairs = stored(pairs, "near-pairs")
    sets = _full_sets(pairs, texts, id_type)
    links = _verified(pairs, sets, id_type)
    found = stored(components(links), "near-components")

    labelled = members.join(found.withColumnRenamed("node", "named"), F.col("node") == F.col("named"), "left").select(
        "bucket", "leader", "node", F.coalesce("component", "node").alias("component")
    )
    labelled = stored(labelled, "near-labelled")
    open_ = labelled.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    open_ = open_.where("least <> most").select(F.col("bucket").alias("open"))
    # The leader has been compared with all others of its bucket.
    rest = labelled.join(open_, F.col("bucket") == F.col("open")).where("node <> leader").select("node", "component").distinct()
    rest = stored(rest, "near-open").join(
        nodes.select(F.col("node").alias("known"), "n", "keys"), F.col("node") == F.col("known")
    ).join(sets.withColumnRenamed("node", "with_set"), F.col("node") == F.col("with_set"))
    rest = stored(rest.select("node", "component", "n", "keys", "shingles").mapInArrow(
        _first_keys, f"key bigint, place int, node {id_type}, component {id_type}, n bigint, keys binary, bytes binary"
    ), "near-open-keys")
    several = rest.groupBy("key").agg(
        F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("rows")
    ).where("least <> most").select(F.col("key").alias("open"), F.ceil(F.col("rows") / BLOCK).alias("blocks"))
    rest = rest.join(several, F.col("key") == F.col("open")).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    # A part for each two blocks, and for each block alone.
    part = F.explode(F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.least("block", other) * F.col("blocks") + F.greatest("block", other),
    ))
    rest = rest.select("key", "place", part.alias("part"), "block", "node", "component", "n", "keys", "bytes")
    across = rest.repartition("key", "part").sortWithinPartitions("key", "part").mapInArrow(
        _close, f"u {id_type}, v {id_type}"
    ).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    more = _verified(stored(across, "near-pairs"), sets, id_type)
    if not more.isEmpty():
        found = stored(components(links.unionByName(more)), "near-components")

    named = nodes.select("digest", "node").join(
        found.withColumnRenamed("node", "named"), F.col("node") == F.col("named"), "left"
    ).select(F.col("digest").alias("of"), F.coalesce("component", "node").alias("component"))
    named = stored(named, "near-named")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return sketches.join(named, F.col("digest") == F.col("of"), "left").select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents of which no near-duplicate with a smaller id exists in their component, with all columns."""
    gone = stored(cluster(docs, id_column, text_column).where("NOT kept").select(F.col(id_column).alias("_gone")), "near-gone")
    return docs.join(gone, docs[id_column] == gone["_gone"], "left_anti")
