"""Lloyd's clustering with vectors cut by dimension: every shard holds some columns of all vectors.

Vectors are stored once as integer matrices, one row per chunk of vectors and shard of columns, dealt to tasks by both.
In every round a shard's tasks compute exact partial distances to its slices of the centroids; these are added by chunk
and give the nearest centroid of every vector; the labels, a few bytes a vector, go back to where the columns lie, and
each shard sums its own columns by label for its slice of the new centroids.  Columns never move between rounds.

All numbers are 64-bit integers, so nothing depends on the order of additions.  What is small by its parameters, clusters
times dimensions, goes through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastro.session import releasing_shuffles, stored

#: Vectors of a chunk.
CHUNK = 4096
#: Components are multiplied by this and rounded down.
SCALE = 1024
#: Largest scaled component, so that no squared distance leaves 64 bits (times the number of dimensions).
LARGEST = 1 << 62


def usable(vectors: DataFrame, id_column: str, vector_column: str, dims: int) -> DataFrame:
    """``id, vector`` of the vectors with ``dims`` components, all of them finite numbers."""
    vector = vectors[vector_column].cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(vectors[id_column].alias("id"), vector.alias("vector")).where(
        F.col("vector").isNotNull() & (F.size("vector") == dims) & finite
    )


def _scaled(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    wide = np.floor(batch.column("vector").flatten().to_numpy().reshape(-1, dims) * SCALE)
    if len(wide) and 4 * dims * float(np.abs(wide).max()) ** 2 >= LARGEST:
        raise ValueError("a component is too large for distances of 64 bits")
    return wide.astype(np.int64)


def _slices(dims: int, shards: int) -> list[slice]:
    edges = [dims * s // shards for s in range(shards + 1)]
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


def _shard(dims: int, shards: int):
    """Vectors -> chunks, each as one row per shard; the first shard's row names the vectors."""

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                part = batch.slice(start, CHUNK)
                values, n = _scaled(part, dims), part.num_rows
                small = "<i2" if np.abs(values).max() < 1 << 15 else "<i8"
                named = part.column("id")
                yield pa.record_batch({
                    "chunk": pa.array([chunk] * shards, pa.int64()), "shard": pa.array(range(shards), pa.int32()),
                    "rows": pa.array([n] * shards, pa.int32()),
                    "ids": pa.ListArray.from_arrays(pa.array([0] + [n] * shards, pa.int32()), named),
                    "columns": pa.array([values[:, s].astype(small).tobytes() for s in _slices(dims, shards)], pa.binary()),
                })
                chunk += 1

    return shard


def _columns(data: bytes, rows: int, width: int) -> np.ndarray:
    small = "<i2" if len(data) == 2 * rows * width else "<i8"
    return np.frombuffer(data, small).reshape(rows, width).astype(np.int64)


def _distances(centroids: np.ndarray, shards: int):
    """Columns -> squared distances to each centroid within the shard's dimensions."""
    own = _slices(centroids.shape[1], shards)

    def distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for shard, rows, data in zip(*(batch.column(c).to_pylist() for c in ("shard", "rows", "columns"))):
                there = centroids[:, own[shard]]
                x = _columns(data, rows, there.shape[1])
                found = np.stack([np.square(x - c).sum(axis=1) for c in there])
                parts.append(found.astype("<u4" if found.max(initial=0) < 1 << 32 else "<u8").tobytes())
            yield pa.record_batch({
                "chunk": batch.column("chunk"), "rows": batch.column("rows"), "part": pa.array(parts, pa.binary()),
            })

    return distances


def _nearest(k: int):
    """The partial distances of one chunk, added; the nearest centroid of each vector, the smaller number on a tie."""

    def nearest(table: pa.Table) -> pa.Table:
        rows, total = table["rows"][0].as_py(), 0
        for data in table["part"].to_pylist():
            total = total + np.frombuffer(data, "<u4" if len(data) == 4 * k * rows else "<u8").astype(np.int64).reshape(k, rows)
        labels = np.argmin(total, axis=0)
        return pa.table({
            "chunk": table["chunk"][:1], "labels": pa.array([labels.tolist()], pa.list_(pa.int32())),
            "distances": pa.array([total[labels, np.arange(rows)].tolist()], pa.list_(pa.int64())),
        })

    return nearest


def _sums(k: int, dims: int, shards: int):
    """Columns with labels -> the sums of a task, by dimension and cluster."""
    own = _slices(dims, shards)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros((dims, k), np.int64), np.zeros((dims, k), np.int64)
        for batch in batches:
            plain = (batch.column(c).to_pylist() for c in ("shard", "rows", "columns"))
            for shard, rows, data, labels in zip(*plain, batch.column("labels")):
                label = labels.values.to_numpy()
                x = _columns(data, rows, own[shard].stop - own[shard].start)
                order = np.argsort(label, kind="stable")
                some, first, n = np.unique(label[order], return_index=True, return_counts=True)
                totals[own[shard], some] += np.add.reduceat(x[order], first, axis=0).T
                counts[own[shard], some] += n
        dim, cluster = np.nonzero(counts)
        yield pa.record_batch({
            "dim": pa.array(dim.astype(np.int32)), "cluster": pa.array(cluster.astype(np.int32)),
            "total": pa.array(totals[dim, cluster]), "n": pa.array(counts[dim, cluster]),
        })

    return sums


def _first_centroids(kept: DataFrame, k: int, seed: int, dims: int) -> np.ndarray:
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    first = kept.withColumn("hash", F.sha2(name.cast("binary"), 256)).orderBy("hash", "vector").limit(k).select("vector")
    found = [_scaled(batch, dims) for batch in first.toArrow().to_batches()]
    return np.concatenate([np.zeros((0, dims), np.int64), *found])


def cluster(
    vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, seed: int = 3, shards: int = 4,
    id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """One row per usable vector: id, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    Usable are vectors of exactly ``dims`` components, none null or not finite; components become floor(1024 x).
    The first centroids are the ``k`` vectors with the smallest SHA-256 of ``seed:id``.  Every round takes each vector
    to the nearest centroid, the smaller number on a tie, and moves each centroid to the floors of the means of its
    vectors; a centroid without vectors stays.  After the last round vectors are assigned once more.

    With fewer than ``k`` vectors there are as many centroids; without any the result is empty.  Repeated rows are
    vectors of their own; a null id hashes as an empty one.  Other columns are ignored, whatever their names.  A component
    so large that squared distances might leave 64 bits is an error.
    """
    spark = vectors.sparkSession
    shards = max(1, min(shards, dims))
    id_type = vectors.schema[id_column].dataType.simpleString()
    kept = usable(vectors, id_column, vector_column, dims)
    centroids = _first_centroids(kept, k, seed, dims)
    k = len(centroids)
    layout = f"chunk bigint, shard int, rows int, ids array<{id_type}>, columns binary"
    held = stored(kept.mapInArrow(_shard(dims, shards), layout), "centroids-columns")
    named = held.where("shard = 0").select("chunk", "ids")
    if not k:
        return named.selectExpr(
            f"explode(ids) AS {id_column}", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia", "'' AS centroid_sha256"
        )
    # Dealt by chunk and shard once and kept so: rounds send labels to the columns, not columns to the labels.
    dealt = held.drop("ids").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "chunk", "shard").persist()

    def assigned() -> DataFrame:
        parts = dealt.mapInArrow(_distances(centroids, shards), "chunk bigint, rows int, part binary")
        return parts.groupBy("chunk").applyInArrow(_nearest(k), "chunk bigint, labels array<int>, distances array<bigint>")

    try:
        for _ in range(rounds):
            labels = assigned().select("chunk", "labels", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
            summed = dealt.join(labels.hint("shuffle_hash"), ["chunk", "shard"]).select("shard", "rows", "columns", "labels")
            summed = summed.mapInArrow(_sums(k, dims, shards), "dim int, cluster int, total bigint, n bigint")
            with releasing_shuffles(spark):
                moved = summed.groupBy("dim", "cluster").agg(F.sum("total"), F.sum("n")).collect()
            centroids = centroids.copy()
            for dim, number, total, n in moved:
                centroids[number, dim] = total // n
        final = stored(assigned(), "centroids-assigned")
    finally:
        dealt.unpersist()
    rows = final.join(named, "chunk").select(F.explode(F.arrays_zip("ids", "labels", "distances")).alias("r")).select("r.*")
    inertia = dict(rows.groupBy("labels").agg(F.sum("distances")).collect())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    by_cluster = lambda values: F.get(F.array(*map(F.lit, values)), F.col("labels"))
    return rows.select(
        F.col("ids").alias(id_column), F.col("labels").alias("cluster"), F.col("distances").alias("distance"),
        by_cluster([inertia.get(c, 0) for c in range(k)]).cast("long").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"), by_cluster(digests).alias("centroid_sha256"),
    )
