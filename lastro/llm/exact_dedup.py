"""Exact deduplication by a 128-bit content hash whose groups are compared byte by byte."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastro.llm.text import lower_ascii, text_of
from lastro.session import stored


def content_hash(text: Column) -> Column:
    """128 bits of the normalised text."""
    return F.unhex(F.md5(text.cast("binary")))


def mark(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: str = "smallest",
    hashed: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when they are identical after lower-casing A-Z.  Each group keeps its smallest
    (or, with ``keep="largest"``, largest) id.  Documents are grouped by hash *and* text, so that a
    grouping compares the bytes of texts with one hash, and map tasks reduce the copies of a hot
    text to one row before anything is shuffled.

    A null text counts as empty; empty texts are equal to each other.  A null id is kept only where
    its whole group has none.  Repeated rows (same id, same text) count each and share one verdict.
    An empty table gives no rows.  Other columns are ignored, whatever their names.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be smallest or largest, not {keep}")
    plain = lower_ascii(text_of(docs[text_column]))
    hashes = docs.select(docs[id_column].alias("id"), plain.alias("plain"))
    hashes = hashes.select(
        "id", "plain", hashed(F.col("plain")).alias("hash128"), F.sha2(F.col("plain").cast("binary"), 256).alias("sha")
    )
    pick = F.min if keep == "smallest" else F.max
    texts = hashes.groupBy("hash128", "sha", "plain").agg(pick("id").alias("keep_id"), F.count("*").alias("size"))
    # Two texts below one hash differ in their SHA-256 too; a pair that shares both stops the run.
    groups = texts.groupBy("hash128", "sha").agg(
        F.max("keep_id").alias("keep_id"), F.max("size").alias("size"), F.count("*").alias("texts")
    )
    sure = F.when(F.col("texts") == 1, F.col("size")).otherwise(F.raise_error(F.lit("two texts share both hashes")))
    # Stored, so that both sides of the join come straight from a shuffle and a hot hash can be split.
    groups = stored(groups.select("hash128", "sha", "keep_id", sure.alias("size")), "exact-groups")
    narrow = hashes.select("id", "hash128", "sha")
    return narrow.join(groups, ["hash128", "sha"]).select(
        F.col("id").alias(id_column),
        F.col("keep_id"),
        F.col("size").cast("long").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "smallest") -> DataFrame:
    """The documents that stay, with all their columns; of fully repeated rows one stays."""
    marked = stored(
        mark(docs, id_column, text_column, keep)
        .where("kept")
        .groupBy(F.col(id_column).alias("_id"), F.col("text_sha256").alias("_sha"))
        .agg(F.count("*").alias("_rows")),
        "exact-kept",
    )
    digest = F.sha2(lower_ascii(text_of(docs[text_column])).cast("binary"), 256)
    joined = docs.join(marked, docs[id_column].eqNullSafe(marked["_id"]) & (digest == marked["_sha"]))
    stay = joined.where("_rows = 1").select(*[docs[c] for c in docs.columns])
    repeated = marked.where("_rows > 1")
    if repeated.isEmpty():
        return stay
    again = joined.where("_rows > 1").dropDuplicates(["_id", "_sha"]).select(*[docs[c] for c in docs.columns])
    return stay.unionByName(again)
