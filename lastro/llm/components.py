"""Connected components of a table of links, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastro.session import stored


def _min_neighbour(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("least"))
    return links.join(least.withColumnRenamed("u", "u_"), F.col("u") == F.col("u_")).drop("u_")


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node around it."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = _min_neighbour(both)
    return near.where("v > u").select(F.col("v").alias("u"), F.least("u", "least").alias("v")).where("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them; here u > v in every link."""
    near = _min_neighbour(links)
    return (
        near.select(F.explode(F.array(F.col("u"), F.col("v"))).alias("u"), F.col("least").alias("v"))
        .where("u <> v").distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """``u, v`` -> ``node, component``, the smallest node reachable, for every node with a link.

    Alternating large and small stars: in every step the links of a node point to smaller nodes, until
    each component is a star around its smallest node.  Each step is written to the shared folder.
    Self links and links with a null end are ignored.
    """
    ends = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = stored(ends.where("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct(), "links")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen:
            break
        seen = tuple(mark)
        now = stored(_small_star(_large_star(now)), "links")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
