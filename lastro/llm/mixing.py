"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. Every source gets a target in words: its weight's share of the mix, at most ``max_passes`` times its size.
2. Its documents are dealt to blocks by a hash.  A pass takes every block once; the last, partial pass takes
   blocks in a permuted order until the target is met, the last block in part.
3. The drawn blocks of all sources are split among the output shards by a tree: a node with N blocks sends n of
   them to its left half, and how many of each source go is a multivariate-hypergeometric draw (the sources of
   the n blocks with the smallest hashes).  The tree works on block counts only.
4. Each shard then takes that many of the source's blocks in permuted order; documents are ordered by a hash
   within their shard.

Blocks are sized so that there are about ``MAX_BLOCKS`` of them and as many as there are sources at most,
whatever the size of the corpus; only these counts ever meet in one window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lastro.llm.text import n_words, text_of
from lastro.session import stored

MAX_BLOCKS = 1 << 16
LEAST_BLOCK_WORDS = 1 << 14


def _hash(*columns: Column | str | int) -> Column:
    return F.xxhash64(*[F.lit(c) if isinstance(c, int) else c for c in columns])


def targets(sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``source, source_size`` -> these and ``target``, the words the mix takes of each source.

    Sources in code-point order (null last) weigh ``weights``, repeating, and share ``share`` times all words.
    A target stops at ``cap`` times its source's size; the excess goes to the others by weight.  The result
    of that resharing is min(cap * size, level * weight) for one level, found in order of cap * size / weight.
    One row per source meets in one window.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int"))
    full = Window.orderBy("reach", "source").rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy("reach", "source").rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    table = sizes.withColumn("weight", weight).withColumn("most", cap * F.col("source_size"))
    table = table.withColumn("reach", F.col("most") / F.col("weight"))
    table = table.withColumn("total", share * F.sum("source_size").over(everything))
    table = table.withColumn(
        "level_here", (F.col("total") - F.coalesce(F.sum("most").over(full), F.lit(0.0))) / F.sum("weight").over(rest)
    )
    # The first source that the level left over for it and all later ones does not fill sets the level.
    first = F.min(F.when(F.col("level_here") <= F.col("reach"), F.struct("reach", "level_here"))).over(everything)
    table = table.withColumn("level", first["level_here"])
    level = F.when(F.col("level").isNull(), F.col("most")).otherwise(F.least("most", F.col("level") * F.col("weight")))
    return table.select("source", "source_size", level.cast("double").alias("target"))


def split_tree(quotas: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """``source, quota`` (blocks) -> ``source, shard, quota``; exact, and shards differ by one block at most.

    ``shards`` has to be a power of two.  Each level of the tree enumerates the blocks of a node, takes the
    half with the smallest hashes to the left and counts sources on both sides, which is an exact draw.
    """
    if shards < 1 or shards & (shards - 1):
        raise ValueError("shards must be a power of two")
    nodes = quotas.select("source", F.lit(0).alias("shard"), F.col("quota").cast("long").alias("quota"))
    level = 1
    while level < shards:
        items = nodes.where("quota > 0").select("source", "shard", F.expr("explode(sequence(1L, quota))").alias("item"))
        drawn = F.row_number().over(
            Window.partitionBy("shard").orderBy(_hash("source", "shard", "item", level, seed), "source", "item")
        )
        half = F.count("*").over(Window.partitionBy("shard")) / 2
        side = F.when(drawn <= F.ceil(half), F.lit(0)).otherwise(F.lit(1))
        nodes = items.withColumn("side", side).groupBy("source", (2 * F.col("shard") + F.col("side")).alias("shard")).agg(
            F.count("*").alias("quota")
        )
        level *= 2
    return nodes


def plan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    max_passes: int = 2,
    shards: int = 16,
    seed: int = 0,
) -> DataFrame:
    """One row per document: its ``size``, ``source_size``, ``target``, the words ``taken`` of it, and
    ``draws``, an array of (pass, shard, position, words), one for each time that the mix takes it.

    A null text has size 0 and is taken whole, without words, in full passes only; a null source is a source
    of its own, last in order.  Null ids are ordinary.  Documents are taken whole: one within which a target falls
    is taken where that comes nearer to the target, so a source misses its own by half a document at most (rows that
    repeat the very same document go together).  Every choice is a hash of id and source, so reruns agree.  An empty
    table gives no rows.
    """
    rows = stored(
        docs.select(
            docs[id_column].alias("id"), docs[source_column].alias("source"), n_words(docs[text_column]).alias("size"),
        ).withColumn("order", _hash("id", "source", seed)),
        "mix-sizes",
    )
    goals = stored(targets(
        rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, float(max_passes)
    ), "mix-targets")
    block_words = F.greatest(
        F.lit(float(LEAST_BLOCK_WORDS)), F.sum("source_size").over(Window.partitionBy()) / MAX_BLOCKS
    )
    goals = goals.withColumn("n_blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("long"))
    goals = goals.withColumn("want", F.round("target").cast("long")).withColumn(
        "passes", F.when(F.col("source_size") > 0, F.floor(F.col("want") / F.col("source_size"))).otherwise(0).cast("long")
    ).withColumn("rest", F.col("want") - F.col("passes") * F.col("source_size"))
    # Sources are many fewer than documents, but their number has no bound: the join is left to the planner.
    placed = rows.join(goals, rows["source"].eqNullSafe(goals["source"])).select(
        rows["source"], "id", "size", "order", "source_size", "target", "n_blocks", "passes", "rest",
        F.pmod(_hash("order", 1), F.col("n_blocks")).alias("block"),
    )
    # Cumulated words in permuted order: blocks of a source first, then documents of the block that is cut.
    blocks = stored(placed.groupBy("source", "block", "passes", "rest").agg(
        F.sum("size").alias("words"), F.count("*").alias("n")
    ), "mix-blocks")
    permuted = Window.partitionBy("source").orderBy(_hash("source", "block", seed), "block")
    before = F.sum("words").over(permuted) - F.col("words")
    blocks = blocks.withColumn("before", before).withColumn("permuted", F.row_number().over(permuted))
    blocks = blocks.withColumn(
        "left", F.greatest(F.lit(0), F.least(F.col("rest") - F.col("before"), F.col("words")))
    ).withColumn("drawn", F.col("left") > 0)
    blocks = blocks.withColumn("quota", F.col("passes") + F.col("drawn").cast("long"))
    blocks = stored(blocks, "mix-plan")

    shares = split_tree(blocks.groupBy("source").agg(F.sum("quota").alias("quota")), shards, seed)
    # The source's draws in permuted order: all blocks of a full pass, then the next pass, the partial one last.
    draws = blocks.where("quota > 0").withColumn("pass", F.explode(F.sequence(F.lit(1), F.col("quota").cast("int"))))
    place = F.row_number().over(Window.partitionBy("source").orderBy("pass", "permuted"))
    draws = draws.select("source", "block", "pass", place.alias("place"))
    ends = shares.withColumn("end", F.sum("quota").over(Window.partitionBy("source").orderBy("shard")))
    ends = ends.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("end", "shard"))).alias("ends"))
    ends = ends.withColumnRenamed("source", "e_source")
    dealt = draws.join(ends, F.col("source").eqNullSafe(F.col("e_source"))).select(
        F.col("source").alias("b_source"), F.col("block").alias("b_block"), F.struct(
            F.col("pass"), F.expr("filter(ends, x -> x.end >= place)[0].shard").cast("int").alias("shard")
        ).alias("draw"),
    ).groupBy("b_source", "b_block").agg(F.sort_array(F.collect_list("draw")).alias("block_draws"))
    met = F.col("source").eqNullSafe(F.col("b_source")) & (F.col("block") == F.col("b_block"))
    dealt = stored(
        blocks.join(dealt, met, "left").select(
            F.col("source").alias("b_source"), F.col("block").alias("b_block"), "left", "words", "block_draws"
        ),
        "mix-draws",
    )
    joined = placed.join(dealt, met).drop("b_source", "b_block")
    # Blocks that a target cuts: one of each source at most.
    cut = (F.col("left") > 0) & (F.col("left") < F.col("words"))
    upto = F.sum("size").over(Window.partitionBy("source").orderBy("order", "id"))  # with all rows of one order and id
    alike = F.sum("size").over(Window.partitionBy("source", "order", "id"))
    whole = joined.where(~cut).withColumn("extra", F.when(F.col("left") > 0, F.col("size")).otherwise(0))
    part = joined.where(cut).withColumn("alike", alike).withColumn("seen", upto - F.col("alike")).withColumn(
        "extra", F.when(2 * (F.col("left") - F.col("seen")) > F.col("alike"), F.col("size")).otherwise(0)
    ).drop("seen", "alike")
    both = whole.unionByName(part)
    listed = F.filter(
        F.transform(F.coalesce("block_draws", F.array()), lambda x: F.struct(
            x["pass"].alias("pass"), x["shard"].alias("shard"),
            F.xxhash64(F.col("order"), x["pass"], x["shard"]).alias("position"),
            F.when(x["pass"] <= F.col("passes"), F.col("size")).otherwise(F.col("extra")).cast("long").alias("words"),
        )),
        lambda x: (x["pass"] <= F.col("passes")) | (x["words"] > 0),
    )
    return both.select(
        F.col("id").alias(id_column), "source", F.col("size").cast("long"), F.col("source_size").cast("long"), "target",
        (F.col("passes") * F.col("size") + F.col("extra")).cast("long").alias("taken"), listed.alias("draws"),
    )


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", **settings) -> DataFrame:
    """The mixed corpus: a whole document for each draw, with the columns of ``docs``.

    Rows are dealt to partitions by shard and by a range of positions within it, and lie there in drawn order; ``plan``
    has the numbers.
    """
    drawn = plan(docs, id_column, text_column, source_column, **settings)
    drawn = stored(drawn.select(
        F.col(id_column).alias("_id"), F.col("source").alias("_source"), F.explode("draws").alias("_draw"),
        F.col("size").alias("_size"),
    ).groupBy("_id", "_source", "_size", "_draw").agg(F.count("*").alias("_rows")).groupBy("_id", "_source", "_size", "_rows").agg(
        F.collect_list("_draw").alias("_draws")
    ), "mix-drawn")
    names = docs.columns
    joined = docs.join(
        drawn,
        docs[id_column].eqNullSafe(drawn["_id"]) & docs[source_column].eqNullSafe(drawn["_source"])
        & (n_words(docs[text_column]) == drawn["_size"]),
    )
    taken = joined.select(*[docs[c].alias(f"_{i}") for i, c in enumerate(names)], F.explode("_draws").alias("_draw"))
    # 64 ranges of positions keep a shard from being one task.
    dealt = taken.repartition("_draw.shard", F.shiftright("_draw.position", 58)).sortWithinPartitions("_draw.shard", "_draw.position")
    return dealt.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(names)])
