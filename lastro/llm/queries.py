"""The registered queries of this package, one for each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lastro.llm import centroids, content, exact_dedup, katz, mixing, near_dedup, packing, pii, quality, ranked, repeats, rules, urls

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _fold(name: str) -> Column:
    return F.pmod(F.crc32(F.col(name).cast("string").cast("binary")), F.lit(5))


@query
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.mark(table(spark, folder, "documents"), keep="largest")


SQL["op1_exact_dedup"] = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS plain
  FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
  sha256(plain) AS text_sha256
FROM t WINDOW g AS (PARTITION BY plain)
"""


@query
def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


@query
def op3_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.cluster(table(spark, folder, "documents"))


@query
def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(table(spark, folder, "documents"))
    number = lambda kind: F.size(F.filter("base", lambda c: c["k"] == pii.KINDS.index(kind))).cast("long")
    return found.select(
        "doc_id", *[number(k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(pii.listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


@query
def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"))


@query
def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.plan(table(spark, folder, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", "taken", F.col("draws")["shard"].alias("shards"),
        F.col("draws")["position"].alias("positions"),
    )


@query
def op7_katz(spark: SparkSession, folder: str) -> DataFrame:
    train = _fold("doc_id") != 1
    return katz.score(table(spark, folder, "documents"), train, order=3)


@query
def op8_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return content.main_text(table(spark, folder, "pages"))


@query
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    ledger = rules.ledger(table(spark, folder, "documents"))
    base, verdict = rules.POLICIES["base"], rules.POLICIES["v1"]
    base_failed = ~rules.passes(F.col("_bits"), base)
    return ledger.select(
        F.col("_row.doc_id").alias("doc_id"), "_m.n_words", "_m.word_chars", "_m.n_symbols", "_m.n_dup_lines",
        "_m.n_repeat_words", base_failed.alias("base_failed"),
        (~base_failed & rules.passes(F.col("_bits"), verdict)).alias("kept"), F.col("_bits").alias("failed_rules"),
    )


@query
def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score(table(spark, folder, "documents"), table(spark, folder, "labels"), _fold("doc_id") != 0)


@query
def op11_ranked(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=10)


SQL["op11_ranked"] = """
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM documents
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM benchmark
), whole AS (SELECT count(DISTINCT r) AS docs, count(*) AS total FROM d),
n AS (SELECT r, count(*) AS n FROM d GROUP BY r),
tf AS MATERIALIZED (SELECT r, doc_id, term, count(*) AS tf FROM d WHERE term IN (SELECT term FROM q) GROUP BY r, doc_id, term),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM tf, whole GROUP BY term, docs
), scored AS (
  SELECT item_id, doc_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN n USING (r), whole GROUP BY item_id, doc_id, r
), placed AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 10
"""


@query
def op12_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster(table(spark, folder, "embeddings"), k=8, rounds=10, dims=64, seed=3)


def _lloyd_sql(rounds: int) -> str:
    """All rounds one after the other, with vectors as lists of integers."""
    nearest = """SELECT r, arg_min(c, d * 8 + c) AS c, min(d) AS d FROM (
      SELECT r, c, list_sum(list_transform(list_zip(v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
      FROM kept, m{i}) x GROUP BY r"""
    steps = [
        """raw AS (SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE len(embedding) = 64)""",
        """kept AS MATERIALIZED (
      SELECT r, vec_id, list_transform(e, lambda x: floor(1024 * x)::BIGINT) AS v FROM raw
      WHERE len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        """m0 AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS m FROM (
        SELECT sha256('3:' || vec_id) AS h, v FROM kept ORDER BY h, v LIMIT 8) x)""",
    ]
    for i in range(rounds):
        steps.append(f"a{i} AS MATERIALIZED ({nearest.format(i=i)})")
        steps.append(f"""m{i + 1} AS MATERIALIZED (
      SELECT c, coalesce(moved, m) AS m FROM m{i} LEFT JOIN (
        SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY j) AS moved FROM (
          SELECT c, j, sum(x)::BIGINT AS s, count(*) AS n FROM (
            SELECT c, unnest(v) AS x, unnest(range(64)) AS j FROM kept JOIN a{i} USING (r)) y GROUP BY c, j) z GROUP BY c) t USING (c))""")
    steps.append(f"last AS MATERIALIZED ({nearest.format(i=rounds)})")
    return "WITH " + ", ".join(steps) + f"""
    SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
      (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
    FROM kept JOIN last USING (r) JOIN m{rounds} USING (c)"""


SQL["op12_centroids"] = _lloyd_sql(10)


@query
def op13_repeats(spark: SparkSession, folder: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, folder, "documents"))
    removed = F.aggregate(F.zip_with("ends", "starts", lambda e, s: e - s), F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"),
        F.sha2(F.col("kept"), 256).alias("kept_sha256"),
    )
