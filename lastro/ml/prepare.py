"""Model input: feature selection, stratified split, imputation, ordinal codes, weights.

Everything fitted here is fitted on the train rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lastro import contracts
from lastro.functions.text import unknown_if_null
from lastro.operators.joins import is_small, key_counts, left_join_many_to_one
from lastro.operators.ranking import exact_quantiles
from lastro.session import scratch_path

TEST_SHARE, SEED = 0.2, 42
ROW_ID = "id_boleto"


def select_features(df: DataFrame) -> DataFrame:
    """Row id, target and the safe features that exist."""
    kept = [c for c in (ROW_ID, contracts.TARGET, *contracts.SAFE_FEATURES) if c in df.columns]
    return df.select(*kept)


def leaky_columns(df: DataFrame) -> list[str]:
    """Columns of the table that would give the outcome away."""
    return sorted(set(contracts.LEAKY) & set(df.columns))


def leakage_audit(df: DataFrame) -> DataFrame:
    """Every known leaky column: whether the table has it, and how many values it would leak."""
    known = sorted(contracts.LEAKY)
    counts = [
        (F.count(c) if c in df.columns else F.count(F.lit(None))).alias(c) for c in known
    ]
    cells = F.array(*[
        F.struct(
            F.lit(c).alias("column"), F.lit(c in df.columns).alias("present"),
            F.col(c).alias("values"),
        )
        for c in known
    ])
    return df.agg(*counts).select(F.explode(cells).alias("c")).select("c.*")


#: Hexadecimal digits by which a search for a cut goes on at a time.
_DIGITS = 3


def id_hash(seed: int = SEED) -> Column:
    """32 hexadecimal digits of seed and row id; the same in any engine that knows MD5."""
    return F.md5(F.concat_ws(":", F.lit(seed), F.col(ROW_ID)).cast("binary"))


def _cuts(df: DataFrame, hashed: Column, ranks: dict[int, int]) -> dict[int, str]:
    """For each label the text below which exactly its ``rank`` smallest hashes lie.

    A radix selection: hashes are counted by their first digits, the group that holds the rank is counted by the next
    ones, until a group ends at the rank.  Each pass brings at most ``16 ** _DIGITS`` counts per label to the driver.
    """
    label, prefixes, left = F.col(contracts.TARGET), dict.fromkeys(ranks, ""), dict(ranks)
    cuts = {value: "" for value, rank in ranks.items() if rank <= 0}
    while open_labels := [value for value in ranks if value not in cuts]:
        size = len(prefixes[open_labels[0]]) + _DIGITS
        within = [(label == value) & F.startswith(hashed, F.lit(prefixes[value])) for value in open_labels]
        counted: dict[int, list] = {value: [] for value in open_labels}
        rows = df.where(reduce(Column.__or__, within)).groupBy(label.alias("label"), F.substring(hashed, 1, size).alias("start"))
        for value, start, n in rows.count().collect():
            counted[value].append((start, n))
        for value in open_labels:
            for start, n in sorted(counted[value]):
                if left[value] <= n:
                    prefixes[value] = start
                    break
                left[value] -= n
            if left[value] == n or size >= 32:
                cuts[value] = prefixes[value] + "g"     # after every text that starts so
    return cuts


def stratified_split(df: DataFrame, test_share: float = TEST_SHARE, seed: int = SEED) -> DataFrame:
    """Add ``split``: the rows with the smallest id hashes of each label become the test rows.

    Of n rows of a label the first ceil(n * share) are test rows, at any size; rows with one id stay together.  The
    hash depends on the id alone, so a row keeps its side however the table is partitioned.  Rows without a label are
    train rows.
    """
    label = F.col(contracts.TARGET)
    counts = df.where(label.isin(0, 1)).groupBy(label.alias("label")).count().collect()
    ranks = {r["label"]: math.ceil(r["count"] * test_share - 1e-9) for r in counts}
    hashed = id_hash(seed)
    is_test = F.lit(False)
    for value, cut in _cuts(df, hashed, ranks).items():
        is_test = is_test | ((label == value) & (hashed < cut))
    return df.withColumn("split", F.when(is_test, "test").otherwise("train"))


def split_by(df: DataFrame, is_test: Column) -> DataFrame:
    """Add ``split`` from a given condition."""
    return df.withColumn("split", F.when(is_test, "test").otherwise("train"))


def split_audit(df: DataFrame) -> DataFrame:
    """Rows, default rate and class ratio per split."""
    rate = F.avg(contracts.TARGET)
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(contracts.TARGET).alias("defaulted"),
        rate.alias("default_rate"),
        F.try_divide(1 - rate, rate).alias("imbalance"),
    )


def feature_audit(df: DataFrame) -> DataFrame:
    """Features with at most one distinct value, and features that still hold nulls."""
    features = [c for c in contracts.SAFE_FEATURES if c in df.columns]
    measures = []
    for c in features:
        measures += [
            F.min(c).alias(f"{c}|min"), F.max(c).alias(f"{c}|max"),
            F.count_if(F.col(c).isNull()).alias(f"{c}|nulls"),
        ]
    cells = F.array(*[
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"{c}|min").eqNullSafe(F.col(f"{c}|max")).alias("zero_variance"),
            F.col(f"{c}|nulls").alias("nulls"),
        )
        for c in features
    ])
    return df.agg(*measures).select(F.explode(cells).alias("c")).select("c.*")


def fit_medians(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median per numeric column: ``series``, ``q0``."""
    return exact_quantiles(train, {c: F.col(c) for c in columns}, [0.5])


def fit_categories(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Ordinal code of each category: ``column``, ``value``, ``code``, in text order from 0.

    Only distinct values are ranked.  They are ranked among the values with the same first
    two characters and moved up by the number of values with smaller ones, so no task
    has to sort all values of a column.
    """
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), unknown_if_null(F.col(c)).alias("value"))
        for c in columns
    ])
    values = train.select(F.explode(cells).alias("c")).select("c.*").distinct()
    values = values.withColumn("_start", F.substring("value", 1, 2))
    within = F.row_number().over(Window.partitionBy("column", "_start").orderBy("value"))
    smaller = Window.partitionBy("column").orderBy("_start").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = values.groupBy("column", "_start").agg(F.count(F.lit(1)).alias("_n")).select(
        "column", "_start", F.coalesce(F.sum("_n").over(smaller), F.lit(0)).alias("_before")
    )
    code = (F.col("_before") + within - 1).cast("double").alias("code")
    return values.join(starts, ["column", "_start"]).select("column", "value", code)


@dataclass(frozen=True)
class Preprocessor:
    """Fitted medians and category codes; both tables live in files."""

    medians: DataFrame
    categories: DataFrame
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]

    @staticmethod
    def fit(train: DataFrame, path: str | None = None) -> Preprocessor:
        """Fit on the train rows and store the result under ``path``."""
        spark = train.sparkSession
        path = path or scratch_path(spark, "preprocessor")
        numeric = [c for c in contracts.NUMERIC_FEATURES if c in train.columns]
        categorical = [c for c in contracts.CATEGORICAL_FEATURES if c in train.columns]
        fit_medians(train, numeric).write.mode("overwrite").parquet(f"{path}/medians")
        fit_categories(train, categorical).write.mode("overwrite").partitionBy("column").parquet(
            f"{path}/categories"
        )
        fitted = Preprocessor.load(spark, path)
        empty = set(numeric) - set(fitted.numeric)
        if empty:
            raise ValueError(f"no values to take a median of: {sorted(empty)}")
        return fitted

    @staticmethod
    def load(spark: SparkSession, path: str) -> Preprocessor:
        medians = spark.read.parquet(f"{path}/medians")
        categories = spark.read.parquet(f"{path}/categories")
        numeric = {r["series"] for r in medians.select("series").collect()}
        categorical = {r["column"] for r in categories.select("column").distinct().collect()}
        return Preprocessor(
            medians, categories,
            tuple(c for c in contracts.NUMERIC_FEATURES if c in numeric),
            tuple(c for c in contracts.CATEGORICAL_FEATURES if c in categorical),
        )

    @property
    def feature_columns(self) -> tuple[str, ...]:
        return self.numeric + self.categorical

    def transform(self, df: DataFrame) -> DataFrame:
        """Fill numeric nulls and replace categories by codes, -1 for unseen ones."""
        # One median per numeric feature of the contract, so this reads at most 20 rows.
        medians = {r["series"]: r["q0"] for r in self.medians.collect()}
        df = df.withColumns({
            c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c])) for c in self.numeric
        })
        df = df.withColumns({c: unknown_if_null(F.col(c)) for c in self.categorical})
        tables = {
            c: self.categories.where(F.col("column") == c).select(F.col("value").alias(c), F.col("code").alias("_code"))
            for c in self.categorical
        }
        large = [c for c, codes in tables.items() if not is_small(codes)]
        counts = key_counts(df, large) if large else {}
        for c, codes in tables.items():
            joined = left_join_many_to_one(df, codes, c, ROW_ID, counts=counts.get(c))
            df = joined.withColumn(c, F.coalesce("_code", F.lit(-1.0))).drop("_code")
        return df

    def assemble(self, df: DataFrame) -> DataFrame:
        """``transform`` and one ``features`` vector."""
        assembler = VectorAssembler(
            inputCols=list(self.feature_columns), outputCol="features"
        )
        return assembler.transform(self.transform(df))


def class_weights(df: DataFrame) -> DataFrame:
    """Balanced weight n / (2 n_c) of each label, and the ratio of negatives to positives."""
    label = F.col(contracts.TARGET)
    counted = df.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("rows"))
    sums = counted.agg(F.struct(
        F.sum("rows").alias("all"),
        F.sum(F.when(F.col("label") == 0, F.col("rows"))).alias("negative"),
        F.sum(F.when(F.col("label") == 1, F.col("rows"))).alias("positive"),
    )).scalar()
    ratio = F.coalesce(sums["negative"], F.lit(0)).cast("double") / F.greatest(
        F.coalesce(sums["positive"], F.lit(0)), F.lit(1)
    )
    return counted.select(
        "label", "rows",
        (sums["all"].cast("double") / (2 * F.col("rows"))).alias("balanced_weight"),
        ratio.alias("negative_to_positive"),
    )
