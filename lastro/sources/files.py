"""Reading raw files: every column as text, missing-value tokens to null, contract types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from lastro import contracts
from lastro import fixed_values as fv
from lastro.functions.literals import in_list, name
from lastro.sources.records import read_records

# The date layouts accepted in the files.
DATE_LAYOUTS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "MM/dd/yyyy")
# A decimal number; a cast alone would also take Java's type suffixes, as in 10D.
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

INGEST_ORDER = "_ingest_seq"


def null_tokens(df: DataFrame) -> DataFrame:
    """Missing-value tokens of text columns become null."""
    tokens = in_list(fv.MISSING_TOKENS)
    return df.selectExpr(*[
        f"CASE WHEN {name(f.name)} NOT IN {tokens} THEN {name(f.name)} END AS {name(f.name)}"
        if isinstance(f.dataType, T.StringType) else name(f.name)
        for f in df.schema.fields
    ])


def parse_date(column: Column) -> Column:
    """The first layout that fits; null when none does."""
    parsed = [F.try_to_timestamp(column, F.lit(layout)) for layout in DATE_LAYOUTS]
    return F.coalesce(*parsed).cast("date")


def parse_number(column: Column) -> Column:
    text = column.cast("string")
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def coerce_types(
    df: DataFrame, dates: Sequence[str] = (), numbers: Sequence[str] = ()
) -> DataFrame:
    """Bad dates and numbers become null; columns that are absent are skipped."""
    present = set(df.columns)
    typed = {c: parse_date(F.col(c)) for c in dates if c in present}
    typed |= {c: parse_number(F.col(c)) for c in numbers if c in present}
    return df.withColumns(typed) if typed else df


def read_csv(
    spark: SparkSession, path: str, with_order: bool = False, multi_line: bool = True
) -> DataFrame:
    """Header CSV as text columns.  Columns outside the contract are kept.

    Quotes in a field are doubled.  A field may hold line breaks, and large files are read by many tasks all the same
    (:mod:`lastro.sources.records`); where the files are known to have none, ``multi_line=False`` leaves out the pass that
    looks for them.  A file whose header differs from the first one's, in names or their order, is an error.

    The header is read once to name the columns, so there is no inference pass over the
    data.  ``with_order`` adds the position of each row as (file, offset of the split,
    row within the task or number of the record in the file), the order in which a single reader would meet the rows.
    """
    options = {"header": True, "escape": '"'}
    names = spark.read.options(**options, multiLine=multi_line).csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    if multi_line:
        raw = _parsed_records(read_records(spark, path), schema, with_order)
    else:
        raw = spark.read.schema(schema).options(**options, mode="PERMISSIVE", enforceSchema=False).csv(path)
        if with_order:
            position = F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("offset"),
                F.monotonically_increasing_id().alias("row"),
            )
            raw = raw.withColumn(INGEST_ORDER, position)
    return null_tokens(raw)


def _parsed_records(records: DataFrame, schema: T.StructType, with_order: bool) -> DataFrame:
    """The fields of each record but the headers, which have to name the columns of the schema."""
    options = {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    fields = F.from_csv(F.col("text"), ", ".join(f"{name(n)} string" for n in schema.names), options)
    parsed = records.where(F.trim("text") != "").select("file", "record", fields.alias("f"))
    found = F.array(*[F.col("f").getField(n) for n in schema.names])
    fits = F.coalesce(F.transform(found, lambda x: F.coalesce(x, F.lit(""))) == F.array(*map(F.lit, schema.names)), F.lit(False))
    differs = F.raise_error(F.concat(F.lit("the header differs from that of the first file: "), F.col("file")))
    rows = parsed.where((F.col("record") > 1) | F.when(fits, F.lit(False)).otherwise(differs.cast("boolean")))
    columns = [F.col("f").getField(n).alias(n) for n in schema.names]
    if with_order:
        columns.append(F.struct("file", F.lit(0).cast("long").alias("offset"), F.col("record").alias("row")).alias(INGEST_ORDER))
    return rows.select(*columns)


def _coerce_to(df: DataFrame, contract: dict[str, contracts.ColumnSpec]) -> DataFrame:
    return coerce_types(
        df,
        dates=contracts.columns_of(contract, T.DateType),
        numbers=contracts.columns_of(contract, T.DoubleType),
    )


def load_payments(spark: SparkSession, path: str, with_order: bool = False) -> DataFrame:
    return _coerce_to(read_csv(spark, path, with_order), contracts.PAYMENTS)


def load_auxiliary(spark: SparkSession, path: str, with_order: bool = False) -> DataFrame:
    """Company table; the numeric columns get the contract types instead of inferred ones."""
    return _coerce_to(read_csv(spark, path, with_order), contracts.AUXILIARY)


def read_optional(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet dataset, or None when it does not exist or cannot be read."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


# The published datasets, and those a dashboard cannot do without.
PUBLISHED = (
    "portfolio_overview", "payer_risk", "beneficiary_risk", "temporal_analysis",
    "uf_analysis", "cnae_analysis", "score_distribution", "feature_importance", "boleto_scores",
)
REQUIRED = tuple(n for n in PUBLISHED if n != "feature_importance")


def read_published(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], bool]:
    """The published datasets found in a folder, and whether all required ones are there."""
    found = {}
    for dataset in PUBLISHED:
        df = read_optional(spark, f"{folder}/{dataset}")
        if df is not None:
            found[dataset] = df
    return found, set(REQUIRED) <= set(found)


METRICS_TYPE = (
    "map<string, struct<auc_roc: double, auc_pr: double, f1: double, "
    "confusion_matrix: array<array<bigint>>>>"
)


def read_model_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Metrics JSON as one row per model, best AUC first; an absent file gives no rows."""
    columns = "model string, auc_roc double, auc_pr double, f1 double"
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException:
        return spark.createDataFrame([], columns)
    return (
        text.select(F.explode(F.from_json("value", METRICS_TYPE)).alias("model", "m"))
        .select(
            F.initcap(F.replace("model", F.lit("_"), F.lit(" "))).alias("model"),
            "m.auc_roc", "m.auc_pr", "m.f1",
        )
        .orderBy(F.desc_nulls_last("auc_roc"), "model")
    )
