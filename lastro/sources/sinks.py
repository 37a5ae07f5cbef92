"""Writing datasets: Parquet tables, split matrices, JSON records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def _safe(column: Column, kind: T.DataType) -> Column:
    """A value JSON can hold: day texts for dates, null for NaN and infinities, at any depth."""
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.date_format(column, "yyyy-MM-dd")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(~(F.isnan(column) | column.isin(float("inf"), float("-inf"))), column)
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda item: _safe(item, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(column, lambda _, item: _safe(item, kind.valueType))
    if isinstance(kind, T.StructType):
        fields = [_safe(column[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(column.isNotNull(), F.struct(*fields))
    return column


def json_safe(df: DataFrame) -> DataFrame:
    return df.select([_safe(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def records(df: DataFrame, order: Sequence[Column] = (), limit: int | None = None) -> DataFrame:
    """Rows ready for JSON.  A limit needs a total order, since Spark rows have none."""
    if limit is not None:
        if not order:
            raise ValueError("a limit needs an order")
        df = df.orderBy(*order).limit(limit)
    return json_safe(df)


def write_json(df: DataFrame, path: str) -> None:
    json_safe(df).write.mode("overwrite").option("ignoreNullFields", False).json(path)
