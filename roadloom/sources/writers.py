"""Writers: CSV with a column list, Parquet, JSON documents from key-value rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def csv(df: DataFrame, path: str, columns: list[str] | None = None, order: list[str] | None = None) -> None:
    out = df.select(*columns) if columns else df
    (out.orderBy(*order) if order else out).write.mode("overwrite").csv(path, header=True)


def parquet(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    (w.partitionBy(*by) if by else w).parquet(path)


def json_rows(df: DataFrame, path: str) -> None:
    """One JSON object a line: {key: value} documents that stay splittable at any size."""
    df.write.mode("overwrite").json(path)


def json_document(df: DataFrame, key: str, value: str) -> DataFrame:
    """One row with one JSON object of all pairs; for per-segment maps of a bounded network."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(key).cast("string").alias("key"), F.col(value).alias("value"))))
    return df.agg(F.to_json(F.map_from_entries(pairs)).alias("document"))
