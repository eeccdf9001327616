"""Writes on Parquet that are safe to repeat."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.operators.quality import contract_errors


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace only the partitions that ``df`` has rows of."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """A table whose later files may have more columns."""
    return spark.read.option("mergeSchema", True).parquet(path)


def export(df: DataFrame, path: str, contract: Mapping[str, Sequence[str]], meta: Mapping[str, object] | None = None, period: str | None = None) -> int:
    """Write ``df`` beside what is published, check contract and rows of what was written, then put it in the place of that; returns the rows.

    meta.json beside it holds rows, columns and, with ``period``, the range of that column. Nothing published is touched
    before the new data is proven; what an error leaves behind is the staging folder, which the next export removes.
    """
    errors = contract_errors(df, contract)
    if errors:
        raise ValueError("; ".join(errors))
    spark = df.sparkSession
    staged, data, old = f"{path}/_staging", f"{path}/data", f"{path}/_old"
    df.write.mode("overwrite").parquet(staged)
    back = spark.read.parquet(staged)
    facts = back.agg(F.count(F.lit(1)).alias("n"), *([F.min(period).alias("first"), F.max(period).alias("last")] if period else [])).first()
    errors = contract_errors(back, contract)
    if errors:
        raise ValueError("written data: " + "; ".join(errors))
    jvm = spark._jvm.org.apache.hadoop.fs
    fs = jvm.Path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fs.delete(jvm.Path(old), True)
    if fs.exists(jvm.Path(data)):
        fs.rename(jvm.Path(data), jvm.Path(old))
    if not fs.rename(jvm.Path(staged), jvm.Path(data)):
        raise OSError(f"could not publish {data}; the data before is in {old}")
    fs.delete(jvm.Path(old), True)
    ranges = {"range": {period: [facts["first"], facts["last"]]}} if period else {}
    text = json.dumps({"rows": facts["n"], "columns": df.columns, **ranges, **(meta or {})}, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")
    return facts["n"]


def table_or_empty(spark: SparkSession, name: str, schema: str) -> DataFrame:
    """A catalogue table, or no rows of the schema where it is missing."""
    return spark.table(name) if spark.catalog.tableExists(name) else spark.createDataFrame([], schema)
