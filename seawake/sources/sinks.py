"""Idempotent Parquet sinks: replace only some days, insert only new keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seawake.functions.dates import day_filter


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly inside a folder; none when it does not exist."""
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def stored_days(spark: SparkSession, path: str, day_col: str = "fecha") -> list[str]:
    """Day folders of a day-partitioned table (the values as text), from one folder listing."""
    names = child_names(spark, path)
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{day_col}="))


def replace_days(df: DataFrame, path: str, days: list[dt.date] | None, day_col: str = "fecha",
                 sort_cols: list[str] | None = None) -> None:
    """Overwrite exactly the listed days of a day-partitioned table, or all days for None.

    Dynamic partition overwrite replaces the day partitions present in the output; a day that was to be
    replaced and has no rows any more is removed, so a re-run never leaves stale rows. Such a day
    is known by its files, which the write left as they were: the input is computed once.
    Rows are clustered by ``sort_cols`` inside each file so min/max statistics skip well.
    """
    spark = df.sparkSession
    replaced = stored_days(spark, path, day_col) if days is None else [d.isoformat() for d in days]
    before = {d: child_names(spark, f"{path}/{day_col}={d}") for d in replaced if not d.startswith("__HIVE")}
    out = df.where(day_filter(day_col, days))
    if sort_cols:
        # rows of a day stay together, a hot day is split by AQE into advisory-size files
        out = out.hint("rebalance", day_col).sortWithinPartitions(*sort_cols)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(day_col).parquet(path))
    for d, files in before.items():
        if files and set(child_names(spark, f"{path}/{day_col}={d}")) == set(files):
            remove(spark, f"{path}/{day_col}={d}")


def stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table by its known schema: empty when the folder is missing or holds no file yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def insert_only(batch: DataFrame, history: DataFrame | None, keys: list[str]) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``history``: an insert-only merge as one anti-join."""
    if history is None:
        return batch
    return batch.join(history.select(*keys), keys, "left_anti")


def total_bytes(df: DataFrame) -> int:
    """Bytes of the files behind a file-based frame (each file counted once)."""
    files = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b")).distinct()
    return int(files.agg(F.coalesce(F.sum("b"), F.lit(0))).first()[0])


def storage_footprint(spark: SparkSession, path: str, partition_cols: list[str]) -> DataFrame:
    """Files and bytes per partition of a Parquet table, from Spark's own file metadata."""
    df = spark.read.parquet(path)
    files = df.select(*partition_cols, F.col("_metadata.file_path").alias("f"),
                      F.col("_metadata.file_size").alias("b")).distinct()
    return files.groupBy(*partition_cols).agg(F.count(F.lit(1)).alias("archivos"), F.sum("b").alias("bytes"))
