"""Bronze: incremental CSV file stream → Parquet, each file exactly once.

The file source remembers processed files in the checkpoint; the Parquet file sink commits
each micro-batch atomically in its ``_spark_metadata`` log. A batch that fails commits
nothing, and a restart on the same checkpoint re-runs it: no file is lost or repeated.

Columns come by the header of each file (``sources.csv``). Before a run the headers of new files are looked up and kept in a
small table beside the checkpoint; lines of a file that arrives later than that look-up fail their batch, and the next run takes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from seawake.schema import RAW_COLUMNS
from seawake.sources import csv
from seawake.sources.sinks import stored

HEADERS_SCHEMA = "_source_file string, header string, modified timestamp"
OVERLAP = "INTERVAL 1 DAY"      # files this much older than the newest known one are looked up again (late copies)


def known_headers(spark: SparkSession, src_dir: str, path: str) -> DataFrame:
    """The stored header table, after the headers of new files were added to it."""
    old = stored(spark, path, T.StructType.fromDDL(HEADERS_SCHEMA))
    since = old.select(F.date_format(F.max("modified") - F.expr(OVERLAP), "yyyy-MM-dd'T'HH:mm:ss")).first()[0]
    new = csv.file_headers(spark, src_dir, since).join(old, "_source_file", "left_anti")
    new.select("_source_file", "header", "modified").write.mode("append").parquet(path)
    return stored(spark, path, old.schema)


def bronze_source(spark: SparkSession, src_dir: str, headers: DataFrame, max_files_per_trigger: int | None = None,
                  fail_on: str | None = None) -> DataFrame:
    """All-string CSV stream; a malformed line, or the values of columns bronze does not have, are kept in ``_rescued_data``.

    ``fail_on`` injects a failure for the batch that contains a matching file (recovery tests).
    """
    wanted = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])
    different = csv.distinct_headers(headers)
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    one = csv.common_header(different)
    if one:
        # enforceSchema: a file with another header that came after the look-up fails loudly
        rows = (reader.schema(csv.file_schema(one, wanted)).options(**csv.TEXT_OPTIONS).option("header", True)
                .option("enforceSchema", False).csv(src_dir).withColumn("_source_file", F.col("_metadata.file_path")))
    else:
        rows = csv.routed(csv.text_lines(reader, src_dir), headers, different, wanted, csv.TEXT_OPTIONS)
    # folder names such as ``dia=YYYY-MM-DD`` are not raw fields
    df = rows.select(*RAW_COLUMNS, csv.RESCUED, "_source_file").withColumn("_ingested_at", F.current_timestamp())
    if fail_on:
        df = df.where(F.when(F.col("_source_file").contains(fail_on),
                             F.raise_error(F.lit(f"injected failure in {fail_on}"))).otherwise(F.lit(True)))
    return df


def run_bronze(spark: SparkSession, src_dir: str, bronze_dir: str, checkpoint: str,
               max_files_per_trigger: int | None = None, fail_on: str | None = None) -> StreamingQuery:
    """Process every new file once (``availableNow``) and wait for the end."""
    headers = known_headers(spark, src_dir, f"{checkpoint}_headers")
    q = (bronze_source(spark, src_dir, headers, max_files_per_trigger, fail_on)
         .writeStream.format("parquet")
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start(bronze_dir))
    q.awaitTermination()
    return q


def bronze_check(bronze: DataFrame) -> DataFrame:
    """Rows per source file and rows with rescued (malformed) text."""
    return bronze.groupBy("_source_file").agg(F.count(F.lit(1)).alias("filas"),
                                              F.count_if(F.col("_rescued_data").isNotNull()).alias("filas_rescatadas"))


def reconcile_files(spark: SparkSession, bronze: DataFrame, src_glob: str) -> DataFrame:
    """Bronze rows per file against raw text lines per file (full outer join, missing = 0)."""
    raw = csv.raw_line_counts(spark, src_glob)
    b = bronze.groupBy("_source_file").agg(F.count(F.lit(1)).alias("filas_bronze"))
    j = b.join(raw, "_source_file", "full")
    return (j.select("_source_file",
                     F.coalesce("filas_bronze", F.lit(0)).alias("filas_bronze"),
                     F.coalesce("lineas_csv", F.lit(0)).alias("lineas_csv"))
             .withColumn("diferencia", F.col("filas_bronze") - F.col("lineas_csv")))
