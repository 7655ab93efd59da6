"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seawake.plans.layout import scratch_dir
from seawake.session import checkpoint_dir, ship_package

# Rows and bytes of one Arrow batch handed to Python: texts can be long, so batches stay small.
BATCH_ROWS = 1000
BATCH_BYTES = 4 << 20
SCAN_ROWS = 512              # rows a Parquet scan decodes at a time: 8 KB values would else take arrays of 32 MB and more


def prepare(spark: SparkSession) -> SparkSession:
    """Make the package importable by Python workers, bound Arrow batches, name the checkpoint folder."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(SCAN_ROWS))
    ship_package(spark)
    checkpoint_dir(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts lineage so that a lost executor costs a re-read, never a recomputation of Python work.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(names: list[str], wish: str) -> str:
    """``wish``, lengthened until it is none of the column ``names`` (which Spark tells apart by letters, not by case)."""
    taken = {n.lower() for n in names}
    while wish.lower() in taken:
        wish += "_"
    return wish


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def map_columns(docs: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: T.StructType) -> DataFrame:
    """Apply ``fn`` to every Arrow batch of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield fn(b)

    return docs.mapInArrow(run, schema)


def strings(column: pa.Array) -> list[str]:
    """Python strings of a text column, null as the empty text."""
    return [x or "" for x in column.to_pylist()]


def outside(spans: list[tuple], others: list[tuple]) -> list[tuple]:
    """The ``spans`` (start, end, ...) that lie inside none of ``others``, ordered by start; one merge of both lists."""
    rest, reach, out = sorted(others, key=lambda s: s[0]), 0, []
    at = 0
    for s in sorted(spans, key=lambda s: s[0]):
        while at < len(rest) and rest[at][0] <= s[0]:
            reach = max(reach, rest[at][1])
            at += 1
        if s[1] > reach:
            out.append(s)
    return out


def hex_of(fingerprint: Column) -> Column:
    """A signed 64-bit value as 16 lower-case hexadecimal digits."""
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")
