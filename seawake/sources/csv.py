"""CSV sources of raw AIS day files.

Columns are matched by the header of each file, never by position: files of one feed may list the columns in another
order, leave some out or add others. A first pass over the text finds every file's header line; the few different headers become
parsers (``from_csv`` with that header's columns), each line goes to the parser of its file, and the results are aligned by
name. When all files share one header, Spark's CSV reader takes it directly.
"""

from __future__ import annotations

import csv
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seawake.functions.columns import given
from seawake.schema import RAW_COLUMNS, TYPED_DDL

KEY_COLUMNS = ("MMSI", "BaseDateTime")      # a header names both; no data line does
RESCUED = "_rescued_data"
MAX_HEADERS = 500                           # different headers of one read; each is one branch of the plan

# nullValue is a token that never occurs: an unquoted blank field is null ("not sent"),
# a quoted "" stays empty text, as in the raw file
TEXT_OPTIONS = {"mode": "PERMISSIVE", "nullValue": "\u0000", "columnNameOfCorruptRecord": RESCUED}
TYPED_OPTIONS = {"mode": "PERMISSIVE", "sep": ",", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true",
                 "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss", "columnNameOfCorruptRecord": RESCUED}


def names_of(header: str) -> list[str]:
    """Column names of a header line: trimmed, without quotes or byte order mark."""
    return [n.strip() for n in next(csv.reader([header.lstrip("﻿")]))]


def is_header(line: Column) -> Column:
    """Whether a line names the key columns; only a line with letters that data hardly have is cut into names."""
    likely = reduce(lambda a, b: a & b, [line.contains(c) for c in "meDB"])
    names = F.split(F.regexp_replace(line, r'[\s"﻿]', ""), ",")
    return F.when(likely, F.array_contains(names, KEY_COLUMNS[0]) & F.array_contains(names, KEY_COLUMNS[1])).otherwise(
        F.when(line.isNotNull(), F.lit(False)))


def text_lines(reader, path: str) -> DataFrame:
    """(value, _source_file) of a text reader or stream reader."""
    return reader.text(path).select("value", F.col("_metadata.file_path").alias("_source_file"))


def file_headers(spark: SparkSession, path: str, modified_after: str | None = None) -> DataFrame:
    """(_source_file, header, modified) of every file, or of those modified since; no header line gives a null header.

    Lines become the header they are, or null, and are told apart by hash first: a smallest text alone would sort all lines.
    """
    reader = spark.read.option("modifiedAfter", modified_after) if modified_after else spark.read
    lines = reader.text(path).select(F.when(is_header(F.col("value")), F.col("value")).alias("header"),
                                     F.col("_metadata.file_path").alias("_source_file"),
                                     F.col("_metadata.file_modification_time").alias("modified"))
    different = lines.groupBy("_source_file", "header").agg(F.max("modified").alias("modified"))
    return different.groupBy("_source_file").agg(F.min("header").alias("header"), F.max("modified").alias("modified"))


def distinct_headers(headers: DataFrame) -> list[str | None]:
    """The different header lines, at most ``MAX_HEADERS``; None first if a file has none."""
    found = [r[0] for r in headers.select("header").distinct().orderBy("header").limit(MAX_HEADERS + 1).collect()]
    if len(found) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers: these are not files of one feed")
    return found


def common_header(different: list[str | None]) -> str | None:
    """The one header of all files, if Spark's CSV reader can take them as they are: it names every raw column, and no other."""
    one = different[0] if len(different) == 1 else None
    return one if one is not None and sorted(names_of(one)) == sorted(RAW_COLUMNS) else None


def file_schema(header: str, wanted: T.StructType) -> T.StructType:
    """The columns of one header in file order: wanted ones with their type, others as text, a repeated name numbered."""
    types, fields, seen = {f.name: f.dataType for f in wanted}, [], set()
    for i, n in enumerate(names_of(header)):
        name = n if n and n not in seen else f"{n}#{i}"
        seen.add(n)
        fields.append(T.StructField(name, types.get(name, T.StringType())))
    return T.StructType([*fields, T.StructField(RESCUED, T.StringType())])


def _aligned(present: T.StructType, wanted: T.StructType) -> Callable[[Column], Column]:
    """The wanted columns of a parsed line by name; what else it holds is rescued as JSON, a malformed line as it is."""
    names = present.fieldNames()[:-1]
    extra = [n for n in names if n not in wanted.fieldNames()]

    def by_name(row: Column) -> Column:
        rest = F.to_json(F.struct(*[row[n].alias(n) for n in extra])) if extra else F.lit(None).cast("string")
        fields = [(row[f.name] if f.name in names else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted]
        return F.struct(*fields, F.coalesce(row[RESCUED], F.when(rest != "{}", rest)).alias(RESCUED))

    return by_name


def routed(lines: DataFrame, headers: DataFrame, different: list[str | None], wanted: T.StructType, options: dict) -> DataFrame:
    """Lines (value, _source_file) parsed by the header of their file: the wanted columns, ``_rescued_data``, ``_source_file``.

    A line of a file without a header is rescued whole; a file that ``headers`` does not list fails the job. ``different``
    are the header lines of ``headers``.
    """
    unknown = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in wanted], F.col("value").alias(RESCUED))
    parsed = None
    for h in filter(None, different):
        present = file_schema(h, wanted)
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in present)
        row = given(F.from_csv("value", F.lit(ddl), options), _aligned(present, wanted))
        parsed = F.when(F.col("header") == h, row) if parsed is None else parsed.when(F.col("header") == h, row)
    parsed = unknown if parsed is None else parsed.otherwise(unknown)
    listed = headers.select(F.col("_source_file").alias("_file"), "header")
    known = lines.join(listed, F.col("_source_file") == F.col("_file"), "left")
    unlisted = F.raise_error(F.concat(F.lit("no header was looked up for "), F.col("_source_file")))
    data = known.where(F.when(F.col("_file").isNull(), unlisted.cast("boolean")).otherwise(
        (F.col("value") != "") & (F.col("header").isNull() | (F.col("value") != F.col("header")))))
    return data.select(parsed.alias("row"), "_source_file").select("row.*", "_source_file")


def read_typed(spark: SparkSession, glob: str) -> DataFrame:
    """Typed batch scan of many day files: columns by each file's header, trimmed fields, bad fields null."""
    wanted = T.StructType.fromDDL(TYPED_DDL)
    headers = file_headers(spark, glob)
    different = distinct_headers(headers)
    if common_header(different):
        present = file_schema(different[0], wanted)
        rows = spark.read.schema(present).options(**TYPED_OPTIONS).option("header", True).csv(glob)
        return rows.select(*RAW_COLUMNS, F.col("_metadata.file_path").alias("_source_file"))
    return routed(text_lines(spark.read, glob), headers, different, wanted, TYPED_OPTIONS).select(*RAW_COLUMNS, "_source_file")


def raw_line_counts(spark: SparkSession, glob: str) -> DataFrame:
    """Data lines per file: text lines minus the header line."""
    return (spark.read.text(glob)
            .select(F.col("_metadata.file_path").alias("_source_file"))
            .groupBy("_source_file").agg((F.count(F.lit(1)) - 1).alias("lineas_csv")))


def write_day_files(raw: DataFrame, folder: str, day_col: str = "dia", above: tuple[str, ...] = ()) -> None:
    """Write raw positions as CSV text, one file per day under ``folder/dia=YYYY-MM-DD/``, or below folders of the columns ``above``.

    Used to build landing files from the test tables; ``repartition`` on the day makes each
    day exactly one file (the landing format of the source data).
    """
    d = raw.withColumn(day_col, F.regexp_extract("_source_file", r"AIS_(\d{4}-\d{2}-\d{2})", 1))
    (d.repartition(*above, day_col).select(*RAW_COLUMNS, *above, day_col)
      .write.mode("overwrite").partitionBy(*above, day_col).option("header", True).csv(folder))
