"""Raw AIS positions derived from the driver's ``events`` table.

There is no AIS data in the test set, so positions are derived from ``events`` with integer
and decimal arithmetic only (so that the text is identical in every SQL engine). Each event
is one report of a ship: a third of the users are ships of their own (ships grow with the data),
the others share twenty busy ships, and some events are a visitor's only report. Most ships sail a track of
their own; some lie at anchor at one of two crowded anchorages or in one of the ports of the test catalogue.
Some events are re-sent as an exact copy (``event_id % 59 = 0``, every second time in the next day's file)
or as a conflicting copy with another latitude (``% 61``); other residues plant bad ids, bad times, bad
latitudes, sentinels, impossible jumps and positions on land on either side of the antimeridian.

The mapping is one SQL template rendered for Spark and for DuckDB (the oracle), which
differ only in the string type name and the timestamp formatter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# One row per (event, copy): 0 = original, 1 = exact copy, 2 = conflicting copy.
_COPY_RULE = "(copy_no = 0 OR (copy_no = 1 AND event_id % 59 = 0) OR (copy_no = 2 AND event_id % 61 = 0))"

_MAPPING = """
SELECT
  CASE WHEN event_id % 83 = 0 THEN 'X' || CAST(u AS {S})
       WHEN event_id % 79 = 0 THEN CAST(2300000 + u AS {S})
       WHEN event_id % 71 = 0 THEN '990000001'
       ELSE CAST(367000000 + ship AS {S}) END AS MMSI,
  CASE WHEN event_id % 101 = 0 THEN 'bad-date' ELSE {TS_TEXT} END AS BaseDateTime,
  CASE WHEN event_id % 97 = 0 THEN '95.00000'
       ELSE CAST(CAST((CASE WHEN on_land THEN 1005000 + event_id % 89 * 1000
                            WHEN berth >= 0 THEN 2005000 + berth * 50000
                            WHEN berth = -1 THEN 2510000
                            WHEN berth = -2 THEN 3030000
                            ELSE 2500000 + u * 50000 + h * 2000 + mi * 30
                                 + CASE WHEN event_id % 89 = 0 THEN 500000 ELSE 0 END END
                       + CASE WHEN copy_no = 2 THEN 100 ELSE 0 END) * 0.00001 AS DECIMAL(10,5)) AS {S}) END AS LAT,
  CAST(CAST((CASE WHEN on_land AND event_id % 2 = 0 THEN 17905000 + event_id % 83 * 1000
                  WHEN on_land THEN 0 - 17905000 - event_id % 83 * 1000
                  WHEN berth >= 0 THEN 0 - 9005000
                  WHEN berth = -1 THEN 0 - 8012500
                  WHEN berth = -2 THEN 0 - 8337500
                  ELSE 0 - 8000000 - u * 30000 - h * 2500 END) * 0.00001 AS DECIMAL(10,5)) AS {S}) AS LON,
  CASE WHEN event_id % 73 = 0 THEN '102.3'
       WHEN event_id % 67 = 0 THEN '63.0'
       WHEN event_id % 5 = 0 OR berth > -3 AND event_id % 4 <> 0 THEN '0.4'
       ELSE CAST(CAST((event_id % 250) * 0.1 AS DECIMAL(6,1)) AS {S}) END AS SOG,
  CASE WHEN event_id % 53 = 0 THEN '360.0'
       WHEN event_id % 997 = 0 THEN '409.5'
       WHEN event_id % 499 = 0 THEN '365.2'
       ELSE CAST(event_id % 360 AS {S}) || '.0' END AS COG,
  CASE WHEN event_id % 3 = 0 THEN '511' WHEN event_id % 601 = 0 THEN '400'
       ELSE CAST(event_id % 360 AS {S}) END AS Heading,
  CASE WHEN event_id % 11 = 0 THEN '' ELSE 'SHIP ' || CAST(ship AS {S}) END AS VesselName,
  CASE WHEN event_id % 2 = 0 THEN NULL
       WHEN event_id % 47 = 0 THEN 'BAD1'
       ELSE 'IMO' || CAST(9000000 + ship % 900000 AS {S}) END AS IMO,
  'CS' || CAST(ship AS {S}) AS CallSign,
  CASE WHEN event_id % 13 = 0 THEN '0' ELSE CAST(30 + u * 3 AS {S}) END AS VesselType,
  CAST(event_id % 9 AS {S}) AS Status,
  CASE WHEN event_id % 17 = 0 THEN '0' ELSE CAST(20 + u * 15 AS {S}) END AS Length,
  CAST(5 + u AS {S}) AS Width,
  CAST(2 + u % 10 AS {S}) AS Draft,
  CAST(u % 4 AS {S}) AS Cargo,
  CASE WHEN u % 3 = 0 THEN 'B' ELSE 'A' END AS TransceiverClass,
  CAST(NULL AS {S}) AS _rescued_data,
  'AIS_' || CAST(file_day AS {S}) || '.csv' AS _source_file
FROM (
  SELECT event_id, user_id % 20 AS u, hour(ts) AS h, minute(ts) AS mi, ts, copy_no, event_id % 103 = 0 AS on_land,
         CASE WHEN event_id % 43 = 0 THEN 1000000 + event_id % 400000000
              WHEN user_id % 3 = 0 THEN 1000 + user_id ELSE user_id % 20 END AS ship,
         CASE WHEN user_id % 10 = 4 THEN user_id % 12
              WHEN user_id % 5 = 0 THEN -1
              WHEN user_id % 5 IN (1, 4) THEN -2
              ELSE -3 END AS berth,
         {FILE_DAY} AS file_day
  FROM {SRC}) ev
"""

SPARK_TS_TEXT = "date_format(ts, 'yyyy-MM-dd\\'T\\'HH:mm:ss')"
DUCK_TS_TEXT = "strftime(ts, '%Y-%m-%dT%H:%M:%S')"
# an exact copy is sent again in the next day's file every second time
_FILE_DAY = "CASE WHEN copy_no = 1 AND event_id % 2 = 0 THEN {next} ELSE CAST(ts AS DATE) END"


def mapping_sql(dialect: str, src: str) -> str:
    if dialect == "spark":
        return _MAPPING.format(S="STRING", TS_TEXT=SPARK_TS_TEXT, SRC=src,
                               FILE_DAY=_FILE_DAY.format(next="date_add(CAST(ts AS DATE), 1)"))
    return _MAPPING.format(S="VARCHAR", TS_TEXT=DUCK_TS_TEXT, SRC=src,
                           FILE_DAY=_FILE_DAY.format(next="CAST(CAST(ts AS DATE) + 1 AS DATE)"))


def duckdb_raw_sql() -> str:
    """Raw positions as a DuckDB query over the pre-registered ``events`` view."""
    src = (f"(SELECT e.*, c.copy_no FROM events e, (VALUES (0), (1), (2)) c(copy_no) "
           f"WHERE {_COPY_RULE})")
    return mapping_sql("duckdb", src)


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three columns of ``events`` that positions come from, dealt evenly over the tasks.

    The table may be one file of one row group, which is read by a single task; deriving and checking the
    text of the positions costs far more than reading, so it must not stay in that task.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "ts")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return events.repartition(tasks, *events.columns)


def raw_positions(events: DataFrame) -> DataFrame:
    """Raw position text (bronze shape without ``_ingested_at``), one scan of ``events``.

    The copies come from one ``explode`` per event instead of a union of three scans.
    """
    copies = F.filter(F.array(F.lit(0), F.lit(1), F.lit(2)),
                      lambda c: (c == 0) | ((c == 1) & (F.col("event_id") % 59 == 0))
                      | ((c == 2) & (F.col("event_id") % 61 == 0)))
    ev = events.select("event_id", "user_id", "ts", F.explode(copies).alias("copy_no"))
    return events.sparkSession.sql(mapping_sql("spark", "{ev}"), ev=ev)


def bronze_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped rows (all strings + lineage) derived from ``events``."""
    return raw_positions(load_events(spark, sf_dir)).withColumn("_ingested_at", F.current_timestamp())
