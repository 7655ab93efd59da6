"""Port catalogue: CSV reader with an explicit schema, and the small inline test catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PORT_CSV_DDL = "PORT_NAME string, COUNTRY string, LATITUDE double, LONGITUDE double"

# Hand-made catalogue placed on the simulated tracks (fixed test values): two ports closer
# than 5 km to each other, one name used in two countries, one port without a latitude and
# one far from every track.
TEST_PORTS = [
    ("Puerto Alfa", "US", 25.10, -80.125),
    ("Puerto Beta", "US", 25.12, -80.15),
    ("Puerto Gamma", "US", 26.70, -81.15),
    ("San Marcos", "US", 27.60, -81.62),
    ("San Marcos", "MX", 29.16, -82.60),
    ("Puerto Delta", "CU", 30.30, -83.375),
    ("Puerto Nulo", "US", None, -84.0),
    ("Puerto Lejano", "BS", 24.00, -77.00),
    # a row of harbours on the berths of the anchored ships; one has no country
    *[(f"Muelle {k:02d}", None if k == 4 else "MX", 20.05 + 0.5 * k, -90.05) for k in range(12)],
]


def read_port_csv(spark: SparkSession, path: str) -> DataFrame:
    """World-Port-Index style CSV → (puerto, pais, lat_puerto, lon_puerto), null coordinates dropped."""
    df = spark.read.option("header", True).schema(PORT_CSV_DDL).csv(path)
    return normalise(df)


def normalise(df: DataFrame) -> DataFrame:
    return (df.select(F.col("PORT_NAME").alias("puerto"), F.col("COUNTRY").alias("pais"),
                      F.col("LATITUDE").cast("double").alias("lat_puerto"),
                      F.col("LONGITUDE").cast("double").alias("lon_puerto"))
              .dropna(subset=["lat_puerto", "lon_puerto"]))


def fixture_ports(spark: SparkSession) -> DataFrame:
    raw = spark.createDataFrame(TEST_PORTS, PORT_CSV_DDL)
    return normalise(raw)


def fixture_ports_sql() -> str:
    """The same catalogue as a DuckDB ``VALUES`` relation (already normalised)."""
    rows = ", ".join(
        f"('{n}', {'NULL' if c is None else repr(c)}, {'NULL' if la is None else f'{la}::DOUBLE'}, {lo}::DOUBLE)"
        for n, c, la, lo in TEST_PORTS)
    return (f"(SELECT * FROM (VALUES {rows}) t(puerto, pais, lat_puerto, lon_puerto) "
            f"WHERE lat_puerto IS NOT NULL AND lon_puerto IS NOT NULL)")
