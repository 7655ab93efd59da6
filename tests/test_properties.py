"""Property tests: conservation on random raw rows; rounding agrees with DuckDB on half-way traps."""
import duckdb
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from seawake.functions.numeric import fixed
from seawake.operators import silver as sv
from seawake.schema import RAW_COLUMNS

text = st.one_of(st.none(), st.text(alphabet="0123456789.-XIMO ", max_size=12))
mmsi = st.one_of(st.none(), st.sampled_from(["367000001", "1234567", "12345", "990000001", "X", "367000002"]))
when = st.one_of(st.none(), st.sampled_from(["2024-01-05T10:00:00", "2024-01-05T10:00:01", "2024-01-06T00:00:00",
                                             "bad"]))
num = st.one_of(st.none(), st.sampled_from(["26.5", "95", "-80.5", "-200", "0", "102.3", "63.0", "0.4", "511", "x"]))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(mmsi, when, num, num, num, num, num, text, text), min_size=1, max_size=40))
def test_conservation_identity(spark, rows):
    data = []
    for i, (m, t, la, lo, sog, cog, hdg, name, imo) in enumerate(rows):
        r = dict(zip(RAW_COLUMNS, [m, t, la, lo, sog, cog, hdg, name, imo] + ["x"] * 8))
        data.append(tuple(r[c] for c in RAW_COLUMNS) + (None, f"f{i % 3}"))
    schema = ", ".join(f"{c} string" for c in RAW_COLUMNS) + ", _rescued_data string, _source_file string"
    chk = sv.checked(spark.createDataFrame(data, schema))
    dd = sv.dedup_valid(chk)
    w = sv.day_metrics_wide(chk, dd).agg(*[F.sum(c).alias(c) for c in ("filas_entrada", "validas", "cuarentena",
                                                                        "duplicados")]).first()
    assert w.filas_entrada == len(rows) == w.validas + w.cuarentena
    assert w.validas - w.duplicados == dd.count()
    assert sv.quarantine_rows(chk).count() == w.cuarentena


TRAPS = [1.005, 2.675, -1.005, 0.125, 0.375, 1.0049999999, 12.344999999999999, 12.345, 1e-7, 123456.785]


def test_fixed_rounding_matches_duckdb(spark):
    df = spark.createDataFrame([(x,) for x in TRAPS], "x double")
    got = {r.x: (r.r2, r.r1) for r in df.select("x", fixed("x", 2).alias("r2"), fixed("x", 1).alias("r1")).collect()}
    con = duckdb.connect()
    for x in TRAPS:
        r2, r1 = con.execute(f"SELECT CAST(round(TRY_CAST({x!r}::DOUBLE AS DECIMAL(38,10)), 2) AS DOUBLE), "
                             f"CAST(round(TRY_CAST({x!r}::DOUBLE AS DECIMAL(38,10)), 1) AS DOUBLE)").fetchone()
        assert got[x] == (r2, r1), x
    assert got[1.005][0] == 1.01 and got[2.675][0] == 2.68 and got[-1.005][0] == -1.01


def test_cross_stage_profile_counts_agree(spark):
    """The raw-text profile (bronze) and the typed study count the same things on the same data."""
    from tests._paths import SF_MID
    from seawake.operators import study as st
    from seawake.plans import catalog as C
    b = {r.chequeo: r.n for r in st.bronze_profile(C.bronze(spark, SF_MID)).collect()}
    t = C.typed(spark, SF_MID)
    rp = st.range_profile(t).first()
    ip = st.id_profile(t).first()
    dp = st.duplicate_profile(t).first()
    bd = st.bronze_duplicates(C.bronze(spark, SF_MID)).first()
    assert b["sog_sentinel_102_3"] == rp.SOG_sin_dato
    assert b["cog_fuera_rango"] == rp.COG_invalido_real
    assert b["mmsi_no_9_digitos"] == ip.MMSI_longitud_invalida
    assert bd.dup_exactos == dp.duplicados_exactos
    assert bd.dup_llave == dp.filas_involucradas - dp.grupos_llave


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 3), st.integers(0, 23),
                          st.integers(0, 59), st.integers(0, 5)), min_size=1, max_size=60))
def test_lag_by_day_equals_window(spark, rows):
    import datetime as dt
    from pyspark.sql import Window
    from seawake.plans.windows import lag_by_day
    data = [(k, dt.datetime(2024, 1, 1 + d, h, m), float(v)) for k, d, h, m, v in rows]
    df = spark.createDataFrame(data, "k string, ts timestamp, v double").withColumn("day", F.to_date("ts"))
    got = lag_by_day(df, "k", ["ts"], ["ts", "v"], F.col("day"))
    w = Window.partitionBy("k").orderBy("ts", "v")
    exp = df.select("*", F.lag("ts").over(w).alias("ts_prev"), F.lag("v").over(w).alias("v_prev"))
    cols = ["k", "ts", "v", "ts_prev", "v_prev"]
    assert sorted(map(tuple, got.select(*cols).collect()), key=str) == sorted(map(tuple, exp.select(*cols).collect()),
                                                                              key=str)


def test_approx_distinct_ships_within_tolerance(spark):
    from tests._paths import SF_MID
    from seawake.operators import study as st
    from seawake.plans import catalog as C
    rows = st.daily_ships_exact_vs_approx(C.clean(spark, SF_MID), rsd=0.05).collect()
    assert len(rows) == 30
    for r in rows:
        assert r.buques_exact > 0 and abs(r.buques_approx - r.buques_exact) / r.buques_exact <= 0.15
        assert r.error_pct == round(abs(r.buques_exact - r.buques_approx) / r.buques_exact * 100, 2)


def test_empty_inputs_do_not_divide_by_zero(spark):
    from tests._paths import SF_SMALL
    from seawake.operators import dashboard as db, land as ld, study as st
    from seawake.plans import catalog as C
    empty = C.typed(spark, SF_SMALL).limit(0)
    assert st.permanence(st.clean_positions(empty)).first().pct_un_dia is None
    assert st.quality_summary(empty).where("pct IS NOT NULL").count() == 0
    assert st.bronze_profile(C.bronze(spark, SF_SMALL).limit(0)).count() == 16
    m = spark.createDataFrame([], "fecha date, metrica string, valor long")
    t = spark.createDataFrame([], "fecha date, mmsi string")
    assert db.day_kpis(t, t, m, "2024-01-08").first().pct_cuarentena is None


def test_duplicate_counts_do_not_depend_on_the_hash(spark):
    """Rows whose hashes collide are told apart by their columns."""
    from seawake.operators import study as st
    from seawake.plans import catalog as C
    from tests._paths import SF_SMALL
    dp = C.typed(spark, SF_SMALL).cache()
    null_keys = dp.limit(40).withColumn("MMSI", F.lit(None).cast("string"))
    dp = dp.unionByName(null_keys).unionByName(null_keys.limit(7))
    want = (dp.groupBy(*st.RAW_COLUMNS).agg(F.count("*").alias("copies")).groupBy("MMSI", "BaseDateTime")
            .agg(F.sum("copies").alias("n"), F.count("*").alias("variants"), F.max("copies").alias("most_copies")))
    rows = sorted(map(str, want.collect()))
    for hashed in (st.row_hash, lambda d: (F.lit(1).cast("long"), F.lit(2).cast("long")),
                   lambda d: (F.xxhash64("MMSI"), F.xxhash64("LAT") % 3)):
        assert sorted(map(str, st.report_groups(dp, hashed).collect())) == rows


def test_row_hash_sees_nulls_and_signed_zeros(spark):
    from seawake.operators import study as st
    rows = [dict.fromkeys(st.RAW_COLUMNS), {"MMSI": "a"}, {"VesselName": "a"}, {"LAT": 0.0}, {"LAT": -0.0}, {"LON": 0.0}]
    from seawake.schema import TYPED_DDL
    df = spark.createDataFrame([tuple(r.get(c) for c in st.RAW_COLUMNS) for r in rows], TYPED_DDL)
    got = [tuple(r) for r in df.select(*st.row_hash(df)).collect()]
    assert got[3] == got[4] and len({h[0] for h in got}) == len({h[1] for h in got}) == 5


def test_united_day_sketches_answer_for_any_days(spark):
    """Sketches of days, united, equal a sketch of the days' rows within the error bounds; the positions add up exactly."""
    from seawake.operators import study as st
    from seawake.plans import catalog as C
    from tests._paths import SF_MID
    rows = C.clean(spark, SF_MID).cache()
    sketches = st.day_sketches(rows).cache()
    for period in (F.lit("todo"), F.dayofweek("fecha"), F.when(F.col("fecha") < "2024-01-10", "a").otherwise("b")):
        exact = {r[0]: r for r in rows.groupBy(period).agg(F.count("*"), F.count_distinct("MMSI")).collect()}
        got = {r.periodo: r for r in st.period_estimates(sketches, period).collect()}
        assert got.keys() == exact.keys()
        for k, r in got.items():
            assert r.posiciones == exact[k][1]
            assert abs(r.buques_aprox - exact[k][2]) <= st.HLL_ERROR * exact[k][2] + 1
