"""Operators on small hand-made inputs."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from leafray.functions import columns, geometry, gnss
from leafray.operators import filters, grids, interpolate, joins, robust, signals, vod
from leafray.sources import text
from leafray.sources.store import Store
from leafray.streaming import ingest

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def obs(spark, rows):
    return spark.createDataFrame(rows, "epoch timestamp_ntz, sid string, phi double, theta double, snr double")


def test_depth_of_known_attenuation(spark):
    canopy = obs(spark, [(T0, "G01|L1|C", 0.1, math.pi / 4, 10.0), (T0, "G02|L1|C", 0.1, 0.5, float("nan")), (at(5), "G01|L1|C", 0.1, 0.0, 40.0)])
    sky = obs(spark, [(T0, "G01|L1|C", 0.2, 0.3, 20.0), (T0, "G02|L1|C", 0.2, 0.3, 20.0)])
    got = {x.sid: x for x in vod.tau_omega(canopy, sky).collect()}
    assert set(got) == {"G01|L1|C", "G02|L1|C"}
    assert abs(got["G01|L1|C"].vod + math.log(0.1) * math.cos(math.pi / 4)) < 1e-12
    assert got["G02|L1|C"].vod is None


@pytest.mark.parametrize(("kind", "how"), [("equal_area", {"degrees": 10}), ("equal_angle", {"degrees": 10}), ("equirectangular", {"degrees": 15}), ("fibonacci", {"points": 200}), ("healpix", {"degrees": 15}), ("geodesic", {"degrees": 16}), ("htm", {"degrees": 12})])
def test_grids_are_dense_and_cover_the_sky(spark, kind, how):
    g = grids.create(spark, kind, **how)
    rows = g.withColumn("omega", grids.solid_angle(kind, g.count())).collect()
    assert sorted(x.cell_id for x in rows) == list(range(len(rows)))
    assert all(0 <= x.phi < 2 * math.pi + 1e-9 and 0 <= x.theta < math.pi / 2 + 0.4 for x in rows)
    assert 0.85 < sum(x.omega for x in rows) / (2 * math.pi) < 1.6


def test_nearest_cell_edges(spark):
    g = grids.equal_area(spark, 10)
    rows = obs(spark, [(T0, "a", 0.0, 0.0, 1.0), (T0, "b", 6.28, 1.5, 1.0), (T0, "c", None, 0.4, 1.0), (T0, "d", 0.01, math.pi / 2, 1.0)])
    got = {x.sid: x.cell_id for x in grids.assign_cells(rows, g, math.radians(12)).collect()}
    cells = g.collect()
    near = lambda p, t: min(cells, key=lambda c: (round(2 - 2 * (math.sin(t) * math.sin(c.theta) * math.cos(p - c.phi) + math.cos(t) * math.cos(c.theta)), 12), c.cell_id)).cell_id
    assert got == {"a": 0, "b": near(6.28, 1.5), "c": None, "d": near(0.01, math.pi / 2)}


def test_frequencies():
    assert [columns.seconds_of(f) for f in ("30s", "15T", "1min", "1H", "6h", "1D", "D")] == [30, 900, 60, 3600, 21600, 86400, 86400]
    with pytest.raises(ValueError):
        columns.seconds_of("3 moons")


def test_positions_round_trip():
    for place in ((47.7, 16.3, 250.0), (-33.2, -70.1, 3000.0), (0.0, 0.0, 0.0), (89.9, 10.0, 5.0)):
        back = geometry.ecef_to_geodetic(*geometry.geodetic_to_ecef(*place))
        assert max(abs(a - b) for a, b in zip(place[:2], back[:2])) < 1e-9 and abs(place[2] - back[2]) < 1e-4


def test_direction_overhead_and_below(spark):
    rx = geometry.geodetic_to_ecef(47.7, 16.3, 250.0)
    up = geometry.geodetic_to_ecef(47.7, 16.3, 2e7)
    df = spark.createDataFrame([("up", *up), ("down", *[-v for v in up]), ("here", *rx)], "k string, x double, y double, z double")
    got = {x.k: x for x in df.withColumns(geometry.direction(F.col("x"), F.col("y"), F.col("z"), rx)).collect()}
    assert got["up"].theta < 1e-3 and abs(got["up"].r - (2e7 - 250)) < 1
    assert got["down"].r is None and got["here"].theta is None


def test_filters_keep_small_groups_and_gaps(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 1.1), (1, 0.9), (1, 1.0), (1, 1.05), (1, 99.0), (2, 5.0), (2, None), (None, 3.0)], "cell_id int, vod double")
    out = filters.apply(df, filters.Iqr(), by=["cell_id"]).collect()
    assert sorted(str(x.vod_filtered_iqr) for x in out) == sorted(map(str, [1.0, 1.1, 0.9, 1.0, 1.05, None, 5.0, None, 3.0]))
    with pytest.raises(ValueError):
        filters.pipeline(df, [filters.Range()], mode="odd")


def test_hampel_conventions(spark):
    rows = [("s", float(v)) for v in [1, 2, 3] * 8 + [50]] + [("few", 1.0), ("few", 100.0)] + [("flat", 1.0)] * 25 + [("flat", 2.0)]
    df = spark.createDataFrame(rows, "sid string, vod double")
    out = robust.hampel(df, by=["sid"]).where("is_outlier").collect()
    assert [(x.sid, x.vod) for x in out] == [("s", 50.0)]
    assert {(x.sid, x.vod) for x in robust.sigma_clip(df, by=["sid"]).where("is_outlier").collect()} == {("s", 50.0), ("flat", 2.0)}


def test_asof_prefers_the_earlier_and_keeps_rows(spark):
    left = spark.createDataFrame([("a", at(10)), ("a", at(100)), ("b", at(1)), (None, at(1))], "k string, epoch timestamp_ntz")
    right = spark.createDataFrame([("a", at(0), 1.0), ("a", at(20), 2.0), ("a", at(20), 3.0)], "k string, epoch timestamp_ntz, v double")
    got = {(x.k, x.epoch): (x.v, x.asof_gap) for x in joins.nearest_asof(left, right, ["k"], "epoch", ["v"]).collect()}
    assert got == {("a", at(10)): (1.0, 10.0), ("a", at(100)): (3.0, 80.0), ("b", at(1)): (None, None), (None, at(1)): (None, None)}
    near = joins.nearest_asof(left, right, ["k"], "epoch", ["v"], tolerance_seconds=30).where("v is not null").collect()
    assert [x.v for x in near] == [1.0]


def test_ledger_reasons(spark):
    s = "file_hash string, start timestamp_ntz, end timestamp_ntz"
    ledger = spark.createDataFrame([("h1", at(0), at(900))], s)
    batch = spark.createDataFrame([("h1", at(5000), at(6000)), ("h2", at(900), at(1000)), ("h3", at(901), at(999)), ("h4", at(20000), at(90000)), ("h5", at(30000), at(40000)), (None, at(0), at(1))], s)
    got = {x.file_hash: x.reason for x in joins.ledger_verdicts(batch, ledger, 600).collect()}
    assert got == {"h1": "hash_match", "h2": "temporal_overlap", "h3": "contained", "h4": None, "h5": "contained", None: None}


def test_validity(spark):
    p = spark.createDataFrame([("G01", dt.date(2000, 1, 1), dt.date(2010, 1, 1), "A"), ("G01", dt.date(2010, 1, 2), None, "B")], "prn string, start date, end date, svn string")
    f = spark.createDataFrame([("G01", dt.date(2009, 5, 5)), ("G01", dt.date(2024, 1, 1)), ("G01", dt.date(1990, 1, 1)), ("G02", dt.date(2024, 1, 1))], "prn string, day date")
    assert sorted((str(x.day), x.prn, str(x.svn)) for x in joins.valid_at(f, p, "prn", "day", ["svn"]).collect()) == [("1990-01-01", "G01", "None"), ("2009-05-05", "G01", "A"), ("2024-01-01", "G01", "B"), ("2024-01-01", "G02", "None")]


def test_hermite_is_exact_for_cubics(spark):
    f, v = lambda t: t**3 / 1e6 - t, lambda t: 3 * t**2 / 1e6 - 1
    knots = spark.createDataFrame([("s", at(t), float(f(t)), float(v(t))) for t in (0, 900, 1800)], "sv string, epoch timestamp_ntz, x double, vx double")
    targets = spark.createDataFrame([("s", at(t)) for t in (-60, 0, 450, 900, 1000, 1800, 1900)], "sv string, epoch timestamp_ntz")
    for row in interpolate.positions(knots, targets, axes=["x"]).collect():
        t = (row.epoch - T0).total_seconds()
        assert abs(row.x - f(t)) < 1e-6 and abs(row.vx - v(t)) < 1e-6


def test_clock_gaps(spark):
    known = spark.createDataFrame([("s", at(t), c) for t, c in ((0, 0.0), (10, 1e-8), (20, 1.0), (30, 2.0), (40, 2.0 + 1e-8))], "sv string, epoch timestamp_ntz, clock double")
    targets = spark.createDataFrame([("s", at(t)) for t in (-5, 5, 10, 15, 20, 25, 35, 40, 45)], "sv string, epoch timestamp_ntz")
    got = {(x.epoch - T0).total_seconds(): x.clock for x in interpolate.clocks(known, targets).collect()}
    assert [t for t, c in got.items() if c is None] and abs(got[5] - 5e-9) < 1e-15 and abs(got[35] - 2) < 1e-7
    assert {t for t, c in got.items() if c is None} == {-5, 15, 20, 25, 45}


def test_universe_and_padding(spark):
    u = signals.universe(spark)
    assert u.select("sid").distinct().count() == u.count() > 2000
    assert signals.pad(spark.createDataFrame([("G01|L1|C", 1.0), ("X99|L1|C", 2.0)], "sid string, snr double"), u, ["G01|L1|C", "G02|L1|C"]).count() == 2
    groups = {x.band: x.overlap_group for x in signals.overlap_groups(spark).collect()}
    assert groups["L1"] == groups["E1"] and groups["L5"] == groups["E5a"] != groups["L1"]


def test_sentences_and_fields(spark):
    s = "$GPGSV,1,1,02,01,40,083,46,02,17,308,*"
    body, total = s[1:-1], 0
    for ch in body:
        total ^= ord(ch)
    df = spark.createDataFrame([(f"${body}*{total:02X}",), (f"${body}*00" if total else f"${body}*01",)], "line string")
    assert [x.ok for x in df.select(gnss.nmea_valid(F.col("line")).alias("ok")).collect()] == [True, False]
    row = spark.range(1).select(gnss.cn0(F.lit(255), F.lit(0)).alias("a"), gnss.cn0(F.lit(100), F.lit(1)).alias("b"), gnss.pseudorange(F.lit(0), F.lit(0)).alias("c"), gnss.doppler(F.lit(-2147483648)).alias("d")).first()
    assert tuple(row) == (None, 25.0, None, None)


SP3 = """#cP2024  1  1  0  0  0.00000000
*  2024  1  1  0  0  0.00000000
PG01  10000.000000  20000.000000  -5000.000000    123.456
PG02 999999.999999 999999.999999 999999.999999 999999.999999
*  2024  1  1  0 15  0.00000000
PG01  10001.000000  20001.000000  -5001.000000    123.456
EOF
"""
RINEX = "\n".join([
    f"{'     3.04           OBSERVATION DATA    M':<60}RINEX VERSION / TYPE",
    f"{'G    4 C1C L1C D1C S1C':<60}SYS / # / OBS TYPES",
    f"{'':<60}END OF HEADER",
    "> 2024 01 01 00 00  0.0000000  0  2",
    "G01" + "".join(f"{v:14.3f}  " for v in (2e7, 1e8, -500.0, 45.5)),
    "G02" + "".join(f"{v:14.3f}  " for v in (2.1e7, 1.1e8, 300.0, 0.0)),
    "> bad epoch",
    "G01" + f"{1.0:14.3f}  ",
])


def test_text_sources(spark, tmp_path):
    (tmp_path / "a.sp3").write_text(SP3)
    (tmp_path / "a.rnx").write_text(RINEX)
    (tmp_path / "a.clk").write_text("AS G01  2024 01 01 00 00  0.000000  2    0.100000000000E-03\nAS G01  2024 01 01 00 00  0.000000  2    0.200000000000E-03\nAR XXXX 2024 01 01 00 00  0.0 1 0.1\n")
    o = sorted(text.read_sp3(spark, str(tmp_path / "a.sp3")).collect(), key=str)
    assert len(o) == 3 and sum(x.x is None for x in o) == 1 and {x.x for x in o} == {None, 1e7, 10001000.0}
    assert [(x.sv, x.clock) for x in text.read_clk(spark, str(tmp_path / "a.clk")).collect()] == [("G01", 2e-4)]
    r = {x.sid: x for x in text.read_rinex3(spark, str(tmp_path / "a.rnx")).collect()}
    assert set(r) == {"G01|L1|C", "G02|L1|C"} and r["G01|L1|C"].snr == 45.5 and r["G02|L1|C"].snr is None and r["G02|L1|C"].pseudorange == 2.1e7
    assert text.violations(spark.range(1), {"id": "bigint", "epoch": "timestamp_ntz"}) == ["epoch: absent, not timestamp_ntz"]


def test_store_versions_and_streamed_ingest(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    day = lambda d, h, n: spark.createDataFrame([(at(86400 * d + i), "G01|L1|C", float(i), h) for i in range(n)], "epoch timestamp_ntz, sid string, snr double, file_hash string")
    first = store.write("canopy", day(0, "a", 5))
    store.append("canopy", day(1, "b", 3))
    assert store.read("canopy").count() == 8 and store.read("canopy", first).count() == 5
    assert store.read("canopy", start=at(86400)).count() == 3
    store.overwrite_interval("canopy", day(0, "c", 2), at(0), at(86399))
    assert store.read("canopy").count() == 5 and store.history("canopy").count() == 3
    source = str(tmp_path / "in")
    day(5, "x", 4).write.parquet(source)
    for _ in range(2):
        ingest.ingest_available(spark, source, day(5, "x", 1).schema, store, "sky", str(tmp_path / "cp"))
    day(6, "x", 4).write.mode("append").parquet(source)
    ingest.ingest_available(spark, source, day(5, "x", 1).schema, store, "sky", str(tmp_path / "cp"))
    assert store.read("sky").count() == 4 and store.ledger("sky").count() == 1

