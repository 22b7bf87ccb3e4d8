"""Functions that no registered query reaches."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from leafray.functions import geometry, gnss
from leafray.operators import audit, ephemeris, epochs, interpolate, joins, percell, signals
from leafray.sources import text
from leafray.sources.store import Store
from leafray.streaming import ingest

START = dt.datetime(2024, 1, 1)
at = lambda s: START + dt.timedelta(seconds=s)


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_scalar_functions(spark):
    x, y, z = geometry.geodetic_to_ecef(47.7, 16.3, 250.0)
    ecef = geometry.ecef_columns(F.lit(47.7), F.lit(16.3), F.lit(250.0))
    r = one(
        spark,
        digest=gnss.file_digest(F.lit("abc").cast("binary"), 8), yes=gnss.is_float(F.lit("1e3")), no=gnss.is_float(F.lit("x1")),
        a=gnss.hour_of_letter(F.lit("A")), x=gnss.hour_of_letter(F.lit("x")), day=gnss.hour_of_letter(F.lit("0")), bad=gnss.hour_of_letter(F.lit("z")),
        old=gnss.full_year(F.lit(80)), new=gnss.full_year(F.lit(79)), time=gnss.tow_to_time(F.lit(2300), F.lit(1500), F.lit(18)),
        phase=gnss.carrier_phase(F.lit(299_792_458.0), F.lit(1), F.lit(500), F.lit(1e6)), none=gnss.carrier_phase(F.lit(1.0), F.lit(-128), F.lit(0), F.lit(1e6)),
        ex=ecef["x"], ey=ecef["y"], ez=ecef["z"],
    )
    assert (r.digest, r.yes, r.no) == ("ba7816bf", True, False)
    assert (r.a, r.x, r.day, r.bad, r.old, r.new) == (0, 23, 0, None, 1980, 2079)
    assert r.time == dt.datetime(1980, 1, 6) + dt.timedelta(weeks=2300, seconds=1.5 - 18)
    assert r.phase == pytest.approx(1e6 + 66.036) and r.none is None
    assert (r.ex, r.ey, r.ez) == pytest.approx((x, y, z), abs=1e-6)


def test_read_deduplicated(spark):
    ledger = spark.createDataFrame([(at(0), at(60), at(0)), (at(0), at(60), at(5)), (at(100), at(120), at(1))], "start timestamp_ntz, end timestamp_ntz, written_at timestamp_ntz")
    obs = [("r", at(s), "G01|L1|C", float(v), v) for s, v in ((0, 1), (0, 2), (60, 3), (61, 4), (110, 5), (121, 6))]
    out = joins.read_deduplicated(spark.createDataFrame(obs, "receiver string, epoch timestamp_ntz, sid string, snr double, ingest_seq int"), ledger)
    assert sorted(x.snr for x in out.collect()) == [2.0, 3.0, 5.0]


def test_signal_dimension(spark):
    obs = spark.createDataFrame([("G01|L1|C",), ("G99|L1|C",), ("junk",)], "sid string")
    assert {x.sid for x in signals.unknown_signals(obs, signals.universe(spark)).collect()} == {"G99|L1|C", "junk"}


def test_day_targets_and_coverage(spark):
    keys = spark.createDataFrame([("G01",), ("G01",), ("G02",)], "sv string")
    t = interpolate.day_targets(keys, "2024-01-02", 3600)
    assert t.count() == 48 and t.agg(F.min("epoch"), F.max("epoch")).first() == (dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 23))
    c = spark.createDataFrame([("G01", 1.0)] * 4 + [("G01", None), ("G02", None)], "sv string, clock double")
    assert {x.sv: (x.coverage, x.enough) for x in interpolate.coverage(c, "clock").collect()} == {"G01": (80.0, True), "G02": (0.0, False)}


def test_whole_day_is_augmented(spark):
    sv = lambda k, s: (2.6e7 * math.cos(s / 7000 + k), 2.6e7 * math.sin(s / 7000 + k), 1e7)
    orbit = spark.createDataFrame([(f"G0{k}", at(900 * i), *sv(k, 900.0 * i)) for k in (1, 2) for i in range(97)], "sv string, epoch timestamp_ntz, x double, y double, z double")
    clock = spark.createDataFrame([("G01", at(0), 1e-7), ("G01", at(86400), 3e-7)], "sv string, epoch timestamp_ntz, clock double")
    targets = interpolate.day_targets(orbit, "2024-01-01", 600)
    rx = geometry.geodetic_to_ecef(10.0, 20.0, 0.0)
    out = ephemeris.chain(targets, [lambda d: ephemeris.augment(d, orbit, rx, clock, jump=1.0), lambda d: d.withColumn("elevation", 90 - F.degrees("theta"))])
    rows = out.collect()
    assert len(rows) == 288 and all((x.r is None) == (x.theta is None) for x in rows)
    for x in rows:
        s = (x.epoch - START).total_seconds()
        if x.r is not None:
            assert x.r == pytest.approx(math.dist(sv(int(x.sv[-1]), s), rx), rel=2e-3) and 0 <= x.elevation <= 90
        assert x.clock == (pytest.approx(1e-7 + 2e-7 * s / 86400) if x.sv == "G01" else None)


def test_reports_and_fingerprints(spark):
    rows = spark.createDataFrame([("snr", 1.5, None)], "variable string, rmse double, note string").collect()
    assert audit.report(rows, "T").splitlines()[0] == "## T" and "| snr | 1.5 |" in audit.report(rows)
    assert audit.report([], "T") == "T" and audit.report(rows, style="latex").startswith("\\begin{tabular}") and audit.report(rows, style="typst").startswith("#table")
    a = spark.createDataFrame([(1, 1.0), (1, 1.0), (2, None)], "cell_id long, value double")
    x, y, z = (r[0] for r in a.select(percell.fingerprint(a, "cell_id", "value")).collect())
    assert x == y != z and len(x) == 32


def test_stream_bins_and_store(spark, tmp_path):
    obs = spark.createDataFrame([(at(s), "G01|L1|C", float(s), "a") for s in (0, 1800, 3600, 90_000)], "epoch timestamp_ntz, sid string, snr double, file_hash string")
    obs.write.parquet(str(tmp_path / "in"))
    stream = ingest.binned(spark.readStream.schema(obs.schema).parquet(str(tmp_path / "in")), late="1 hour")
    q = stream.writeStream.format("memory").queryName("bins").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((x.snr, x.n) for x in spark.sql("select * from bins").collect()) == [(900.0, 2), (3600.0, 1), (90_000.0, 1)]
    store = Store(spark, str(tmp_path / "store"))
    first = store.write("g", obs)
    second = store.overwrite_interval("g", obs.where("snr > 80000").withColumn("snr", F.lit(7.0)), at(90_000), at(90_000))
    assert store.compare_versions("g", first, second) == {"added": 1, "removed": 1}
    assert sorted(x.snr for x in store.read("g").collect()) == [0.0, 7.0, 1800.0, 3600.0]
    assert store.freeze("g", str(tmp_path / "frozen"), first).where(F.col("frozen_version") == first).count() == 4
    store.ingest("h", obs)
    assert {x.reason for x in store.ingest("h", obs.withColumn("file_hash", F.lit("b"))).collect()} == {"temporal_overlap"}
    assert {x.grp: (x.versions, x.files) for x in store.inventory().collect()} == {"g": (2, 0), "h": (1, 1)}
    # ledger rows of a version that never came to be don't count
    store.ledger("h").withColumn("file_hash", F.lit("c")).withColumn("version", F.lit("lost")).write.mode("append").parquet(str(tmp_path / "store/ledger"))
    assert store.ledger("h").count() == 1


def test_nmea_sinex_and_listing(spark, tmp_path):
    def sentence(body):
        c = 0
        for ch in body:
            c ^= ord(ch)
        return f"${body}*{c:02X}"

    lines = [sentence("GPRMC,000010.00,A"), sentence("GPGSV,1,1,02,05,40,083,46,40,17,308,"), sentence("GLGSV,1,1,01,70,40,083,30"), "$GPGSV,1,1,01,09,1,1,50*00", sentence("GPGGA,000011.00,1"), sentence("GPGSV,1,1,01,05,40,083,44")]
    (tmp_path / "a.nmea").write_text("\n".join(lines))
    got = sorted(((x.epoch, x.sv, x.snr) for x in text.read_nmea(spark, str(tmp_path / "a.nmea")).collect()), key=str)
    assert got == [(10.0, "G05", 46.0), (10.0, "R06", 30.0), (10.0, "S27", None), (11.0, "G05", 44.0)]
    (tmp_path / "a.snx").write_text("%=SNX\n+SATELLITE/PRN\n* c\n G063 2011:198 0000:000 G01\n-SATELLITE/PRN\n+OTHER\n x y\n-OTHER\n")
    assert [x.fields for x in text.read_validity(spark, str(tmp_path / "a.snx"), "SATELLITE/PRN").collect()] == [["G063", "2011:198", "0000:000", "G01"]]
    (tmp_path / "ROSA01TUW_R_20240080000_15M_05S_AA.rnx").write_text("x")
    names = text.file_listing(spark, str(tmp_path)).where("name like 'ROS%'").collect()
    assert len(names) == 1 and names[0].size == 1 and len(names[0].digest) == 16


def test_coverage_of_a_requested_range(spark):
    days = spark.createDataFrame([(at(86400 * d),) for d in (3, 4, 9)], "epoch timestamp_ntz")
    ask = lambda a, b: epochs.coverage_compatible(days, days, ((START + dt.timedelta(days=a)).date(), (START + dt.timedelta(days=b)).date())).first().compatible
    assert ask(3, 9) and ask(5, 6) and ask(10, 9) and not ask(2, 9) and not ask(3, 10)
    assert not epochs.coverage_compatible(days, days.where("epoch < '2024-01-06'")).first().compatible
