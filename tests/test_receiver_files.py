"""Binary blocks and RINEX 2 text written by the tests and read back; file names by recipe."""

import datetime as dt
import math
import os
import struct

import pytest
from pyspark.sql import functions as F

from leafray.functions import names
from leafray.sources import rinex2, sbf

WEEK, TOW = 2300, 345_600_000


def block(number, body):
    body += b"\0" * (-len(body) % 4)
    head = struct.pack("<HH", number, 8 + len(body))
    return b"$@" + struct.pack("<H", sbf.crc(head + body)) + head + body


def time(tow):
    return struct.pack("<IH", tow, WEEK)


def measurement(tow, *first):
    out = time(tow) + struct.pack("<BBBBBB", len(first), 20, 12, 0, 0, 0)
    for one, seconds in first:
        out += struct.pack("<BBBBIiHbBHBB", *one, len(seconds)) + b"".join(struct.pack("<BBBBbBHHH", *s) for s in seconds)
    return block(sbf.MEAS_EPOCH, out)


@pytest.fixture
def file(tmp_path):
    range_mm = 21_000_000_123
    gps = ((1, 0, 5, range_mm >> 32, range_mm & 0xFFFFFFFF, 12_345_678, 500, -2, 180, 99, 0), [(3, 9, 160, 0b00001_111, 1, 0, 65_000, 100, 20), (31, 9, 160, 0, 1, 0, 10, 100, 20)])
    glonass = ((2, 8, 40, 4, 1000, -2147483648, 0, -128, 255, 99, 0), [])
    unknown = ((3, 16, 7, 4, 1000, 5, 0, 1, 100, 99, 0), [])
    data = b"junk" + block(sbf.RECEIVER_TIME, time(TOW) + struct.pack("<bbbbbbbB", 24, 2, 8, 0, 0, 0, 17, 0))
    data += block(sbf.PVT_GEODETIC, time(TOW) + struct.pack("<BBddd", 1, 0, 0.8, 0.3, 250.0)) + block(sbf.DOP, time(TOW) + struct.pack("<BBHHHH", 9, 0, 150, 90, 110, 0))
    data += block(sbf.SAT_VISIBILITY, time(TOW) + struct.pack("<BB", 2, 8) + struct.pack("<BBHhBB", 5, 0, 9000, 3000, 0, 0) + struct.pack("<BBHhBB", 40, 3, 65535, 100, 0, 0))
    data += block(sbf.CHANNEL_STATUS, time(TOW) + struct.pack("<BBBBBB", 1, 12, 8, 0, 0, 0) + struct.pack("<BBHHHbBBB", 40, 3, 0, 0, 0, 10, 1, 2, 0) + b"\0" * 8)
    damaged = bytearray(measurement(TOW + 500, gps))
    damaged[20] ^= 1
    data += measurement(TOW, gps, glonass, unknown) + bytes(damaged) + measurement(TOW + 1000, gps)
    (tmp_path / "a.sbf").write_bytes(data)
    return str(tmp_path / "a.sbf")


def test_binary_observations(spark, file):
    got = {(x.epoch, x.sid): x for x in sbf.observations(spark, sbf.read_blocks(spark, file)).collect()}
    start = dt.datetime(1980, 1, 6) + dt.timedelta(weeks=WEEK, milliseconds=TOW, seconds=-17)
    assert {e for e, _ in got} == {start, start + dt.timedelta(seconds=1)}
    assert {s for e, s in got if e == start} == {"G05|L1|C", "G05|L2|L", "R03|G1|C", "G05|L1|L"}
    one, two, glo = (got[start, s] for s in ("G05|L1|C", "G05|L2|L", "R03|G1|C"))
    f1, f2, c = 1575.42e6, 1227.60e6, 299_792_458.0
    assert one.pseudorange == pytest.approx(21_000_000.123, abs=1e-6) and one.doppler == pytest.approx(1234.5678) and one.snr == 55.0
    assert one.phase == pytest.approx(21_000_000.123 * f1 / c + (-2 * 65536 + 500) * 0.001)
    second = 21_000_000.123 + (-1 * 65536 + 65_000) * 0.001
    assert two.pseudorange == pytest.approx(second, abs=1e-6) and two.doppler == pytest.approx(1234.5678 * f2 / f1 + (65536 + 20) * 1e-4)
    assert two.phase == pytest.approx(second * f2 / c + (65536 + 100) * 0.001) and two.snr == 50.0
    assert (glo.snr, glo.doppler, glo.phase) == (None, None, None) and glo.pseudorange == pytest.approx((4 * 2**32 + 1000) * 0.001)


def test_binary_metadata(spark, file):
    epochs, satellites = sbf.metadata(spark, sbf.read_blocks(spark, file))
    e, s = epochs.collect(), satellites.collect()
    assert len(e) == 1 and (e[0].lat, e[0].height, e[0].pdop, e[0].hdop, e[0].vdop) == (0.8, 250.0, 1.5, 1.1, None)
    assert [(x.sv, round(x.theta, 6), round(x.phi, 6)) for x in s] == [("G05", round(math.radians(60), 6), round(math.pi / 2, 6))]


def test_one_pass_for_both_outputs(spark, file):
    """Files are decoded once: both outputs come from the stored blocks, of which they read their own kinds only."""
    rows = lambda d: sorted(map(str, d.collect()))
    raw = sbf.read_blocks(spark, file)
    want = [rows(d) for d in (sbf.observations(spark, raw), *sbf.metadata(spark, raw))]
    found = sbf.outputs(spark, file)
    os.remove(file)
    assert [rows(d) for d in found] == want and all(want)
    for d, kinds in zip(found, (sbf.OF_OBSERVATIONS, sbf.OF_METADATA, sbf.OF_METADATA)):
        plan = d._jdf.queryExecution().executedPlan().toString()
        assert "binaryFile" not in plan and "PartitionFilters: [block" in plan
        files = {f for f in d.inputFiles()}
        assert files and str(sbf.MEAS_EPOCH) in plan and all(str(k) in plan for k in kinds)


def test_rinex2(spark, tmp_path):
    kinds = "     7    C1    L1    P2    L2    D1    S1    S2"
    cell = lambda v, tail="  ": f"{v:14.3f}{tail}" if v is not None else " " * 16
    epoch = lambda t, flag, n, sats: f" {t}  {flag}{n:3d}{sats}"
    sats = [f"G{i:2d}" for i in range(1, 13)] + ["R 7", " 14"]
    obs = [cell(2e7), cell(1e8, "17"), cell(0.0), cell(9e7), cell(-3.5)], [cell(45.0), cell(0.0)]
    text = [f"{'     2.11           OBSERVATION DATA':60}RINEX VERSION / TYPE", f"{kinds:60}# / TYPES OF OBSERV", f"{'':60}END OF HEADER"]
    text += [epoch("24  2  8  0  0  0.0000000", 0, 14, "".join(sats[:12])), " " * 32 + "".join(sats[12:])] + ["".join(x) for _ in sats for x in obs]
    text += [epoch("24  2  8  0  0 15.0000000", 4, 1, ""), f"{'a note':60}COMMENT", epoch("24  2  8  0  0 30.0000000", 0, 1, "E11"), "".join(obs[0]).rstrip(), ""]
    (tmp_path / "a.24o").write_text("\n".join(text))
    got = rinex2.read_rinex2(spark, str(tmp_path)).collect()
    first = [x for x in got if x.epoch == dt.datetime(2024, 2, 8)]
    assert len({x.sid[:3] for x in first}) == 14 and {"R07", "G14"} <= {x.sid[:3] for x in first}
    of = {x.sid: x for x in first if x.sid.startswith("G01")}
    assert set(of) == {"G01|L1|C", "G01|L1|X", "G01|L2|X"}
    assert of["G01|L1|C"].pseudorange == 2e7 and (of["G01|L1|X"].phase, of["G01|L1|X"].lli, of["G01|L1|X"].ssi, of["G01|L1|X"].snr, of["G01|L1|X"].doppler) == (1e8, 1, 7, 45.0, -3.5)
    later = [x for x in got if x.epoch == dt.datetime(2024, 2, 8, 0, 0, 30)]
    assert {x.sid for x in later} == {"E11|E1|C", "E11|E1|X"}
    assert rinex2.read_rinex2(spark, str(tmp_path), start=dt.datetime(2024, 2, 8, 0, 0, 10)).count() == len(later)


def test_recipe(spark):
    found = names.recipe_fields(F.col("n"), [("skip", 4), ("yy", 2), ("month", 2), ("day", 2), ("hour_letter", 1), ("minute", 2)])
    rows = spark.createDataFrame([("abcd240208b15.x",), ("abcd24xx08b15.x",), ("abcd24",)], "n string").select(found["valid"], names.recipe_time(found)).collect()
    assert [tuple(r) for r in rows] == [(True, dt.datetime(2024, 2, 8, 1, 15)), (False, None), (False, None)]
    with pytest.raises(ValueError):
        names.recipe_fields(F.col("n"), [("colour", 2)])
