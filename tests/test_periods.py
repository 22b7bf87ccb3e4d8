"""Period tables on one time line, the satellite catalogue, and masks as bitmaps."""

import datetime as dt
import random

from pyspark.sql import functions as F

from leafray.operators import bitmaps, periods, robust
from leafray.sources import text

DAY = lambda n: None if n is None else dt.datetime(2020, 1, 1) + dt.timedelta(days=n)


def test_timeline_against_every_day(spark):
    r = random.Random(3)
    tables, plain = {}, {}
    for name in "abcd":
        rows = [(r.choice(["k1", "k2", "k3"]), s := r.randint(0, 60), r.choice([None, s + r.randint(-1, 20), s + r.randint(1, 9)]), f"{name}{i}") for i in range(r.randint(4, 14))]
        plain[name] = rows
        tables[name] = spark.createDataFrame([(k, DAY(a), DAY(b), v) for k, a, b, v in rows] + [(None, DAY(1), None, "x"), ("k1", None, DAY(3), "x")], f"svn string, start timestamp_ntz, end timestamp_ntz, {name} string")
    found = periods.timeline(tables, "svn").collect()
    for key in ("k1", "k2", "k3"):
        for day in range(-2, 100):
            want = {}
            for name, rows in plain.items():
                begun = [x for x in rows if x[0] == key and x[1] <= day and (x[2] is None or x[2] > x[1])]
                last = max(begun, key=lambda x: (x[1], x[2] is None, x[2] or 0), default=None)
                same = [x for x in begun if last and x[1:3] == last[1:3]]
                want[name] = min(x[3] for x in same) if last and (last[2] is None or last[2] > day) else None
            at = [x for x in found if x.svn == key and x.start <= DAY(day) and (x.end is None or x.end > DAY(day))]
            assert len(at) == (1 if any(want.values()) else 0)
            assert not at or {n: at[0][n] for n in "abcd"} == want


SINEX = """%=SNX 2.02
*a comment
+SATELLITE/IDENTIFIER
*SVN_ COSPAR ID SatCat Block__________ Comment
 G001 1978-020A  10684 GPS-I
 G002 1978-047A  10893 GPS-I
-SATELLITE/IDENTIFIER
+SATELLITE/PRN
 G001 1978:053:00000 1985:199:00000 G04
 G002 1978:133:00000 0000:000:00000 G07
-SATELLITE/PRN
+SATELLITE/MASS
 G001 1978:053:00000 0000:000:00000   455.000 GPS-I
-SATELLITE/MASS
+SATELLITE/TX_POWER
 G001 1980:001:43200 1981:001:00000  50 GPS-I
-SATELLITE/TX_POWER
+SATELLITE/FREQUENCY_CHANNEL
 R701 2003:344:00000 2009:258:86399  1
-SATELLITE/FREQUENCY_CHANNEL
"""


def test_catalog(spark, tmp_path):
    (tmp_path / "a.snx").write_text(SINEX)
    tables = periods.catalog(text.numbered_lines(spark, str(tmp_path / "a.snx")))
    assert {x.svn: (x.cospar_id, x.satcat, x.block) for x in tables["identifier"].collect()} == {"G001": ("1978-020A", 10684, "GPS-I"), "G002": ("1978-047A", 10893, "GPS-I")}
    assert [(x.svn, x.start, x.end, x.channel) for x in tables["frequency_channel"].collect()] == [("R701", dt.datetime(2003, 12, 10), dt.datetime(2009, 9, 15, 23, 59, 59), 1)]
    out = periods.satellite_periods(tables).where("svn = 'G001'").orderBy("start").collect()
    assert [(x.start, x.prn, x.mass_kg, x.watts, x.block) for x in out] == [
        (dt.datetime(1978, 2, 22), "G04", 455.0, None, "GPS-I"),
        (dt.datetime(1980, 1, 1, 12), "G04", 455.0, 50.0, "GPS-I"),
        (dt.datetime(1981, 1, 1), "G04", 455.0, None, "GPS-I"),
        (dt.datetime(1985, 7, 18), None, 455.0, None, "GPS-I"),
    ]
    assert out[-1].end is None


def test_masks_as_bitmaps(spark, tmp_path):
    """What is applied from the store is the mask itself, at little more than a bit a row."""
    n = 150_000
    rows = spark.range(2 * n).selectExpr("concat('G0', id % 2 + 1) AS sid", "cast(timestamp_micros((id div 2) * 30000000 - 86400000000) AS timestamp_ntz) AS epoch", "hash(id) % 3 = 0 AS own")
    odd = spark.createDataFrame([(None, DAY(0), True), ("G01", None, True), ("G09", DAY(0), None)], rows.schema)
    path = str(tmp_path / "masks")
    bitmaps.pack(rows.unionByName(odd), F.col("own"), 30, "good").coalesce(1).write.parquet(path)
    back = bitmaps.apply(rows.unionByName(odd), spark.read.parquet(path), "good", 30)
    assert back.columns == ["sid", "epoch", "own", "good"]
    assert back.where("sid <> 'G09' and epoch is not null and good <> own").count() == 0
    assert {(x.sid, x.epoch, x.good) for x in back.where("sid is null or epoch is null or sid = 'G09'").collect()} == {(None, DAY(0), None), ("G01", None, None), ("G09", DAY(0), False)}
    size = sum(f.stat().st_size for f in (tmp_path / "masks").glob("*.parquet"))
    assert size * 8 < 1.5 * 2 * n
    assert bitmaps.apply(rows, spark.read.parquet(path), "other", 30).where("other").count() == 0


def test_sliding_hampel_keeps_rows_without_key_or_time(spark):
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    rows = [(1, "G01|L1|C", at(60 * i), 1.0 + i % 3 + (50 if i == 7 else 0)) for i in range(15)]
    data = [*rows, (1, "G01|L1|C", None, 99.0), (None, "G01|L1|C", at(60), 99.0), (1, None, at(60), 1.0)]
    out = robust.sliding_hampel(spark.createDataFrame(data, "cell_id long, sid string, epoch timestamp_ntz, vod double")).collect()
    assert len(out) == len(data)
    assert [(x.epoch, x.vod) for x in out if x.is_outlier] == [(at(420), 52.0)]
    assert sorted(x.vod_filtered for x in out if x.epoch is None or x.cell_id is None or x.sid is None) == [1.0, 99.0, 99.0]
