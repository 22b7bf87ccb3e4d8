"""Queries of the file readers: the given tables are written as receiver files to the shared folder and read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafray.functions import gnss
from leafray.functions.columns import micros
from leafray.operators import headers, periods, signals
from leafray.plans import adapters as A
from leafray.plans import sky
from leafray.plans.registry import query
from leafray.sources import rinex3, text
from leafray.sources.scratch import shared_folder


def write_lines(rows: DataFrame, path: str) -> str:
    """``rows`` (file, place, line) as one text file per ``file``, its lines in order of ``place``."""
    rows.repartition("file").sortWithinPartitions("file", "place").select("file", "line").write.partitionBy("file").text(path)
    return path


def labelled(value: Column, label: str) -> Column:
    return F.concat(F.rpad(value, 60, " "), F.lit(label))


#: Events as the observations of two receivers in epochs of ten minutes; cents keep all values decimal.
_EVENTS = """
ev AS (SELECT CASE WHEN event_id % 2 = 0 THEN 'canopy_01' ELSE 'reference_01' END AS receiver, CAST(floor(epoch_us(ts) / 600000000.0) AS BIGINT) AS k,
    CASE user_id % 3 WHEN 0 THEN 'G' WHEN 1 THEN 'E' ELSE 'R' END AS s, 1 + user_id % 8 AS prn, CAST(round(value * 100) AS BIGINT) AS cents FROM events WHERE value IS NOT NULL),
rx AS (SELECT receiver, k, s, prn, max(cents) AS cents FROM ev GROUP BY ALL)"""
_BAND = "CASE s WHEN 'G' THEN '|L1|C' WHEN 'E' THEN '|E1|C' ELSE '|G1|C' END"


def rinex_rows(spark: SparkSession, sf: str) -> DataFrame:
    """receiver, k (number of the epoch), s, prn, cents."""
    e = A.table(spark, sf, "events").where("value is not null")
    system = F.when(F.col("user_id") % 3 == 0, "G").when(F.col("user_id") % 3 == 1, "E").otherwise("R")
    receiver = F.when(F.col("event_id") % 2 == 0, A.CANOPY).otherwise(A.SKY)
    k = F.floor(micros(F.col("ts")) / 600_000_000).cast("long")
    return e.groupBy(receiver.alias("receiver"), k.alias("k"), system.alias("s"), (F.col("user_id") % 8 + 1).alias("prn")).agg(F.max(F.round(F.col("value") * 100).cast("long")).alias("cents"))


def write_rinex3(spark: SparkSession, sf: str) -> str:
    """A RINEX 3 file per receiver and day. Receivers differ in what their headers lack, and days in what their bodies say."""
    rows = rinex_rows(spark, sf).withColumn("day", F.floor(F.col("k") / 144))
    rows = rows.withColumn("file", F.concat_ws("_", "receiver", F.col("day").cast("string")))
    when = F.timestamp_micros(F.col("k") * 600_000_000).cast("timestamp_ntz")
    cents = F.col("cents")
    cell = lambda v, a=F.lit(" "), b=F.lit(" "): F.concat(F.format_string("%14.3f", v), a, b)
    values = [
        cell(2e7 + cents.cast("double")),
        cell(cents * 1.5, (cents % 2).cast("string"), (cents % 9 + 1).cast("string")),
        cell((cents % 1000) / 10 - 50),
        cell((cents % 6000) / 100 + 0.01),
    ]
    sv = F.concat("s", F.lpad(F.col("prn").cast("string"), 2, "0"))
    observed = rows.select("file", (F.col("k") * 100 + F.when(F.col("s") == "G", 10).when(F.col("s") == "E", 30).otherwise(50) + F.col("prn")).alias("place"), F.concat(sv, *values).alias("line"))
    marks = rows.groupBy("file", "k").agg(F.count(F.lit(1)).alias("n")).select("file", (F.col("k") * 100).alias("place"), F.concat(F.date_format(when, "'> 'yyyy MM dd HH mm"), F.lit("  0.0000000  0"), F.lpad("n", 3, " ")).alias("line"))
    own = rows.groupBy("file", "receiver", "day").agg(F.min("k").alias("k"))
    first = F.date_format(when, "'  'yyyy'    'MM'    'dd'    'HH'    'mm'    0.0000000     GPS'")
    canopy = F.col("receiver") == A.CANOPY
    head = [
        labelled(F.lit(f"{3.04:9.2f}{'':11}{'OBSERVATION DATA':<20}M"), "RINEX VERSION / TYPE"),
        labelled(F.lit(f"{'leafray':<20}{'tests':<20}20240101 000000 UTC"), "PGM / RUN BY / DATE"),
        labelled(F.col("receiver"), "MARKER NAME"),
        labelled(F.lit(f"{'observer':<20}agency"), "OBSERVER / AGENCY"),
        labelled(F.lit(f"{'1':<20}{'receiver':<20}1.0"), "REC # / TYPE / VERS"),
        labelled(F.lit(f"{'2':<20}antenna"), "ANT # / TYPE"),
        labelled(F.lit(f"{4075578.0:14.4f}{931852.0:14.4f}{4801568.0:14.4f}"), "APPROX POSITION XYZ"),
        labelled(F.lit(f"{0.0:14.4f}{0.0:14.4f}{0.0:14.4f}"), "ANTENNA: DELTA H/E/N"),
        *[labelled(F.lit(f"{s}    4 C1C L1C D1C S1C"), "SYS / # / OBS TYPES") for s in "GER"],
        # only the canopy's files name the channels of GLONASS; on every third day the first epoch is given a minute late
        F.when(canopy, labelled(F.lit("  1 R01  1"), "GLONASS SLOT / FRQ #")),
        labelled(F.lit(" C1C    0.000"), "GLONASS COD/PHS/BIS"),
        labelled(F.when(F.col("day") % 3 == 0, F.replace(first, F.lit("    0.0000000"), F.lit("   60.0000000"))).otherwise(first), "TIME OF FIRST OBS"),
        labelled(F.lit(""), "END OF HEADER"),
    ]
    top = own.select("file", F.posexplode(F.array(*head)).alias("place", "line")).where("line is not null").select("file", (F.col("place") - 1000).cast("long").alias("place"), "line")
    return write_lines(top.unionByName(marks).unionByName(observed), shared_folder(spark, "rinex3"))


@query(
    "rinex3_scan",
    f"""SELECT receiver, to_timestamp(k * 600)::TIMESTAMP AS epoch, s || lpad(prn::VARCHAR, 2, '0') || {_BAND} AS sid, round((cents % 6000) / 100.0 + 0.01, 3) AS snr, 2e7 + cents AS pseudorange,
    round(cents * 1.5::DOUBLE, 3) AS phase, round((cents % 1000) / 10.0 - 50, 3) + 0.0 AS doppler, (cents % 2)::INTEGER AS lli, (cents % 9 + 1)::INTEGER AS ssi
    FROM rx WHERE k >= 2840112 AND k <= 2841552""",
    _EVENTS,
)
def _(spark, sf):
    """Twenty days of all receivers' files, read by byte ranges; the time goes into the scan."""
    path = write_rinex3(spark, sf)
    # 2024-01-01 is epoch 2840112 of ten minutes
    start = dt.datetime(2024, 1, 1)
    obs = rinex3.read_rinex3(spark, path, split=256 << 10, start=start, end=start + dt.timedelta(days=10))
    names = rinex3.read_headers(spark, path).select("file", F.col("marker_name").alias("receiver"))
    return obs.join(names, "file").select("receiver", "epoch", "sid", "snr", "pseudorange", "phase", F.expr("doppler + 0.0D").alias("doppler"), "lli", "ssi")


@query(
    "rinex3_conformance",
    """SELECT receiver, day, count(*) AS n_rows, receiver = 'canopy_01' AS glonass_slots, day % 3 <> 0 AS first_epoch,
    CASE WHEN receiver = 'canopy_01' THEN CASE WHEN day % 3 = 0 THEN 'first_epoch' ELSE '' END ELSE CASE WHEN day % 3 = 0 THEN 'glonass_slots,first_epoch' ELSE 'glonass_slots' END END
      || CASE WHEN max(cents) > 40000000 THEN ',ranges' ELSE '' END AS broken
    FROM (SELECT *, k // 144 AS day FROM rx) GROUP BY receiver, day""",
    _EVENTS,
)
def _(spark, sf):
    """The rules of the format on every file that was written."""
    path = write_rinex3(spark, sf)
    out = headers.header_conformance(rinex3.read_headers(spark, path), rinex3.read_rinex3(spark, path, split=256 << 10))
    day = F.regexp_extract("file", r"_(\d+)/[^/]*$", 1).cast("long")
    return out.select(F.col("marker_name").alias("receiver"), day.alias("day"), "n_rows", "glonass_slots", "first_epoch", F.concat_ws(",", "broken").alias("broken"))


@query(
    "rinex3_signals",
    "SELECT receiver, s || lpad(n::VARCHAR, 2, '0') AS sv, s || lpad(n::VARCHAR, 2, '0') || " + _BAND + " AS sid, count(*) AS days FROM (SELECT DISTINCT receiver, k // 144 AS day FROM rx), (SELECT * FROM (VALUES ('G', 32), ('E', 36), ('R', 24)) t(s, m), LATERAL (SELECT unnest(range(1, m + 1)) AS n)) GROUP BY ALL",
    _EVENTS,
)
def _(spark, sf):
    """The signals that each file's header announces, and on how many days."""
    h = rinex3.read_headers(spark, write_rinex3(spark, sf))
    found = rinex3.file_signals(h, signals.SATELLITES).join(h.select("file", F.col("marker_name").alias("receiver")), "file")
    return found.groupBy("receiver", "sv", "sid").agg(F.count(F.lit(1)).alias("days"))


# --- line-based products -----------------------------------------------------------

_BOTH = "both_ AS (SELECT k, s || lpad(prn::VARCHAR, 2, '0') AS sv, max(cents) AS cents FROM rx GROUP BY ALL)"


def _satellites(spark: SparkSession, sf: str) -> DataFrame:
    """file (the day), k, sv, cents and the time of the epoch."""
    sv = F.concat("s", F.lpad(F.col("prn").cast("string"), 2, "0"))
    rows = rinex_rows(spark, sf).groupBy("k", sv.alias("sv")).agg(F.max("cents").alias("cents"))
    return rows.select(F.floor(F.col("k") / 144).cast("string").alias("file"), "k", "sv", "cents", F.timestamp_micros(F.col("k") * 600_000_000).cast("timestamp_ntz").alias("epoch"))


@query(
    "sp3_files",
    "SELECT to_timestamp(k * 600)::TIMESTAMP AS epoch, sv, CASE WHEN cents % 7 <> 0 THEN cents::DOUBLE / 1000 * 1000 END AS x, -cents::DOUBLE / 1000 * 1000 AS y, (cents + 1)::DOUBLE / 1000 * 1000 AS z FROM both_",
    _EVENTS + ", " + _BOTH,
)
def _(spark, sf):
    """Orbit files of a day each, written from the events; some coordinates are missing."""
    rows = _satellites(spark, sf)
    km = lambda c: F.format_string("%14.6f", c.cast("double") / 1000)
    x = F.when(F.col("cents") % 7 == 0, F.lit(" 999999.999999")).otherwise(km(F.col("cents")))
    order = F.xxhash64("sv").bitwiseAND(1023)
    points = rows.select("file", (F.col("k") * 2048 + 1 + order).alias("place"), F.concat(F.lit("P"), F.col("sv"), x, km(-F.col("cents")), km(F.col("cents") + 1), F.lit(" 999999.999999")).alias("line"))
    marks = rows.select("file", (F.col("k") * 2048).alias("place"), F.date_format("epoch", "'*  'yyyy MM dd HH mm'  0.00000000'").alias("line")).distinct()
    path = write_lines(points.unionByName(marks), shared_folder(spark, "sp3"))
    return text.read_sp3(spark, path)


@query("clk_files", "SELECT to_timestamp(k * 600)::TIMESTAMP AS epoch, sv, round(cents::DOUBLE / 1e6, 9) AS clock FROM both_", _EVENTS + ", " + _BOTH)
def _(spark, sf):
    """Clock files; every other record is said twice, of which the last counts."""
    rows = _satellites(spark, sf).withColumn("time", F.explode(F.when(F.col("cents") % 2 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))))
    value = F.format_string("%19.12f", F.when(F.col("time") == 1, F.col("cents").cast("double") / 1e6).otherwise(F.lit(9.0)))
    line = F.concat(F.lit("AS "), F.col("sv"), F.date_format("epoch", "'  'yyyy MM dd HH mm'  0.000000  2  '"), value)
    place = (F.col("k") * 2048 + F.xxhash64("sv").bitwiseAND(1023)) * 2 + F.col("time")
    found = text.read_clk(spark, write_lines(rows.select("file", place.alias("place"), line.alias("line")), shared_folder(spark, "clk")))
    return found.select("epoch", "sv", F.round("clock", 9).alias("clock"))


@query(
    "nmea_files",
    """SELECT receiver, k // 144 AS day, (k % 144 * 600)::DOUBLE AS epoch, s || lpad(prn::VARCHAR, 2, '0') AS sv, CASE WHEN cents % 5 <> 0 THEN (cents % 60)::DOUBLE END AS snr FROM rx WHERE cents % 11 <> 0""",
    _EVENTS,
)
def _(spark, sf):
    """Logs of NMEA sentences, one per receiver and day; some check sums are wrong, some strengths missing."""
    rows = rinex_rows(spark, sf).withColumn("day", F.floor(F.col("k") / 144)).withColumn("file", F.concat_ws("_", "receiver", F.col("day").cast("string")))
    checked = lambda body, wrong=F.lit(False): F.concat(F.lit("$"), body, F.lit("*"), F.when(wrong, "ZZ").otherwise(gnss.nmea_checksum(body)))
    when = F.timestamp_micros(F.col("k") * 600_000_000).cast("timestamp_ntz")
    stamp = checked(F.concat(F.lit("GPRMC,"), F.date_format(when, "HHmmss'.00'"), F.lit(",A,4740.0,N,01618.0,E,0,0,010124,,")))
    marks = rows.select("file", (F.col("k") * 100).alias("place"), stamp.alias("line")).distinct()
    talker = F.when(F.col("s") == "G", "GP").when(F.col("s") == "E", "GA").otherwise("GL")
    number = F.col("prn") + F.when(F.col("s") == "R", 64).otherwise(0)
    strength = F.when(F.col("cents") % 5 == 0, "").otherwise((F.col("cents") % 60).cast("string"))
    view = checked(F.concat(talker, F.lit("GSV,1,1,01,"), F.lpad(number.cast("string"), 2, "0"), F.lit(",40,083,"), strength), F.col("cents") % 11 == 0)
    seen = rows.select("file", (F.col("k") * 100 + 1 + F.col("prn") + F.when(F.col("s") == "G", 0).when(F.col("s") == "E", 20).otherwise(40)).alias("place"), view.alias("line"))
    found = text.read_nmea(spark, write_lines(marks.unionByName(seen), shared_folder(spark, "nmea")))
    folder = F.regexp_extract("file", "file=([^/]*)/", 1)
    return found.select(F.regexp_extract(folder, r"^(.*)_\d+$", 1).alias("receiver"), F.regexp_extract(folder, r"_(\d+)$", 1).cast("long").alias("day"), "epoch", "sv", "snr")


@query(
    "sinex_periods",
    """SELECT 'S' || lpad(cust::VARCHAR, 9, '0') AS svn, a::TIMESTAMP AS start, b::TIMESTAMP AS "end", CASE WHEN x THEN substr(xv, 1, 1) END AS prn, CASE WHEN y THEN round(yv::DOUBLE, 2) END AS mass_kg, CASE WHEN z THEN zv::INTEGER END AS channel
    FROM (SELECT *, xa IS NOT NULL AND (xb IS NULL OR xb > a) AS x, ya IS NOT NULL AND (yb IS NULL OR yb > a) AS y, za IS NOT NULL AS z FROM last_) WHERE x OR y OR z""",
    sky.PERIODS,
)
def _(spark, sf):
    """A satellite catalogue written from the orders, read as typed tables and put on one time line."""
    turns, stays, open_ = sky.order_periods(spark, sf)
    svn = F.concat(F.lit("S"), F.lpad(F.col("cust").cast("string"), 9, "0"))
    day = lambda c: F.coalesce(F.date_format(c, "yyyy:DDD:'00000'"), F.lit("0000:000:00000"))
    parts = sky.order_parts(spark, sf)
    n_files = max(16, parts)

    def block(rows: DataFrame, value: Column, place: int) -> DataFrame:
        file = F.pmod("cust", F.lit(n_files)).cast("string").alias("file")
        return rows.where("cust is not null").select(file, (F.lit(place) + F.col("cust")).alias("place"), F.concat_ws(" ", F.lit(""), svn, day("start"), day("end"), value).alias("line"))

    places = {"PRN": 10**13, "MASS": 2 * 10**13, "FREQUENCY_CHANNEL": 3 * 10**13}
    edges = [F.struct(F.lit(at).alias("place"), F.lit(f"{sign}SATELLITE/{b}").alias("line")) for b, p in places.items() for sign, at in (("+", p - 1), ("-", p + 10**12))]
    lines = spark.range(n_files).select(F.col("id").cast("string").alias("file"), F.inline(F.array(*edges)))
    lines = lines.unionByName(block(turns, F.substring("priority", 1, 1), places["PRN"]))
    lines = lines.unionByName(block(stays, F.format_string("%.2f", F.col("price").cast("double")), places["MASS"]))
    lines = lines.unionByName(block(open_, F.col("orders").cast("string"), places["FREQUENCY_CHANNEL"]))
    tables = periods.catalog(text.numbered_lines(spark, write_lines(lines, shared_folder(spark, "sinex"))))
    return periods.timeline({n: tables[n].repartition(parts, "svn") for n in ("prn", "mass", "frequency_channel")}, "svn")
