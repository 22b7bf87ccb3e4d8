"""Registered queries of composed operators, and the SQL that gives the same rows."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from leafray.functions import columns as C
from leafray.functions import geometry, gnss, names, solar
from leafray.operators import aggregate, audit, ephemeris, epochs, filters, grids, interpolate, joins, masks, percell, signals, weights
from leafray.plans import adapters as A
from leafray.plans import registry as R
from leafray.plans.registry import query, r, rounded

# --- ephemeris ------------------------------------------------------------------

_AXES = ("x", "y", "z")
_SPEEDS = ", ".join(f"coalesce(CASE WHEN lag({a}) OVER w IS NOT NULL AND lead({a}) OVER w IS NOT NULL THEN (lead({a}) OVER w - lag({a}) OVER w) / (2 * st) END, (lead({a}) OVER w - {a}) / st, ({a} - lag({a}) OVER w) / st) AS v{a}" for a in _AXES)
_NEXT = ", ".join(f"lead({c}) OVER w AS {c}1" for a in _AXES for c in (a, f"v{a}"))
_PLACES = ", ".join(f"(2*u*u*u - 3*u*u + 1) * {a} + (u*u*u - 2*u*u + u) * h * v{a} + (3*u*u - 2*u*u*u) * {a}1 + (u*u*u - u*u) * h * v{a}1 AS p{a}" for a in _AXES)
_TURN = (math.sin(R._P), math.cos(R._P), math.sin(R._Q), math.cos(R._Q))
_SEEN = R._ORBIT + f""",
va AS (SELECT ob.*, {_SPEEDS} FROM ob JOIN (SELECT sv, median(g) AS st FROM (SELECT sv, t - lag(t) OVER (PARTITION BY sv ORDER BY t) AS g FROM ob) GROUP BY 1) USING (sv) WINDOW w AS (PARTITION BY sv ORDER BY t)),
kn AS (SELECT * FROM (SELECT *, lead(t) OVER w - t AS h, {_NEXT} FROM va WINDOW w AS (PARTITION BY sv ORDER BY t)) WHERE h IS NOT NULL),
kf AS (SELECT sv, min(t) AS t0 FROM kn GROUP BY 1),
tg AS (SELECT event_id, user_id % 8 AS sv, floor(epoch_us(ts) / 1e6) AS t FROM events),
pl AS (SELECT event_id, {_PLACES} FROM (SELECT e.event_id, k.*, (e.t - k.t) / h AS u FROM (SELECT tg.*, greatest(tg.t, t0) AS tk FROM tg JOIN kf USING (sv)) e ASOF JOIN kn k ON e.sv = k.sv AND e.tk >= k.t)),
dv AS (SELECT event_id, px - {R._RX[0]!r} AS dx, py - {R._RX[1]!r} AS dy, pz - {R._RX[2]!r} AS dz FROM pl),
en AS (SELECT event_id, sqrt(dx*dx + dy*dy + dz*dz) AS d, {_TURN[3]!r} * dy - {_TURN[2]!r} * dx AS e, {_TURN[1]!r} * dz - {_TURN[0] * _TURN[3]!r} * dx - {_TURN[0] * _TURN[2]!r} * dy AS n, {_TURN[1] * _TURN[3]!r} * dx + {_TURN[1] * _TURN[2]!r} * dy + {_TURN[0]!r} * dz AS u FROM dv)"""


@query("augment_ephemeris", """SELECT event_id, round(CASE WHEN u >= 0 THEN d END, 0) + 0.0 AS r, round(CASE WHEN u >= 0 THEN acos(u / d) END, 5) + 0.0 AS theta,
    round(CASE WHEN u >= 0 THEN CASE WHEN atan2(e, n) < 0 THEN atan2(e, n) + 2 * pi() ELSE atan2(e, n) END END, 5) + 0.0 AS phi FROM en""", _SEEN)
def _(spark, sf):
    obs = A.table(spark, sf, "events").select((F.col("user_id") % 8).alias("sv"), F.col("ts").alias("epoch"), "event_id")
    out = ephemeris.augment(obs, R._orbits(spark, sf).drop("clock"), R._RX)
    return out.select("event_id", *[(F.round(c, d) + 0.0).alias(c) for c, d in (("r", 0), ("theta", 5), ("phi", 5))])


@query("augment_reported", f"SELECT c.epoch, c.sid, {r('c.snr', 'snr')}, {r('s.theta', 'theta')}, {r('s.phi', 'phi')} FROM (SELECT * FROM o WHERE receiver = 'canopy_01') c LEFT JOIN (SELECT * FROM o WHERE receiver = 'reference_01') s USING (epoch, sid)", R.BASE)
def _(spark, sf):
    return rounded(ephemeris.augment_reported(A.receiver(spark, sf, A.CANOPY), A.receiver(spark, sf, A.SKY)).select("epoch", "sid", "snr", "theta", "phi"))


# --- sun --------------------------------------------------------------------------

_AREA_SHARE = "(SELECT cell_id, a / sum(a) OVER () AS w FROM (SELECT cell_id, (phi_max - phi_min) * (cos(theta_min) - cos(theta_max)) AS a FROM grid))"
_SUN_OF_VG = R._SUN.replace("SELECT event_id, value, ts, floor(epoch_us(ts) / 1000000)::DOUBLE AS t FROM events", "SELECT cell_id, vod, epoch, floor(epoch_us(epoch) / 1000000)::DOUBLE AS t FROM vg")


@query("timeseries_solar_corrected", f"""SELECT time_bucket(INTERVAL '1 day', epoch) AS time, {r('sum(w * v) / sum(w)', 'mean')}, round(sqrt(greatest(sum(w * v * v) / sum(w) - pow(sum(w * v) / sum(w), 2), 0)), 5) + 0.0 AS std, count(DISTINCT cell_id) AS n_cells, count(v) AS n_obs, {r('sum(w)', 'total_weight')}
    FROM (SELECT *, vod * least(2, greatest(0.5, cos(radians(45)) / cos(radians(zenith)))) AS v FROM sun WHERE 90 - zenith > -6 AND vod IS NOT NULL) JOIN {_AREA_SHARE} USING (cell_id) GROUP BY 1""", R.GRID + "," + _SUN_OF_VG)
def _(spark, sf):
    w = weights.normalise(weights.area(A.grid(spark)))
    return rounded(aggregate.solar_corrected_timeseries(A.gridded(spark, sf), R.LAT, R.LON, weights=w).withColumn("std", F.round("std", 5)))


@query("sunrise_sunset", "SELECT day, min(ts) FILTER (90 - zenith > 0) AS sunrise, max(ts) FILTER (90 - zenith > 0) AS sunset FROM sun GROUP BY 1",
    R._SUN.replace("SELECT event_id, value, ts, floor(epoch_us(ts) / 1000000)::DOUBLE AS t FROM events", "SELECT day, day::TIMESTAMP + to_minutes(m::INTEGER) AS ts, epoch(day::TIMESTAMP) + m * 60.0 AS t FROM (SELECT DISTINCT ts::DATE AS day FROM events), range(1440) g(m)"))
def _(spark, sf):
    return solar.sunrise_sunset(A.table(spark, sf, "events").select(F.to_date("ts").alias("day")), R.LAT, R.LON)


# --- cells ------------------------------------------------------------------------

_DAILY = "SELECT cell_id, time_bucket(INTERVAL '1 day', epoch) AS time, round(avg(vod), 6) + 0.0 AS value, count(vod) AS count, count(vod)::DOUBLE AS weight FROM vg WHERE vod IS NOT NULL {} GROUP BY ALL"


@query("percell_hemisphere", _DAILY.format(""), R.GRID)
def _(spark, sf):
    return rounded(aggregate.hemisphere_percell(A.gridded(spark, sf)))


@query("percell_zenith", _DAILY.format("AND cell_id IN (SELECT cell_id FROM grid WHERE round(degrees(theta), 9) <= 30)"), R.GRID)
def _(spark, sf):
    return rounded(aggregate.zenith_percell(A.gridded(spark, sf), A.grid(spark)))


for _n, (_mask, _where) in R._MASKS.items():

    @query(f"mask_cells_{_n}", f"SELECT cell_id, count(*) AS n, {r('avg(vod)', 'mean')} FROM vg JOIN (SELECT cell_id FROM grid WHERE {_where}) USING (cell_id) GROUP BY 1", R.GRID)
    def _(spark, sf, mask=_mask):
        """One row per cell that a mask leaves."""
        kept = A.gridded(spark, sf).join(masks.select(A.grid(spark), mask()), "cell_id", "left_semi")
        return rounded(kept.groupBy("cell_id").agg(F.count(F.lit(1)).alias("n"), F.avg("vod").alias("mean")))


_WEIGHTS = {
    "solid_angle": (R._AREA, lambda v, g: weights.area(g)),
    "obs_count": (R._COUNT, lambda v, g: weights.observation_count(v, g)),
    "inv_var": (R._INV, lambda v, g: weights.inverse_variance(v, g, regularization=0.1)),
    "sin_elev": (R._SIN, lambda v, g: weights.sin_elevation(g)),
    "product": (R._norm(f"(SELECT cell_id, a.weight * b.weight AS weight FROM {R._AREA} a JOIN {R._COUNT} b USING (cell_id))"), lambda v, g: weights.combine([weights.area(g), weights.observation_count(v, g)])),
    "sum": (R._norm(f"(SELECT cell_id, a.weight + b.weight AS weight FROM {R._SIN} a JOIN {R._COUNT} b USING (cell_id))"), lambda v, g: weights.combine([weights.sin_elevation(g), weights.observation_count(v, g)], "add")),
}
for _n, (_sql, _make) in _WEIGHTS.items():

    @query(f"weight_cells_{_n}", f"SELECT cell_id, {r('avg(weight)', 'weight')}, {r('sum(vod * weight)', 'weighted')} FROM vg JOIN {_sql} USING (cell_id) GROUP BY 1", R.GRID)
    def _(spark, sf, make=_make):
        """One row per observed cell: its weight and what its observations weigh."""
        v = A.gridded(spark, sf)
        out = v.join(make(v, A.grid(spark)).select("cell_id", "weight"), "cell_id").groupBy("cell_id").agg(F.avg("weight").alias("weight"), F.sum(F.col("vod") * F.col("weight")).alias("weighted"))
        return rounded(out)


# --- epochs -----------------------------------------------------------------------


@query("epochs_in_range", "SELECT event_id FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12 12:00:00'")
def _(spark, sf):
    bounds = [F.to_timestamp_ntz(F.lit(t)) for t in ("2024-01-05 00:00:00", "2024-01-12 12:00:00")]
    return epochs.in_range(A.table(spark, sf, "events"), *bounds, epoch="ts").select("event_id")


_GAPS = """e AS (SELECT DISTINCT receiver, sid, epoch_us(epoch) AS t FROM o),
gp AS (SELECT receiver, sid, gap, count(*) AS c FROM (SELECT receiver, sid, (t - lag(t) OVER (PARTITION BY receiver, sid ORDER BY t)) // 1000000 AS gap FROM e) WHERE gap > 0 GROUP BY ALL),
md AS (SELECT receiver, sid, gap AS sampling FROM (SELECT *, row_number() OVER (PARTITION BY receiver, sid ORDER BY c DESC, gap) AS k FROM gp) WHERE k = 1),
iv AS (SELECT receiver, sid, count(*) AS n_epochs, any_value(sampling) AS sampling FROM e LEFT JOIN md USING (receiver, sid) GROUP BY ALL)"""


@query("epoch_completeness", "SELECT receiver, sid, n_epochs, sampling, 604800 AS dump, (604800 // sampling) - n_epochs AS missing, coalesce(n_epochs * sampling = 604800, false) AS complete FROM iv", R.BASE + ", " + _GAPS)
def _(spark, sf):
    return epochs.completeness(A.observations(spark, sf), ["receiver", "sid"], dump_seconds=604_800).withColumn("dump", F.col("dump").cast("int"))


@query("epoch_intervals", "SELECT receiver, sid, n_epochs, sampling, n_epochs * sampling AS dump FROM iv", R.BASE + ", " + _GAPS)
def _(spark, sf):
    return epochs.intervals(A.observations(spark, sf), ["receiver", "sid"])


@query("coverage_compatible", """SELECT a.lo AS main_start, a.hi AS main_end, b.lo AS processed_start, b.hi AS processed_end, round((b.hi - b.lo) / (a.hi - a.lo), 6) AS share, (b.hi - b.lo) / (a.hi - a.lo) >= 0.7 AS compatible
    FROM (SELECT min(ts)::DATE AS lo, max(ts)::DATE AS hi FROM events) a, (SELECT min(ts)::DATE AS lo, max(ts)::DATE AS hi FROM events WHERE event_type = 'purchase') b""")
def _(spark, sf):
    e = A.table(spark, sf, "events")
    return epochs.coverage_compatible(e, e.where("event_type = 'purchase'"), epoch="ts").withColumn("share", F.round("share", 6))


@query("observation_conformance", f"""SELECT receiver, sum(n)::BIGINT AS n_rows, sum(n - 1)::BIGINT AS repeated, sum(bs)::BIGINT AS malformed_sid, sum(b)::BIGINT AS bad_snr, 0::BIGINT AS no_epoch, sum(n - 1) + sum(bs) + sum(b) = 0 AS conforms FROM
    (SELECT receiver, epoch, sid, count(*) AS n, count(*) FILTER (NOT regexp_full_match(sid, '[A-Z][0-9]{{2}}\\|[A-Z][0-9]\\|[A-Z]')) AS bs, count(*) FILTER (snr < 0 OR snr > 70) AS b FROM (SELECT * FROM o UNION ALL SELECT * FROM o WHERE snr > 45) GROUP BY ALL) GROUP BY 1""", R.BASE)
def _(spark, sf):
    o = A.observations(spark, sf)
    return epochs.conformance(o.unionByName(o.where("snr > 45")))


@query("ragged_offsets", "SELECT l_orderkey, n, coalesce(sum(n) OVER (ORDER BY l_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS \"offset\" FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)")
def _(spark, sf):
    counts = A.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return epochs.ragged_offsets(counts, "l_orderkey", "n", 4096)


# --- names and attributes ----------------------------------------------------------


@query("recipe_fields", "SELECT event_id, year(ts) AS year, dayofyear(ts) AS doy, hour(ts) AS hour, minute(ts) AS minute, time_bucket(INTERVAL '1 minute', ts) AS start, true AS valid FROM events")
def _(spark, sf):
    e = A.table(spark, sf, "events")
    name = F.concat(F.lit("site_"), F.date_format("ts", "yyyy"), F.lpad(F.dayofyear("ts").cast("string"), 3, "0"), F.lit("-"), F.date_format("ts", "HHmm"), F.lit(".rnx"))
    found = names.recipe_fields(name, [("skip", 5), ("year", 4), ("doy", 3), ("skip", 1), ("hour", 2), ("minute", 2), ("skip", 4)])
    return e.select("event_id", *[c.cast("long").alias(n) if n != "valid" else c.alias(n) for n, c in found.items()], names.recipe_time(found).alias("start"))


@query("cleansed_attributes", "SELECT event_id, CASE WHEN event_type <> 'view' THEN json_extract_string(props, '$.k') END AS k FROM events")
def _(spark, sf):
    e = A.table(spark, sf, "events").withColumn("attrs", F.from_json("props", "map<string,string>"))
    left = F.when(F.col("event_type") == "view", C.without_keys(F.col("attrs"), ["k"])).otherwise(C.without_keys(F.col("attrs"), ["other"]))
    return e.select("event_id", F.try_element_at(left, F.lit("k")).alias("k"))


# --- audit --------------------------------------------------------------------------


@query("audit_groups", f"""SELECT system, 'snr' AS variable, count(d) AS n_compared, {r('max(abs(d))', 'max_abs')}, {r('avg(abs(d))', 'mae')}, {r('quantile_cont(abs(d), 0.9)', 'p90')}, 0.25 AS atol, max(abs(d)) <= 0.25 AND avg(abs(d)) <= 0 AS passed
    FROM (SELECT c.sid[1] AS system, c.snr - s.snr AS d FROM (SELECT * FROM o WHERE receiver = 'canopy_01') c JOIN (SELECT * FROM o WHERE receiver = 'reference_01') s USING (epoch, sid)) GROUP BY 1""", R.BASE)
def _(spark, sf):
    store = lambda n: A.receiver(spark, sf, n).withColumn("system", F.substring("sid", 1, 1))
    out = audit.run(store(A.CANOPY), store(A.SKY), ["snr"], "system", tier="scientific")
    return rounded(out.select("system", "variable", "n_compared", "max_abs", "mae", "p90", "atol", "passed"))


@query("except_signal_epochs", "SELECT label FROM (SELECT epoch::VARCHAR || ' ' || sid AS label, receiver FROM o) WHERE receiver = 'canopy_01' EXCEPT SELECT epoch::VARCHAR || ' ' || sid FROM o WHERE receiver = 'reference_01'", R.BASE)
def _(spark, sf):
    label = lambda n: A.receiver(spark, sf, n).select(F.concat_ws(" ", F.col("epoch").cast("string"), "sid").alias("label"))
    return joins.dropped_labels(label(A.CANOPY), label(A.SKY), "label")


@query("temporal_aggregate_adaptive_day", f"SELECT receiver, sid, time_bucket(INTERVAL '1 day', epoch) AS epoch, {', '.join(r(f'avg({c})', c, 9) for c in ('snr', 'phi', 'theta'))} FROM o GROUP BY ALL", R.BASE)
def _(spark, sf):
    """Epochs lie closer than a day, so here the aggregation does run."""
    return rounded(aggregate.temporal_aggregate(A.observations(spark, sf), "1D"), 9)


_OF_SYSTEM = "(SELECT time, sum(value * count) / sum(count) AS m FROM (SELECT cell_id, time_bucket(INTERVAL '6 hours', epoch) AS time, avg(vod) AS value, count(vod) AS count FROM vg WHERE vod IS NOT NULL AND sid LIKE '{}%' GROUP BY ALL) GROUP BY time)"


@query("averaged_diurnal_systems", f"""SELECT slot, {r('avg(mean)', 'mean')}, round(sqrt(sum(std * std)) / count(*), 5) + 0.0 AS std, sum(n)::BIGINT AS n FROM (
    SELECT hour(time)::INTEGER AS slot, avg(m) AS mean, stddev_pop(m) AS std, count(m) AS n FROM {_OF_SYSTEM.format('G')} GROUP BY 1 UNION ALL
    SELECT hour(time)::INTEGER AS slot, avg(m) AS mean, stddev_pop(m) AS std, count(m) AS n FROM {_OF_SYSTEM.format('E')} GROUP BY 1) GROUP BY slot HAVING count(*) = 2""", R.GRID)
def _(spark, sf):
    """The day's course of two different series, at the hours that both have."""
    v = A.gridded(spark, sf)
    out = percell.averaged_diurnal([aggregate.percell_timeseries(v.where(F.col("sid").startswith(s)), "6h") for s in ("G", "E")])
    return rounded(out.withColumn("std", F.round("std", 5)))


_VELOCITIES = R._ORBIT + f", va AS (SELECT ob.*, {_SPEEDS} FROM ob JOIN (SELECT sv, median(g) AS st FROM (SELECT sv, t - lag(t) OVER (PARTITION BY sv ORDER BY t) AS g FROM ob) GROUP BY 1) USING (sv) WINDOW w AS (PARTITION BY sv ORDER BY t))"


@query("sp3_velocity_axes", f"SELECT sv, t, {r('vx', digits=3)}, {r('vy', digits=3)}, {r('vz', digits=3)} FROM va", _VELOCITIES)
def _(spark, sf):
    v = interpolate.velocities(R._orbits(spark, sf))
    return v.select("sv", (C.micros(F.col("epoch")) / 1e6).alias("t"), *[(F.round(c, 3) + 0.0).alias(c) for c in ("vx", "vy", "vz")])


@query("sbf_ranges", """SELECT event_id, round(CASE WHEN m <> 0 OR lo <> 0 THEN (m * 4294967296.0 + lo) * 0.001 END, 3) + 0.0 AS pseudorange, round((user_id - 75) * 1000 * 1e-4, 4) + 0.0 AS doppler,
    round(CASE WHEN m <> 0 OR lo <> 0 THEN (m * 4294967296.0 + lo) * 0.001 / (299792458.0 / 1575420000.0) + ((user_id % 100 - 50) * 65536.0 + event_id % 1000) * 0.001 END, 3) + 0.0 AS phase,
    round(CASE WHEN m <> 0 OR lo <> 0 THEN (m * 4294967296.0 + lo) * 0.001 + (CASE WHEN user_id % 8 >= 4 THEN user_id % 8 - 8 ELSE user_id % 8 END * 65536.0 + event_id % 1000) * 0.001 END, 3) + 0.0 AS second_range,
    round((user_id - 75) * 1000 * 1e-4 * 0.75 + (CASE WHEN (user_id // 8) % 32 >= 16 THEN (user_id // 8) % 32 - 32 ELSE (user_id // 8) % 32 END * 65536.0 + event_id % 1000) * 1e-4, 4) + 0.0 AS second_doppler,
    CASE WHEN user_id % 32 = 31 THEN (event_id // 8) % 32 + 32 ELSE user_id % 32 END AS signal, TIMESTAMP '1980-01-06' + to_days(7 * (2000 + user_id)::INTEGER) + to_milliseconds(event_id) - INTERVAL '18 seconds' AS utc FROM (SELECT *, user_id % 16 AS m, event_id * 7 AS lo FROM events)""")
def _(spark, sf):
    e = A.table(spark, sf, "events")
    u, n = F.col("user_id"), F.col("event_id")
    first, speed = gnss.pseudorange(u, n * 7), gnss.doppler((u - 75) * 1000)
    columns = {
        "pseudorange": F.round(first, 3) + 0.0,
        "doppler": F.round(speed, 4) + 0.0,
        "phase": F.round(gnss.carrier_phase(first, u % 100 - 50, n % 1000, F.lit(1_575_420_000.0)), 3) + 0.0,
        "second_range": F.round(gnss.second_pseudorange(first, u, n % 1000), 3) + 0.0,
        "second_doppler": F.round(gnss.second_doppler(speed, u, n % 1000, F.lit(0.75)), 4) + 0.0,
        "signal": gnss.signal_number(u, n),
        "utc": gnss.tow_to_time(2000 + u, n, F.lit(18)),
    }
    return e.select("event_id", *[c.alias(k) for k, c in columns.items()])


@query("percell_pipeline_combined", """SELECT l_orderkey, l_linenumber, v BETWEEN 5000 AND 60000 AND (n < 5 OR NOT s > 0 OR abs(v - a) <= 1.2 * s) AS kept FROM t JOIN (SELECT cell_id, count(*) AS n, avg(v) AS a, stddev_pop(v) AS s
    FROM t GROUP BY 1) USING (cell_id)""", f"t AS ({R._L})")
def _(spark, sf):
    return filters.pipeline(R._lines(spark, sf), R._CHAIN, "v", by=["cell_id"], mode="combined").select("l_orderkey", "l_linenumber", F.col("mask_pipeline").alias("kept"))


@query("ecef_positions", f"""SELECT event_id, round((n + h) * cos(p) * cos(l), 3) + 0.0 AS x, round((n + h) * cos(p) * sin(l), 3) + 0.0 AS y, round((n * (1 - {geometry.E2!r}) + h) * sin(p), 3) + 0.0 AS z FROM
    (SELECT *, {geometry.A!r} / sqrt(1 - {geometry.E2!r} * sin(p) * sin(p)) AS n FROM (SELECT event_id, radians(user_id - 75.0) AS p, radians(event_id % 360 - 180.0) AS l, value AS h FROM events))""")
def _(spark, sf):
    at = geometry.ecef_columns(F.col("user_id") - 75.0, F.col("event_id") % 360 - 180.0, F.col("value"))
    return A.table(spark, sf, "events").select("event_id", *[(F.round(c, 3) + 0.0).alias(n) for n, c in at.items()])


@query("read_deduplicated", """WITH l AS (SELECT DISTINCT ts::DATE AS d FROM events WHERE event_type = 'purchase' AND value > 100), i AS (SELECT d::TIMESTAMP AS a, d::TIMESTAMP + INTERVAL '12 hours' AS b FROM l)
    SELECT epoch, sid, arg_max(value, event_id) AS snr FROM (SELECT time_bucket(INTERVAL '1 hour', ts) AS epoch, event_type AS sid, value, event_id FROM events) JOIN i ON epoch BETWEEN a AND b GROUP BY ALL""")
def _(spark, sf):
    e = A.table(spark, sf, "events")
    day = F.to_date("ts").cast("timestamp_ntz")
    ledger = e.where("event_type = 'purchase' and value > 100").select(day.alias("start"), (day + F.expr("interval 12 hours")).alias("end"), F.col("ts").alias("written_at"))
    obs = e.select(F.lit("r").alias("receiver"), C.time_bin(F.col("ts"), "1h").alias("epoch"), F.col("event_type").alias("sid"), F.col("value").alias("snr"), F.col("event_id").alias("ingest_seq"))
    return joins.read_deduplicated(obs, ledger).select("epoch", "sid", "snr")


@query("product_coverage", "SELECT user_id, round(100.0 * count(*) FILTER (value > 50) / count(*), 6) + 0.0 AS coverage, 100.0 * count(*) FILTER (value > 50) / count(*) >= 80 AS enough FROM events GROUP BY 1")
def _(spark, sf):
    e = A.table(spark, sf, "events").select("user_id", F.when(F.col("value") > 50, F.col("value")).alias("clock"))
    return rounded(interpolate.coverage(e, "clock", "user_id"))


@query("prefer_bands", "SELECT sid, count(*) AS n FROM o WHERE sid NOT LIKE '%|L1|%' GROUP BY 1", R.BASE)
def _(spark, sf):
    """Of the group that L1 and E1 share, E1 only."""
    groups = signals.overlap_groups(spark)
    shared = groups.where("band = 'E1'").first()["overlap_group"]
    return signals.prefer_bands(A.observations(spark, sf), groups, {shared: "E1"}).groupBy("sid").agg(F.count(F.lit(1)).alias("n"))


@query("percell_fingerprint", "SELECT event_id, md5(event_id::VARCHAR || '|' || coalesce(user_id::VARCHAR, '') || '|' || event_type) AS print FROM events")
def _(spark, sf):
    e = A.table(spark, sf, "events")
    return e.select("event_id", percell.fingerprint(e, "event_id", "user_id", "event_type").alias("print"))


@query("frequencies", "SELECT DISTINCT sid, CASE split_part(sid, '|', 2) WHEN 'G1' THEN 1602.0 ELSE 1575.42 END AS freq_center FROM o", R.BASE)
def _(spark, sf):
    known = A.observations(spark, sf).select("sid").distinct()
    bands = signals.bands(spark).select("system", "band", "freq_center")
    parts = known.select("sid", F.substring("sid", 1, 1).alias("system"), F.split("sid", r"\|").getItem(1).alias("band"))
    return parts.join(F.broadcast(bands), ["system", "band"]).select("sid", "freq_center")


# --- other grids --------------------------------------------------------------------

_NEAR = """dir AS (SELECT DISTINCT phi, theta FROM vod),
near AS (SELECT phi, theta, cell_id FROM (SELECT d.phi, d.theta, g.cell_id, row_number() OVER (PARTITION BY d.phi, d.theta ORDER BY
    round(pow(sin(d.theta) * cos(d.phi) - sin(g.theta) * cos(g.phi), 2) + pow(sin(d.theta) * sin(d.phi) - sin(g.theta) * sin(g.phi), 2) + pow(cos(d.theta) - cos(g.theta), 2), 12), g.cell_id) AS k FROM dir d CROSS JOIN grid g) WHERE k = 1),
vg AS (SELECT v.*, n.cell_id FROM vod v JOIN near n USING (phi, theta))"""
_GRIDS = {
    "equal_angle": ({"degrees": 10.0}, """SELECT 0::BIGINT AS cell_id, 0.0::DOUBLE AS phi, 0.0::DOUBLE AS theta UNION ALL
        SELECT (1 + i * 36 + j)::BIGINT, (j + 0.5) * 2 * pi() / 36, radians(10) + i * radians(10) FROM range(8) a(i), range(36) b(j)"""),
    "equirectangular": ({"degrees": 10.0}, "SELECT (i * 36 + j)::BIGINT AS cell_id, (j + 0.5) * radians(10) AS phi, (i + 0.5) * radians(10) AS theta FROM range(9) a(i), range(36) b(j)"),
    "fibonacci": ({"points": 300}, "SELECT id::BIGINT AS cell_id, fmod(id * pi() * (3 - sqrt(5)), 2 * pi()) AS phi, acos(1 - 2 * (id + 0.5) / 600) AS theta FROM range(600) a(id) WHERE acos(1 - 2 * (id + 0.5) / 600) <= pi() / 2"),
    "healpix": ({"degrees": 10.0}, """SELECT p::BIGINT AS cell_id, (p + 1 - 2 * i * (i - 1) - 0.5) * pi() / (2 * i) AS phi, acos(1 - i * i / 192.0) AS theta FROM (SELECT p, floor((1 + sqrt(1 + 2 * p)) / 2) AS i FROM range(112) a(p)) UNION ALL
        SELECT p::BIGINT, ((p - 112) % 32 + 1 - (((p - 112) // 32 + 1) % 2) / 2.0) * pi() / 16, acos((16 - ((p - 112) // 32 + 8)) * 2 / 24.0) FROM range(112, 400) a(p)"""),
}
for _n, (_how, _sql) in _GRIDS.items():

    @query(f"cells_{_n}", f"SELECT cell_id, count(*) AS n, {r('avg(vod)', 'mean')} FROM vg GROUP BY 1", R.BASE + f", grid AS ({_sql}), " + _NEAR)
    def _(spark, sf, kind=_n, how=_how):
        """Observations by the nearest centre of another kind of grid."""
        v = grids.assign_cells(A.depth(spark, sf), grids.create(spark, kind, **how), 0.3)
        return rounded(v.groupBy("cell_id").agg(F.count(F.lit(1)).alias("n"), F.avg("vod").alias("mean")))


@query(
    "linear_interp",
    """SELECT event_id, round(CASE WHEN e.t = k.t THEN k.x WHEN k.h IS NOT NULL THEN k.x + (e.t - k.t) / k.h * (k.x1 - k.x) END, 0) + 0.0 AS x,
    round(CASE WHEN e.t = k.t THEN k.z WHEN k.h IS NOT NULL THEN k.z + (e.t - k.t) / k.h * (k.z1 - k.z) END, 0) + 0.0 AS z FROM tg e ASOF LEFT JOIN kn k ON e.sv = k.sv AND e.t >= k.t""",
    R._ORBIT
    + """, kn AS (SELECT sv, t, x, z, lead(t) OVER w - t AS h, lead(x) OVER w AS x1, lead(z) OVER w AS z1 FROM ob WINDOW w AS (PARTITION BY sv ORDER BY t)),
    tg AS (SELECT event_id, user_id % 8 AS sv, floor(epoch_us(ts) / 1e6) AS t FROM events)""",
)
def _(spark, sf):
    """Positions of all events by straight lines between the knots; after the last knot there is none."""
    targets = A.table(spark, sf, "events").select((F.col("user_id") % 8).alias("sv"), F.col("ts").alias("epoch"), "event_id")
    met = interpolate.linear(R._orbits(spark, sf), targets.select("sv", "epoch").distinct(), axes=["x", "z"])
    return targets.join(met, ["sv", "epoch"], "left").select("event_id", *[(F.round(c, 0) + 0.0).alias(c) for c in ("x", "z")])
