"""Registered queries and the SQL that gives the same rows."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafray.functions import columns as C
from leafray.functions import geometry, gnss, solar
from leafray.operators import aggregate, audit, filters, grids, interpolate, joins, masks, percell, robust, signals, vod, weights
from leafray.plans import adapters as A

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: A fixture site.
LAT, LON, HEIGHT = 47.7, 16.3, 250.0
BASE, GRID, PERCELL = A.SQL, A.SQL + "," + A.SQL_GRID, A.SQL + "," + A.SQL_GRID + "," + A.SQL_PERCELL


def query(name: str, sql: str | None = None, ctes: str = ""):
    """Register a query; ``ctes`` go before the SQL that checks it."""

    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = (f"WITH {ctes} " if ctes else "") + sql
        return f

    return keep


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, without negative zeros, so that both engines' sums compare."""
    return df.select(*[(F.round(c, digits) + 0.0).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def r(expr: str, name: str | None = None, digits: int = 6) -> str:
    return f"round({expr}, {digits}) + 0.0 AS {name or expr}"


def _percell(spark, sf):
    return aggregate.percell_timeseries(A.gridded(spark, sf), "6h")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["agg_by_cell_mean"](spark, sf_dir)


# --- depth -----------------------------------------------------------------


@query("vod_tau_omega", f"SELECT epoch, sid, {r('phi')}, {r('theta')}, {r('delta_snr')}, {r('vod')} FROM vod", BASE)
def _(spark, sf):
    return rounded(A.depth(spark, sf))


@query("vod_radial_diff", f"SELECT c.epoch, c.sid, {r('c.r - s.r', 'r_diff')} FROM (SELECT *, 2e7 + snr AS r FROM o WHERE receiver = 'canopy_01') c JOIN (SELECT *, 2e7 + snr AS r FROM o WHERE receiver = 'reference_01') s USING (epoch, sid)", BASE)
def _(spark, sf):
    far = lambda n: A.receiver(spark, sf, n).withColumn("r", 2e7 + F.col("snr"))
    return rounded(vod.tau_omega(far(A.CANOPY), far(A.SKY), radial_difference=True).select("epoch", "sid", "r_diff"))


@query("vod_daily_summary", f"SELECT epoch::DATE::VARCHAR AS day, {r('avg(vod)', 'mean_vod')}, {r('stddev_pop(vod)', 'std_vod')}, count(DISTINCT epoch) AS n_epochs FROM vod GROUP BY 1", BASE)
def _(spark, sf):
    return rounded(vod.daily_summary(A.depth(spark, sf)).withColumn("day", F.col("day").cast("string")))


# --- aggregation -------------------------------------------------------------

for _stat, _f in (("mean", "avg"), ("median", "median"), ("std", "stddev_samp"), ("count", "count")):

    @query(f"agg_by_cell_{_stat}", f"SELECT cell_id, {r(f'{_f}(vod)', 'value') if _stat != 'count' else 'count(vod) AS value'} FROM vg GROUP BY cell_id", GRID)
    def _(spark, sf, stat=_stat):
        return rounded(aggregate.by_cell(A.gridded(spark, sf), stat=stat))


@query("agg_on_grid", f"SELECT g.cell_id, {r('v.value', 'value')} FROM grid g LEFT JOIN (SELECT cell_id, avg(vod) AS value FROM vg GROUP BY 1) v USING (cell_id)", GRID)
def _(spark, sf):
    return rounded(aggregate.on_grid(aggregate.by_cell(A.gridded(spark, sf)), A.grid(spark)))


@query("percell_timeseries", f"SELECT cell_id, time, {r('value')}, count, weight FROM pc", PERCELL)
def _(spark, sf):
    return rounded(_percell(spark, sf))


@query("percell_dense", f"""SELECT g.cell_id, t.time, {r('p.value', 'value')}, coalesce(p.count, 0) AS count, p.weight FROM grid g CROSS JOIN (SELECT unnest(generate_series(min(time), max(time), INTERVAL '6 hours')) AS time FROM pc) t
    LEFT JOIN pc p ON p.cell_id = g.cell_id AND p.time = t.time""", PERCELL)
def _(spark, sf):
    return rounded(aggregate.dense(_percell(spark, sf), A.grid(spark), "6h").withColumn("count", F.coalesce("count", F.lit(0))))


@query("global_average", f"SELECT time, {r('sum(value * weight) / sum(weight)', 'mean')}, {r('stddev_pop(value)', 'spatial_std')}, sum(weight) AS total_weight, count(value) AS n_cells FROM pc GROUP BY time", PERCELL)
def _(spark, sf):
    return rounded(aggregate.global_average(_percell(spark, sf)))


@query("regional_average", f"SELECT time, {r('sum(value * weight) / sum(weight)', 'mean')}, count(value) AS n_cells FROM pc WHERE cell_id IN (SELECT cell_id FROM grid WHERE theta <= radians(30)) GROUP BY time", PERCELL)
def _(spark, sf):
    return rounded(aggregate.regional_average(_percell(spark, sf), masks.select(A.grid(spark), masks.polar(0, 30, degrees=True))))


@query("diurnal_patterns", f"SELECT cell_id, hour(time)::INTEGER AS hour, {r('avg(value)', 'value')}, {r('avg(weight)', 'weight')} FROM pc GROUP BY ALL", PERCELL)
def _(spark, sf):
    return rounded(aggregate.diurnal_patterns(_percell(spark, sf)))


@query("spatial_patterns", f"SELECT cell_id, {r('avg(value)', 'value')}, {r('avg(weight)', 'weight')} FROM pc GROUP BY ALL", PERCELL)
def _(spark, sf):
    return rounded(aggregate.spatial_patterns(_percell(spark, sf)))


@query("spatial_statistics", f"SELECT g.cell_id, {r('avg(vod)', 'mean')}, {r('stddev_samp(vod)', 'std')}, count(vod) AS count, {r('median(vod)', 'median')} FROM grid g LEFT JOIN vg v USING (cell_id) GROUP BY g.cell_id", GRID)
def _(spark, sf):
    return rounded(aggregate.spatial_statistics(A.gridded(spark, sf), A.grid(spark)).withColumn("count", F.coalesce("count", F.lit(0))))


@query("grid_coverage", f"SELECT {r('100.0 * count(m) / count(*)', 'coverage')}, count(m) AS covered, count(*) AS cells FROM grid LEFT JOIN (SELECT cell_id, avg(vod) AS m FROM vg GROUP BY 1) USING (cell_id)", GRID)
def _(spark, sf):
    return rounded(aggregate.coverage_percent(aggregate.spatial_statistics(A.gridded(spark, sf), A.grid(spark))))


@query("value_histogram", "SELECT least(49, floor((l_extendedprice - lo) / (hi - lo) * 50))::INTEGER AS bin, count(*) AS n FROM lineitem, (SELECT min(l_extendedprice)::DOUBLE AS lo, max(l_extendedprice)::DOUBLE AS hi FROM lineitem) GROUP BY 1")
def _(spark, sf):
    return aggregate.histogram(A.table(spark, sf, "lineitem").select(F.col("l_extendedprice").cast("double").alias("v")), "v")


for _m in ("mean", "median"):

    @query(f"temporal_aggregate_{_m}", f"SELECT receiver, sid, time_bucket(INTERVAL '6 hours', epoch) AS epoch, {', '.join(r(f'{'avg' if _m == 'mean' else 'median'}({c})', c) for c in ('snr', 'phi', 'theta'))} FROM o GROUP BY ALL", BASE)
    def _(spark, sf, method=_m):
        return rounded(aggregate.temporal_aggregate(A.observations(spark, sf), "6h", method, adaptive=False))


@query("temporal_aggregate_adaptive", f"SELECT receiver, sid, epoch, {', '.join(r(c) for c in ('snr', 'phi', 'theta'))} FROM o", BASE)
def _(spark, sf):
    return rounded(aggregate.temporal_aggregate(A.observations(spark, sf), "30min").select("receiver", "sid", "epoch", "snr", "phi", "theta"))


@query("resample_signals", f"SELECT sid, time_bucket(INTERVAL '1 day', epoch) AS epoch, {', '.join(r(f'avg({c})', c) for c in ('vod', 'phi', 'theta'))} FROM vod GROUP BY ALL", BASE)
def _(spark, sf):
    return rounded(aggregate.resample_signals(A.depth(spark, sf)))


@query("bottlenecks_topk", f"SELECT event_type, {r('sum(value)', 'total', 4)}, {r('avg(value)', 'mean')}, count(*) AS n, {r('100 * sum(value) / (SELECT sum(value) FROM events)', 'percent')} FROM events GROUP BY 1 ORDER BY sum(value) DESC LIMIT 3")
def _(spark, sf):
    e = A.table(spark, sf, "events")
    total = e.agg(F.sum("value").alias("all"))
    out = e.groupBy("event_type").agg(F.sum("value").alias("total"), F.avg("value").alias("mean"), F.count(F.lit(1)).alias("n")).join(F.broadcast(total))
    top = out.orderBy(F.desc("total")).limit(3)
    return top.select("event_type", (F.round("total", 4) + 0.0).alias("total"), (F.round("mean", 6) + 0.0).alias("mean"), "n", (F.round(100 * F.col("total") / F.col("all"), 6) + 0.0).alias("percent"))


@query("coverage_day", "SELECT epoch::DATE::VARCHAR AS day, receiver, count(DISTINCT epoch) AS n_epochs, count(DISTINCT epoch) >= 0.95 * 24 AS complete FROM o GROUP BY ALL", BASE)
def _(spark, sf):
    o = A.observations(spark, sf).groupBy(F.to_date("epoch").cast("string").alias("day"), "receiver").agg(F.countDistinct("epoch").alias("n_epochs"))
    return o.withColumn("complete", F.col("n_epochs") >= 0.95 * 24)


@query("catalog_date_range", "SELECT year(ts) * 1000 + dayofyear(ts) AS yyyydoy, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM events WHERE year(ts) * 1000 + dayofyear(ts) BETWEEN 2024005 AND 2024020 GROUP BY 1")
def _(spark, sf):
    e = A.table(spark, sf, "events").select("ts", (F.year("ts") * 1000 + F.dayofyear("ts")).cast("long").alias("yyyydoy"))
    return e.where(F.col("yyyydoy").between(2024005, 2024020)).groupBy("yyyydoy").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@query("weighted_timeseries", f"""SELECT time_bucket(INTERVAL '1 day', epoch) AS time, {r('sum(w * vod) / sum(w)', 'mean')}, round(sqrt(greatest(sum(w * vod * vod) / sum(w) - pow(sum(w * vod) / sum(w), 2), 0)), 5) + 0.0 AS std,
    count(DISTINCT cell_id) AS n_cells, count(vod) AS n_obs, {r('sum(w)', 'total_weight')} FROM vg JOIN (SELECT cell_id, a / sum(a) OVER () AS w FROM (SELECT cell_id, (phi_max - phi_min) * (cos(theta_min) - cos(theta_max)) AS a FROM grid)) USING (cell_id) GROUP BY 1""", GRID)
def _(spark, sf):
    w = weights.normalise(weights.area(A.grid(spark)))
    return rounded(aggregate.weighted_timeseries(A.gridded(spark, sf), "1D", w).withColumn("std", F.round("std", 5)))


@query("diurnal_cycle", f"""SELECT b.bin::INTEGER AS bin, CASE WHEN n >= 10 THEN round(m, 6) + 0.0 END AS mean, CASE WHEN n >= 10 THEN round(s, 5) + 0.0 END AS std, CASE WHEN n >= 10 THEN n ELSE 0 END AS n_obs FROM range(24) b(bin)
    LEFT JOIN (SELECT greatest(ceil((hour(epoch) + minute(epoch) / 60.0) / 1.0) - 1, 0)::INTEGER AS bin, avg(vod) AS m, sqrt(greatest(avg(vod * vod) - pow(avg(vod), 2), 0)) AS s, count(vod) AS n FROM vg GROUP BY 1) USING (bin)""", GRID)
def _(spark, sf):
    return rounded(aggregate.diurnal_cycle(A.gridded(spark, sf), cells=240).withColumn("std", F.round("std", 5)))


@query("averaged_diurnal", f"""SELECT hour(time)::INTEGER AS slot, {r('avg(m)', 'mean')}, round(sqrt(pow(stddev_pop(m), 2) * 2) / 2, 6) + 0.0 AS std, 2 * count(m) AS n FROM
    (SELECT time, sum(value * weight) / sum(weight) AS m FROM pc GROUP BY time) GROUP BY 1""", PERCELL)
def _(spark, sf):
    return rounded(percell.averaged_diurnal([_percell(spark, sf), _percell(spark, sf)]))


@query("diurnal_dynamics_30min", f"""SELECT (hour(time) * 2 + minute(time) // 30)::INTEGER AS slot, {r('avg(m)', 'mean')}, {r('stddev_pop(m)', 'std')}, count(m) AS n, lpad(hour(time)::VARCHAR, 2, '0') || ':' || lpad((minute(time) // 30 * 30)::VARCHAR, 2, '0') AS label
    FROM (SELECT time, sum(value * weight) / sum(weight) AS m FROM pc GROUP BY time) GROUP BY ALL""", PERCELL)
def _(spark, sf):
    return rounded(percell.diurnal_dynamics(_percell(spark, sf), half_hours=True))


for _stat, _f in (("mean", "avg"), ("median", "median"), ("std", "stddev_pop")):

    @query(f"percell_stats_{_stat}", f"SELECT cell_id, {r(f'{_f}(value)', 'value')} FROM pc GROUP BY 1", PERCELL)
    def _(spark, sf, stat=_stat):
        return rounded(percell.stats(_percell(spark, sf), stat))


@query("percell_trend_cv", f"""SELECT cell_id, {r('max(value) - min(value)', 'range')}, CASE WHEN count(value) > 3 THEN round(regr_slope(value, idx), 6) + 0.0 END AS trend, CASE WHEN avg(value) <> 0 THEN round(stddev_pop(value) / avg(value), 4) + 0.0 END AS cv
    FROM pc JOIN (SELECT time, (row_number() OVER (ORDER BY time) - 1)::DOUBLE AS idx FROM (SELECT DISTINCT time FROM pc)) USING (time) GROUP BY 1""", PERCELL)
def _(spark, sf):
    return rounded(percell.temporal_stats(_percell(spark, sf)).withColumn("cv", F.round("cv", 4)))


@query("percell_coverage", f"SELECT cell_id, sum(count)::BIGINT AS n_obs, {r('100.0 * count(value) / (SELECT count(DISTINCT time) FROM pc)', 'coverage')} FROM pc GROUP BY 1", PERCELL)
def _(spark, sf):
    return rounded(percell.coverage(_percell(spark, sf)))


@query("elevation_bins", f"""SELECT floor(e / 5)::INTEGER AS elev_bin, {r('avg(m)', 'mean')}, count(m) AS n_cells, (floor(e / 5)::INTEGER + 0.5) * 5::DOUBLE AS centre FROM
    (SELECT cell_id, avg(value) AS m FROM pc GROUP BY 1) JOIN (SELECT cell_id, round(90 - degrees(theta), 9) AS e FROM grid) USING (cell_id) GROUP BY floor(e / 5)""", PERCELL)
def _(spark, sf):
    return rounded(percell.elevation_bins(_percell(spark, sf), A.grid(spark)).withColumn("centre", F.col("centre").cast("double")))


for _by, _f in (("hour", "hour"), ("week", "weekofyear"), ("month", "month")):

    @query(f"heatmap_theta_{_by}", f"SELECT least(8, floor(round(degrees(theta), 9) / 10))::INTEGER AS theta_bin, {_f}(time)::INTEGER AS {_by}, {r('avg(value)', 'mean')}, count(value) AS n FROM pc JOIN grid USING (cell_id) GROUP BY ALL", PERCELL)
    def _(spark, sf, by=_by):
        return rounded(percell.theta_time_heatmap(_percell(spark, sf), A.grid(spark), by))


@query("hour_distributions", f"SELECT hour(time)::INTEGER AS hour, {r('quantile_cont(value, 0.25)', 'q1')}, {r('quantile_cont(value, 0.5)', 'q2')}, {r('quantile_cont(value, 0.75)', 'q3')}, count(value) AS n FROM pc GROUP BY 1", PERCELL)
def _(spark, sf):
    return rounded(percell.distributions(_percell(spark, sf)))


# --- filters -----------------------------------------------------------------

_L = "SELECT l_orderkey, l_linenumber, l_suppkey % 50 AS cell_id, l_extendedprice::DOUBLE AS v FROM lineitem"


def _lines(spark, sf):
    t = A.table(spark, sf, "lineitem")
    return t.select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 50).alias("cell_id"), F.col("l_extendedprice").cast("double").alias("v"))


_GLOBAL = {
    "zscore": (filters.ZScore(1.5), "abs(v - avg_) <= 1.5 * std_", "avg(v) AS avg_, stddev_pop(v) AS std_"),
    "iqr": (filters.Iqr(0.3), "v BETWEEN q1 - 0.3 * (q3 - q1) AND q3 + 0.3 * (q3 - q1)", "quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3"),
    "percentile": (filters.Percentile(), "v BETWEEN q1 AND q3", "quantile_cont(v, 0.05) AS q1, quantile_cont(v, 0.95) AS q3"),
    "range": (filters.Range(5000.0, 60000.0), "v BETWEEN 5000 AND 60000", "count(*) AS one"),
    "custom": (filters.Custom(lambda c: c % 2 < 1), "v % 2 < 1", "count(*) AS one"),
}
for _n, (_filter, _test, _stats) in _GLOBAL.items():

    @query(f"filter_{_n}", f"SELECT l_orderkey, l_linenumber, {_test} AS kept FROM t, (SELECT {_stats} FROM t)", f"t AS ({_L})")
    def _(spark, sf, f=_filter, n=_n):
        return filters.apply(_lines(spark, sf), f, "v").select("l_orderkey", "l_linenumber", F.col(f"mask_{n}").alias("kept"))

    if _n != "custom":
        _few = {"zscore": "n < 5 OR NOT std_ > 0", "iqr": "n < 5 OR NOT q3 > q1", "percentile": "n < 5", "range": "n < 5"}[_n]

        @query(f"percell_filter_{_n}", f"SELECT l_orderkey, l_linenumber, ({_few}) OR {_test} AS kept FROM t JOIN (SELECT cell_id, count(v) AS n, {_stats} FROM t GROUP BY 1) USING (cell_id)", f"t AS ({_L})")
        def _(spark, sf, f=_filter, n=_n):
            return filters.apply(_lines(spark, sf), f, "v", by=["cell_id"]).select("l_orderkey", "l_linenumber", F.col(f"mask_{n}").alias("kept"))


_CHAIN = [filters.Range(5000.0, 60000.0), filters.ZScore(1.2)]
for _mode in ("sequential", "combined"):

    @query(f"pipeline_{_mode}", "SELECT l_orderkey, l_linenumber, v BETWEEN 5000 AND 60000 AND abs(v - a) <= 1.2 * s AS kept FROM t, (SELECT avg(v) AS a, stddev_pop(v) AS s FROM t)", f"t AS ({_L})")
    def _(spark, sf, mode=_mode):
        return filters.pipeline(_lines(spark, sf), _CHAIN, "v", mode=mode).select("l_orderkey", "l_linenumber", F.col("mask_pipeline").alias("kept"))


@query("percell_pipeline_sequential", """SELECT l_orderkey, l_linenumber, v BETWEEN 5000 AND 60000 AND (n < 5 OR NOT s > 0 OR abs(v - a) <= 1.2 * s) AS kept FROM t JOIN (SELECT cell_id, count(*) AS n, avg(v) AS a, stddev_pop(v) AS s
    FROM t WHERE v BETWEEN 5000 AND 60000 GROUP BY 1) USING (cell_id)""", f"t AS ({_L})")
def _(spark, sf):
    return filters.pipeline(_lines(spark, sf), _CHAIN, "v", by=["cell_id"]).select("l_orderkey", "l_linenumber", F.col("mask_pipeline").alias("kept"))


@query("filter_removed", "SELECT count(*) AS total, count(*) FILTER (NOT coalesce(abs(v - a) <= 1.5 * s, false)) AS removed FROM t, (SELECT avg(v) AS a, stddev_pop(v) AS s FROM t)", f"t AS ({_L})")
def _(spark, sf):
    return filters.removed(filters.apply(_lines(spark, sf), filters.ZScore(1.5), "v"), "mask_zscore")


@query("sid_pattern", "SELECT DISTINCT sid FROM o WHERE sid LIKE 'G%' AND split_part(sid, '|', 2) = 'L1'", BASE)
def _(spark, sf):
    return A.observations(spark, sf).where(filters.signal_pattern("G", "L1")).select("sid").distinct()


@query("drop_empty_signals", "SELECT count(*) AS n FROM o WHERE sid IN (SELECT sid FROM o WHERE snr IS NOT NULL)", BASE)
def _(spark, sf):
    return filters.drop_empty_signals(A.observations(spark, sf), ["snr"]).agg(F.count(F.lit(1)).alias("n"))


@query("ingest_checks", f"""SELECT receiver, count(*) AS n, {', '.join(r(f'{f}({c})', f'{f}_{c}') for c in ('snr', 'theta', 'phi') for f in ('min', 'max'))},
    min(snr) >= 0 AND max(snr) <= 70 AND min(theta) >= -0.01 AND max(theta) <= pi() / 2 + 0.01 AND min(phi) >= -0.01 AND max(phi) <= 2 * pi() + 0.01 AS valid FROM o GROUP BY 1""", BASE)
def _(spark, sf):
    return rounded(filters.ingest_checks(A.observations(spark, sf)))


# --- robust statistics -----------------------------------------------------

_EV = "SELECT event_id, event_type, user_id % 8 AS cell_id, ts, value FROM events"


def _events(spark, sf):
    return A.table(spark, sf, "events").select("event_id", "event_type", (F.col("user_id") % 8).alias("cell_id"), "ts", "value")


def _hampel_sql(scale: str, least: int, spread: str) -> str:
    return f"""SELECT event_id, n >= {least} AND {spread} AS is_processed, n >= {least} AND {spread} AND abs(value - med) > 3.0 * {scale} * mad AS is_outlier FROM t JOIN
    (SELECT event_type, cell_id, count(value) AS n, median(value) AS med, mad(value) AS mad FROM t GROUP BY ALL) USING (event_type, cell_id)"""


@query("hampel_cell_sid", _hampel_sql("1.0", 20, "mad > 0"), f"t AS ({_EV})")
def _(spark, sf):
    return robust.hampel(_events(spark, sf), "value", ["event_type", "cell_id"]).select("event_id", "is_processed", "is_outlier")


@query("sigma_clip", _hampel_sql("1.4826", 5, "true"), f"t AS ({_EV})")
def _(spark, sf):
    return robust.sigma_clip(_events(spark, sf), "value", ["event_type", "cell_id"]).select("event_id", "is_processed", "is_outlier")


@query("hampel_sliding", """SELECT event_id, coalesce(n >= 5 AND mad > 0 AND abs(value - med) > 3.0 * 1.4826 * mad, false) AS is_outlier FROM
    (SELECT event_id, value, count(value) OVER w AS n, median(value) OVER w AS med, mad(value) OVER w AS mad FROM t
     WINDOW w AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND INTERVAL 1 HOUR FOLLOWING))""", f"t AS ({_EV})")
def _(spark, sf):
    return robust.sliding_hampel(_events(spark, sf), 1.0, "value", ["event_type"], "ts").select("event_id", "is_outlier")


@query("hampel_aggr", f"""SELECT cell_id, sid, epoch, {r('vod')}, n >= 3 AND mad > 0 AS is_processed, n >= 3 AND mad > 0 AND abs(vod - med) > 3 * mad AS is_outlier FROM b JOIN
    (SELECT cell_id, sid, count(vod) AS n, median(vod) AS med, mad(vod) AS mad FROM b GROUP BY ALL) USING (cell_id, sid)""", GRID + ", b AS (SELECT cell_id, sid, time_bucket(INTERVAL '6 hours', epoch) AS epoch, avg(vod) AS vod FROM vg GROUP BY ALL)")
def _(spark, sf):
    out = robust.hampel_on_bins(A.gridded(spark, sf), "6h", min_obs=3)
    return rounded(out.select("cell_id", "sid", "epoch", "vod", "is_processed", "is_outlier"))


# --- masks and weights -------------------------------------------------------

_MASKS = {
    "phi_wrap": (lambda: masks.azimuth(350, 20, degrees=True), "phi >= radians(350) OR phi <= radians(20)"),
    "theta": (lambda: masks.polar(10, 45, degrees=True), "theta BETWEEN radians(10) AND radians(45)"),
    "elevation": (lambda: masks.elevation(30, 90), "round(90 - degrees(theta), 9) BETWEEN 30 AND 90"),
    "sector": (lambda: masks.sector(10, 60), "(phi >= radians(340) OR phi <= radians(40)) AND theta BETWEEN 0 AND pi() / 2"),
    "hemisphere": (lambda: masks.hemisphere("east"), "phi BETWEEN radians(45) AND radians(135)"),
    "exclude": (lambda: ~masks.cells(range(20)), "cell_id NOT IN (SELECT unnest(range(20)))"),
    "and_or": (lambda: masks.combine([masks.combine([masks.hemisphere("south"), masks.elevation(0, 50)]), masks.cells([0, 1, 2])], "OR"), "(phi BETWEEN radians(135) AND radians(225) AND round(90 - degrees(theta), 9) BETWEEN 0 AND 50) OR cell_id IN (0, 1, 2)"),
}
for _n, (_mask, _where) in _MASKS.items():

    @query(f"mask_{_n}", f"SELECT count(*) AS n, count(DISTINCT cell_id) AS cells, {r('sum(vod)', 'total', 4)} FROM vg JOIN (SELECT cell_id FROM grid WHERE {_where}) USING (cell_id)", GRID)
    def _(spark, sf, mask=_mask):
        kept = A.gridded(spark, sf).join(masks.select(A.grid(spark), mask()), "cell_id", "left_semi")
        return rounded(kept.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("cell_id").alias("cells"), F.sum("vod").alias("total")), 4)


@query("mask_quality", f"SELECT cell_id, n, {r('m')} FROM (SELECT cell_id, count(vod) AS n, avg(vod) AS m FROM vg GROUP BY 1) WHERE n >= 3", GRID)
def _(spark, sf):
    stats = A.gridded(spark, sf).groupBy("cell_id").agg(F.count("vod").alias("n"), F.avg("vod").alias("m"))
    return rounded(stats.where(masks.threshold("n", low=3)))


@query("mask_boundary", "SELECT count(*) AS n FROM vg WHERE cell_id IN (SELECT cell_id FROM grid WHERE theta_max > radians(84))", GRID)
def _(spark, sf):
    return A.gridded(spark, sf).join(masks.boundary(A.grid(spark)), "cell_id", "left_semi").agg(F.count(F.lit(1)).alias("n"))


_AREA = "(SELECT cell_id, (phi_max - phi_min) * (cos(theta_min) - cos(theta_max)) AS weight FROM grid)"
_COUNT = "(SELECT g.cell_id, count(vod)::DOUBLE AS weight FROM grid g LEFT JOIN vg USING (cell_id) GROUP BY 1)"
_INV = "(SELECT g.cell_id, CASE WHEN count(vod) >= 2 AND var_samp(vod) > 0 THEN 1 / (var_samp(vod) + 0.1) ELSE 0 END AS weight FROM grid g LEFT JOIN vg USING (cell_id) GROUP BY 1)"
_SIN = "(SELECT cell_id, greatest(cos(theta), 0) AS weight FROM grid)"


def _weight_query(name: str, sql: str, make):
    """Weights are applied to the observations, so that the query's work grows with them."""

    @query(name, f"SELECT {r('sum(vod * weight)', 'weighted', 4)}, {r('sum(weight)', 'total', 4)}, count(*) AS n FROM vg JOIN {sql} USING (cell_id)", GRID)
    def _(spark, sf):
        v = A.gridded(spark, sf)
        w = make(v, A.grid(spark))
        return rounded(v.join(w, "cell_id").agg(F.sum(F.col("vod") * F.col("weight")).alias("weighted"), F.sum("weight").alias("total"), F.count(F.lit(1)).alias("n")), 4)


_norm = lambda s: f"(SELECT cell_id, weight / sum(weight) OVER () AS weight FROM {s})"
_weight_query("weights_solid_angle", _AREA, lambda v, g: weights.area(g))
_weight_query("weights_obs_count", _COUNT, lambda v, g: weights.observation_count(v, g))
_weight_query("weights_inv_var", _INV, lambda v, g: weights.inverse_variance(v, g, regularization=0.1))
_weight_query("weights_sin_elev", _SIN, lambda v, g: weights.sin_elevation(g))
_weight_query("weights_snr", "(SELECT g.cell_id, coalesce(median(delta_snr), 0) AS weight FROM grid g LEFT JOIN vg USING (cell_id) GROUP BY 1)", lambda v, g: weights.signal_strength(v, g, "delta_snr", "median"))
_weight_query("weights_uniform", "(SELECT cell_id, 1.0 / 240 AS weight FROM grid)", lambda v, g: weights.uniform(g))
_weight_query("weights_product", _norm(f"(SELECT cell_id, a.weight * b.weight AS weight FROM {_AREA} a JOIN {_COUNT} b USING (cell_id))"), lambda v, g: weights.combine([weights.area(g), weights.observation_count(v, g)]))
_weight_query("weights_sum", _norm(f"(SELECT cell_id, a.weight + b.weight AS weight FROM {_SIN} a JOIN {_COUNT} b USING (cell_id))"), lambda v, g: weights.combine([weights.sin_elevation(g), weights.observation_count(v, g)], "add"))

# --- sun ----------------------------------------------------------------------

_SUN = f"""
s0 AS (SELECT event_id, value, ts, floor(epoch_us(ts) / 1000000)::DOUBLE AS t FROM events),
s1 AS (SELECT *, (t / 86400.0 + 2440587.5 - 2451545.0) / 36525.0 AS jc FROM s0),
s2 AS (SELECT *, (280.46646 + jc * (36000.76983 + jc * 0.0003032)) % 360.0 AS ml0, 357.52911 + jc * (35999.05029 - 0.0001537 * jc) AS ma, 0.016708634 - jc * (0.000042037 + 0.0000001267 * jc) AS ec FROM s1),
s3 AS (SELECT *, CASE WHEN ml0 < 0 THEN ml0 + 360 ELSE ml0 END AS ml FROM s2),
s4 AS (SELECT *, ml + sin(radians(ma)) * (1.914602 - jc * (0.004817 + 0.000014 * jc)) + sin(radians(2 * ma)) * (0.019993 - 0.000101 * jc) + sin(radians(3 * ma)) * 0.000289 - 0.00569 - 0.00478 * sin(radians(125.04 - 1934.136 * jc)) AS app,
    23 + (26 + (21.448 - jc * (46.815 + jc * (0.00059 - jc * 0.001813))) / 60) / 60 + 0.00256 * cos(radians(125.04 - 1934.136 * jc)) AS ob FROM s3),
s5 AS (SELECT *, asin(sin(radians(ob)) * sin(radians(app))) AS de, pow(tan(radians(ob / 2)), 2) AS y FROM s4),
s6 AS (SELECT *, 4 * degrees(y * sin(2 * radians(ml)) - 2 * ec * sin(radians(ma)) + 4 * ec * y * sin(radians(ma)) * cos(2 * radians(ml)) - 0.5 * y * y * sin(4 * radians(ml)) - 1.25 * ec * ec * sin(2 * radians(ma))) AS eq FROM s5),
s7 AS (SELECT *, (((t % 86400.0) / 60.0 + eq + 4 * {LON} + 1440) % 1440.0) / 4 - 180 AS h0 FROM s6),
s8 AS (SELECT *, CASE WHEN h0 < 0 THEN h0 + 360 ELSE h0 END AS h FROM s7),
s9 AS (SELECT *, degrees(acos(sin(radians({LAT})) * sin(de) + cos(radians({LAT})) * cos(de) * cos(radians(h)))) AS zenith FROM s8),
sun AS (SELECT *, degrees(acos(greatest(-1, least(1, (sin(radians({LAT})) * cos(radians(zenith)) - sin(de)) / (cos(radians({LAT})) * sin(radians(zenith))))))) AS azimuth FROM s9)"""


def _sunlit(spark, sf):
    return A.table(spark, sf, "events").select("event_id", "ts", "value").withColumns(solar.position(F.col("ts"), LAT, LON))


@query("solar_position", f"SELECT event_id, {r('zenith', digits=4)}, {r('azimuth', digits=3)}, {r('90 - zenith', 'elevation', 4)} FROM sun", _SUN)
def _(spark, sf):
    s = _sunlit(spark, sf)
    return s.select("event_id", *[(F.round(c, d) + 0.0).alias(c) for c, d in (("zenith", 4), ("azimuth", 3), ("elevation", 4))])


@query("solar_correct_normalize", f"SELECT event_id, round(value * least(2, greatest(0.5, cos(radians(45)) / cos(radians(zenith)))), 4) + 0.0 AS corrected FROM sun", _SUN)
def _(spark, sf):
    return _sunlit(spark, sf).select("event_id", (F.round(solar.normalised(F.col("value"), F.col("zenith")), 4) + 0.0).alias("corrected"))


@query("solar_correct_cos", "SELECT event_id, round(value / least(1, greatest(0.1, cos(radians(zenith)))), 4) + 0.0 AS corrected FROM sun", _SUN)
def _(spark, sf):
    return _sunlit(spark, sf).select("event_id", (F.round(solar.cosine_corrected(F.col("value"), F.col("zenith")), 4) + 0.0).alias("corrected"))


@query("filter_daytime", "SELECT event_id FROM sun WHERE 90 - zenith > -6", _SUN)
def _(spark, sf):
    return _sunlit(spark, sf).where(solar.is_daytime(F.col("elevation"))).select("event_id")


@query("diurnal_cycle_solar", """SELECT b.bin::INTEGER AS bin, CASE WHEN n >= 10 THEN round(m, 6) + 0.0 END AS mean, CASE WHEN n >= 10 THEN round(s, 4) + 0.0 END AS std, CASE WHEN n >= 10 THEN n ELSE 0 END AS n_obs FROM range(12) b(bin) LEFT JOIN
    (SELECT least(11, greatest(0, floor((90 - zenith + 20) / (110.0 / 12))))::INTEGER AS bin, avg(value) AS m, stddev_pop(value) AS s, count(*) AS n FROM sun GROUP BY 1) USING (bin)""", _SUN)
def _(spark, sf):
    s = _sunlit(spark, sf).withColumn("cell_id", F.lit(0)).withColumn("sb", solar.solar_bin(F.col("elevation")))
    return rounded(aggregate.binned_cycle(s, F.col("sb"), 12, value="value").withColumn("std", F.round("std", 4)))


# --- joins --------------------------------------------------------------------


def _typed(spark, sf, kind):
    return A.table(spark, sf, "events").where(F.col("event_type") == kind).select((F.col("user_id") % 8).alias("k"), "ts", "event_id", "value")


@query("asof_nearest", f"""SELECT v.event_id, CASE WHEN n.t IS NULL OR (p.t IS NOT NULL AND v.t - p.t <= n.t - v.t) THEN p.value ELSE n.value END AS aux_value,
    round(CASE WHEN n.t IS NULL OR (p.t IS NOT NULL AND v.t - p.t <= n.t - v.t) THEN v.t - p.t ELSE n.t - v.t END / 1e6, 6) + 0.0 AS asof_gap
    FROM v ASOF LEFT JOIN a p ON v.k = p.k AND v.t >= p.t ASOF LEFT JOIN a n ON v.k = n.k AND v.t <= n.t""",
    "v AS (SELECT event_id, user_id % 8 AS k, epoch_us(ts) AS t FROM events WHERE event_type = 'view'), a AS (SELECT user_id % 8 AS k, epoch_us(ts) AS t, max(value) AS value FROM events WHERE event_type = 'purchase' GROUP BY ALL)")
def _(spark, sf):
    aux = _typed(spark, sf, "purchase").select("k", "ts", F.col("value").alias("aux_value"))
    out = joins.nearest_asof(_typed(spark, sf, "view").select("k", "ts", "event_id"), aux, ["k"], "ts", ["aux_value"])
    return out.select("event_id", "aux_value", (F.round("asof_gap", 6) + 0.0).alias("asof_gap"))


_IV = """iv AS (SELECT o_orderkey AS file_hash, o_custkey, min(l_shipdate)::TIMESTAMP AS a, max(l_shipdate)::TIMESTAMP AS b FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL)"""


def _intervals(spark, sf):
    o = A.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    l = A.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").cast("timestamp_ntz").alias("start"), F.max("l_shipdate").cast("timestamp_ntz").alias("end"))
    return o.join(l, F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_orderkey").alias("file_hash"), "o_custkey", "start", "end")


@query("interval_overlap", "SELECT x.file_hash, y.file_hash AS file_hash_2 FROM iv x JOIN iv y ON x.o_custkey = y.o_custkey AND x.file_hash < y.file_hash AND x.a <= y.b AND x.b >= y.a", _IV)
def _(spark, sf):
    v = _intervals(spark, sf)
    return joins.overlapping(v, v, 90 * 86_400, on=["o_custkey"], open_ends=False).where("file_hash < file_hash_2").select("file_hash", "file_hash_2")


@query("dedup_hash_or_overlap", """SELECT b.file_hash, CASE WHEN EXISTS (SELECT 1 FROM lg WHERE lg.file_hash = b.file_hash) THEN 'hash_match' WHEN EXISTS (SELECT 1 FROM lg WHERE lg.a <= b.b AND lg.b >= b.a) THEN 'temporal_overlap'
    WHEN EXISTS (SELECT 1 FROM bt x WHERE x.file_hash <> b.file_hash AND x.a <= b.a AND x.b >= b.b) THEN 'contained' END AS reason FROM bt b""", _IV + ", lg AS (SELECT * FROM iv WHERE year(a) <= 1996), bt AS (SELECT * FROM iv WHERE year(b) >= 1996)")
def _(spark, sf):
    """The files that reach into 1996 or later against a ledger of those that began by its end."""
    v = _intervals(spark, sf)
    batch, ledger = v.where(F.year("end") >= 1996), v.where(F.year("start") <= 1996)
    return joins.ledger_verdicts(batch, ledger, 30 * 86_400).select("file_hash", "reason")


@query("dedup_hash_or_overlap_all", """SELECT b.file_hash, CASE WHEN EXISTS (SELECT 1 FROM lg WHERE lg.file_hash = b.file_hash) THEN 'hash_match' WHEN EXISTS (SELECT 1 FROM lg WHERE lg.a <= b.b AND lg.b >= b.a) THEN 'temporal_overlap'
    WHEN EXISTS (SELECT 1 FROM iv x WHERE x.file_hash <> b.file_hash AND x.a <= b.a AND x.b >= b.b) THEN 'contained' END AS reason FROM iv b""", _IV + ", lg AS (SELECT * FROM iv WHERE year(a) <= 1995)")
def _(spark, sf):
    v = _intervals(spark, sf)
    return joins.ledger_verdicts(v, v.where(F.year("start") <= 1995), 30 * 86_400).select("file_hash", "reason")


@query("latest_per_interval", "SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders) WHERE k = 1")
def _(spark, sf):
    o = A.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate").withColumn("o", F.struct("o_orderdate", "o_orderkey"))
    return joins.latest(o, ["o_custkey"], "o").drop("o")


@query("dedup_keep_first", "SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events) WHERE k = 1")
def _(spark, sf):
    e = A.table(spark, sf, "events").select("user_id", "event_id", F.struct("ts", "event_id").alias("o"))
    return joins.first_seen(e, ["user_id"], "o").drop("o")


@query("validity_join", """SELECT e.event_id, coalesce(p.svn, -1) AS svn FROM events e LEFT JOIN p ON e.user_id % 8 = p.k AND e.ts::DATE BETWEEN p.a AND p.b""",
    """p AS (SELECT k, svn, a, coalesce(lead(a) OVER (PARTITION BY k ORDER BY a) - 1, DATE '9999-01-01') AS b FROM (SELECT user_id % 8 AS k, ts::DATE AS a, min(event_id) AS svn FROM events WHERE event_type = 'purchase' GROUP BY ALL))""")
def _(spark, sf):
    from pyspark.sql import Window

    e = A.table(spark, sf, "events")
    p = e.where("event_type = 'purchase'").groupBy((F.col("user_id") % 8).alias("k"), F.to_date("ts").alias("start")).agg(F.min("event_id").alias("svn"))
    p = p.withColumn("end", F.date_sub(F.lead("start").over(Window.partitionBy("k").orderBy("start")), 1))
    facts = e.select("event_id", (F.col("user_id") % 8).alias("k"), F.to_date("ts").alias("day"))
    return joins.valid_at(facts, p, "k", "day", ["svn"], bucket_days=30).select("event_id", F.coalesce("svn", F.lit(-1)).alias("svn"))


@query("svid_range_join", "SELECT event_id, system, coalesce(user_id - shift, -1) AS number FROM events LEFT JOIN (VALUES " + ", ".join(str(x).replace('"', "'") for x in signals.NUMBER_RANGES) + ") d(lo, hi, system, shift) ON user_id BETWEEN lo AND hi")
def _(spark, sf):
    out = joins.in_ranges(A.table(spark, sf, "events").select("event_id", "user_id"), signals.number_ranges(spark), "user_id", ["system", "shift"])
    return out.select("event_id", "system", F.coalesce(F.col("user_id") - F.col("shift"), F.lit(-1)).alias("number"))


_SIDS = "u AS (SELECT DISTINCT sid FROM o UNION SELECT 'G31|L1|C' UNION SELECT 'E30|E1|C')"


@query("sid_pad", f"SELECT sid, count(snr) AS n, {r('avg(snr)', 'mean')} FROM u LEFT JOIN o USING (sid) GROUP BY sid", BASE + "," + _SIDS)
def _(spark, sf):
    o = A.observations(spark, sf)
    wanted = o.select("sid").distinct().union(spark.createDataFrame([("G31|L1|C",), ("E30|E1|C",)], "sid string"))
    return rounded(signals.pad(o, wanted).groupBy("sid").agg(F.count("snr").alias("n"), F.avg("snr").alias("mean")))


@query("sv_to_sid", f"SELECT o2.epoch, u.sid, {r('snr')} FROM (SELECT epoch, split_part(sid, '|', 1) AS sv, avg(snr) AS snr FROM o GROUP BY ALL) o2 JOIN (SELECT DISTINCT sid, split_part(sid, '|', 1) AS sv FROM o) u USING (sv)", BASE)
def _(spark, sf):
    o = A.observations(spark, sf).withColumn("sv", F.split("sid", r"\|").getItem(0))
    by = o.groupBy("epoch", "sv").agg(F.avg("snr").alias("snr"))
    return rounded(signals.expand_satellites(by, o.select("sid", "sv").distinct()).select("epoch", "sid", "snr"))


@query("merge_codes", f"SELECT epoch, split_part(sid, '|', 1) AS sv, split_part(sid, '|', 2) AS band, {r('arg_min(snr, code)', 'snr')} FROM (SELECT epoch, sid, CASE receiver WHEN 'canopy_01' THEN 'C' ELSE 'W' END AS code, snr FROM o) GROUP BY ALL", BASE)
def _(spark, sf):
    o = A.observations(spark, sf)
    code = F.when(F.col("receiver") == A.CANOPY, "C").otherwise("W")
    return rounded(signals.merge_codes(o.withColumn("sid", F.concat(F.regexp_replace("sid", "C$", ""), code))))


@query("union_concat", "SELECT receiver, count(*) AS n FROM (SELECT * FROM o WHERE receiver = 'canopy_01' UNION ALL SELECT * FROM o WHERE receiver = 'reference_01') GROUP BY 1", BASE)
def _(spark, sf):
    o = A.observations(spark, sf)
    both = o.where(F.col("receiver") == A.CANOPY).unionByName(o.where(F.col("receiver") == A.SKY), allowMissingColumns=True)
    return both.groupBy("receiver").agg(F.count(F.lit(1)).alias("n"))


@query("intersect_labels", "SELECT epoch FROM o WHERE receiver = 'canopy_01' INTERSECT SELECT epoch FROM o WHERE receiver = 'reference_01'", BASE)
def _(spark, sf):
    return joins.shared_labels(A.receiver(spark, sf, A.CANOPY), A.receiver(spark, sf, A.SKY), "epoch")


@query("except_labels", "SELECT epoch FROM o WHERE receiver = 'canopy_01' EXCEPT SELECT epoch FROM o WHERE receiver = 'reference_01'", BASE)
def _(spark, sf):
    return joins.dropped_labels(A.receiver(spark, sf, A.CANOPY), A.receiver(spark, sf, A.SKY), "epoch")


@query("outer_merge", f"SELECT epoch, sid, {r('c.snr', 'canopy')}, {r('s.snr', 'sky')} FROM (SELECT * FROM o WHERE receiver = 'canopy_01') c FULL JOIN (SELECT * FROM o WHERE receiver = 'reference_01') s USING (epoch, sid)", BASE)
def _(spark, sf):
    pick = lambda n, c: A.receiver(spark, sf, n).select("epoch", "sid", F.col("snr").alias(c))
    return rounded(pick(A.CANOPY, "canopy").join(pick(A.SKY, "sky"), ["epoch", "sid"], "full"))


@query("replace_interval", "SELECT epoch::DATE::VARCHAR AS day, count(*) AS n, round(sum(snr), 4) + 0.0 AS total FROM (SELECT epoch, snr FROM o WHERE NOT epoch BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-07' UNION ALL SELECT epoch, snr + 1 FROM o WHERE receiver = 'canopy_01' AND epoch BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-07') GROUP BY 1", BASE)
def _(spark, sf):
    o = A.observations(spark, sf)
    bounds = [F.to_timestamp_ntz(F.lit(f"2024-01-{d} 00:00:00")) for d in ("05", "07")]
    new = o.where((F.col("receiver") == A.CANOPY) & F.col("epoch").between(*bounds)).withColumn("snr", F.col("snr") + 1)
    out = joins.replace_interval(o, new, *bounds).groupBy(F.to_date("epoch").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.sum("snr").alias("total"))
    return rounded(out, 4)


@query("reassignments", "SELECT user_id, event_id, previous FROM (SELECT user_id, event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events) WHERE previous IS NOT NULL AND previous <> event_type")
def _(spark, sf):
    e = A.table(spark, sf, "events").withColumn("start", F.struct("ts", "event_id"))
    return joins.changes(e, "user_id", "event_type").select("user_id", "event_id", "previous")


# --- geometry and interpolation -----------------------------------------------

_ORBIT = """orb AS (SELECT user_id % 8 AS sv, epoch_us(time_bucket(INTERVAL '15 minutes', ts)) / 1000000 AS t, avg(value) AS c FROM events GROUP BY ALL),
ob AS (SELECT sv, t, c, 2.6e7 * cos(t / 7000.0 + sv) AS x, 2.6e7 * sin(t / 7000.0 + sv) AS y, 1e7 * sin(t / 9000.0 + sv) AS z FROM orb)"""


def _orbits(spark, sf):
    e = A.table(spark, sf, "events")
    q = e.groupBy((F.col("user_id") % 8).alias("sv"), C.time_bin(F.col("ts"), "15min").alias("epoch")).agg(F.avg("value").alias("clock"))
    t = C.micros(F.col("epoch")) / 1e6
    return q.withColumns({"x": 2.6e7 * F.cos(t / 7000.0 + F.col("sv")), "y": 2.6e7 * F.sin(t / 7000.0 + F.col("sv")), "z": 1e7 * F.sin(t / 9000.0 + F.col("sv"))})


_V = """vel AS (SELECT *, coalesce(CASE WHEN xb IS NOT NULL AND xa IS NOT NULL THEN (xa - xb) / (2 * st) END, (xa - x) / st, (x - xb) / st) AS vx FROM (SELECT *, lag(x) OVER w AS xb, lead(x) OVER w AS xa FROM ob JOIN
    (SELECT sv, median(g) AS st FROM (SELECT sv, t - lag(t) OVER (PARTITION BY sv ORDER BY t) AS g FROM ob) GROUP BY 1) USING (sv) WINDOW w AS (PARTITION BY sv ORDER BY t)))"""


@query("sp3_velocity", f"SELECT sv, t, {r('vx', digits=2)} FROM vel", _ORBIT + ", " + _V)
def _(spark, sf):
    v = interpolate.velocities(_orbits(spark, sf))
    return v.select("sv", (C.micros(F.col("epoch")) / 1e6).alias("t"), (F.round("vx", 2) + 0.0).alias("vx"))


@query("hermite_interp", """SELECT event_id, round((2*u*u*u - 3*u*u + 1) * x + (u*u*u - 2*u*u + u) * h * vx + (-2*u*u*u + 3*u*u) * x1 + (u*u*u - u*u) * h * vx1, 0) + 0.0 AS x FROM (SELECT e.event_id, k.*, (e.t - k.t) / h AS u FROM tg e ASOF JOIN kn k ON e.sv = k.sv AND e.t >= k.t)""",
    _ORBIT + ", " + _V + """, kn AS (SELECT * FROM (SELECT sv, t, x, vx, lead(t) OVER w - t AS h, lead(x) OVER w AS x1, lead(vx) OVER w AS vx1 FROM vel WINDOW w AS (PARTITION BY sv ORDER BY t)) WHERE h IS NOT NULL),
    tg AS (SELECT event_id, user_id % 8 AS sv, floor(epoch_us(ts) / 1e6) AS t FROM events WHERE event_type = 'view')""")
def _(spark, sf):
    v = interpolate.velocities(_orbits(spark, sf), axes=["x"])
    targets = A.table(spark, sf, "events").where("event_type = 'view'").select((F.col("user_id") % 8).alias("sv"), F.col("ts").alias("epoch"), "event_id")
    met = interpolate.positions(v, targets.select("sv", "epoch").distinct(), axes=["x"])
    return targets.join(met, ["sv", "epoch"]).select("event_id", (F.round("x", 0) + 0.0).alias("x"))


@query("clock_segments", "SELECT sv, t, (sum(j) OVER (PARTITION BY sv ORDER BY t))::BIGINT AS segment FROM (SELECT sv, t, coalesce(abs(c - lag(c) OVER (PARTITION BY sv ORDER BY t)) > 150, false)::INTEGER AS j FROM ob)", _ORBIT)
def _(spark, sf):
    return interpolate.clock_segments(_orbits(spark, sf), jump=150.0).select("sv", (C.micros(F.col("epoch")) / 1e6).alias("t"), "segment")


@query("clock_interp", """SELECT event_id, round(CASE WHEN tt = t AND NOT alone THEN c WHEN tt > t AND s1 = seg THEN c + (tt - t) / (t1 - t) * (c1 - c) END, 8) + 0.0 AS clock FROM (SELECT e.event_id, e.t AS tt, k.* FROM tg e ASOF LEFT JOIN kn k ON e.sv = k.sv AND e.t >= k.t)""",
    _ORBIT + """, sg AS (SELECT *, sum(j) OVER (PARTITION BY sv ORDER BY t) AS seg FROM (SELECT sv, t, c, coalesce(abs(c - lag(c) OVER (PARTITION BY sv ORDER BY t)) > 150, false)::INTEGER AS j FROM ob)),
    kn AS (SELECT sv, t, c, seg, lead(t) OVER w AS t1, lead(c) OVER w AS c1, lead(seg) OVER w AS s1, NOT (coalesce(lag(seg) OVER w = seg, false) OR coalesce(lead(seg) OVER w = seg, false)) AS alone FROM sg WINDOW w AS (PARTITION BY sv ORDER BY t)),
    tg AS (SELECT event_id, user_id % 8 AS sv, floor(epoch_us(ts) / 1e6) AS t FROM events WHERE event_type = 'view')""")
def _(spark, sf):
    targets = A.table(spark, sf, "events").where("event_type = 'view'").select((F.col("user_id") % 8).alias("sv"), F.col("ts").alias("epoch"), "event_id")
    met = interpolate.clocks(_orbits(spark, sf), targets.select("sv", "epoch").distinct(), jump=150.0)
    return targets.join(met, ["sv", "epoch"]).select("event_id", (F.round("clock", 8) + 0.0).alias("clock"))


_RX = geometry.geodetic_to_ecef(LAT, LON, HEIGHT)
_P, _Q = math.radians(LAT), math.radians(LON)


@query("enu_spherical", f"""SELECT sv, t, {r('r', digits=2)}, {r('theta', digits=5)}, {r('phi', digits=5)} FROM (SELECT sv, t, CASE WHEN u >= 0 THEN d END AS r, CASE WHEN u >= 0 THEN acos(u / d) END AS theta, CASE WHEN u >= 0 THEN CASE WHEN atan2(e, n) < 0 THEN atan2(e, n) + 2 * pi() ELSE atan2(e, n) END END AS phi
    FROM (SELECT sv, t, sqrt(dx*dx + dy*dy + dz*dz) AS d, -{math.sin(_Q)!r} * dx + {math.cos(_Q)!r} * dy AS e, -{math.sin(_P) * math.cos(_Q)!r} * dx - {math.sin(_P) * math.sin(_Q)!r} * dy + {math.cos(_P)!r} * dz AS n,
    {math.cos(_P) * math.cos(_Q)!r} * dx + {math.cos(_P) * math.sin(_Q)!r} * dy + {math.sin(_P)!r} * dz AS u FROM (SELECT sv, t, x - {_RX[0]!r} AS dx, y - {_RX[1]!r} AS dy, z - {_RX[2]!r} AS dz FROM ob)))""", _ORBIT)
def _(spark, sf):
    o = _orbits(spark, sf).withColumns(geometry.direction(F.col("x"), F.col("y"), F.col("z"), _RX))
    return o.select("sv", (C.micros(F.col("epoch")) / 1e6).alias("t"), *[(F.round(c, d) + 0.0).alias(c) for c, d in (("r", 2), ("theta", 5), ("phi", 5))])


# --- audit --------------------------------------------------------------------

_CMP = """cm AS (SELECT c.snr AS a, s.snr AS b, c.snr - s.snr AS d FROM (SELECT * FROM o WHERE receiver = 'canopy_01') c JOIN (SELECT * FROM o WHERE receiver = 'reference_01') s USING (epoch, sid))"""
_STATS = f"""'snr' AS variable, count(d) AS n_compared, count(*) FILTER (b IS NULL AND a IS NOT NULL) AS a_only, count(*) FILTER (a IS NULL AND b IS NOT NULL) AS b_only, count(*) FILTER (a IS NULL AND b IS NULL) AS neither, count(*) FILTER (d <> 0) AS n_different,
    {r('max(abs(d))', 'max_abs')}, {r('sqrt(avg(d * d))', 'rmse')}, {r('avg(abs(d))', 'mae')}, {r('avg(d)', 'bias')}, {r('corr(a, b)', 'correlation')}, avg((a IS NULL)::INTEGER) AS missing_a, avg((b IS NULL)::INTEGER) AS missing_b, avg(((a IS NULL) = (b IS NULL))::INTEGER) AS missing_agreement,
    {r('quantile_cont(abs(d), 0.5)', 'p50')}, {r('quantile_cont(abs(d), 0.9)', 'p90')}, {r('quantile_cont(abs(d), 0.99)', 'p99')}"""


def _compared(spark, sf):
    return audit.compare(A.receiver(spark, sf, A.CANOPY), A.receiver(spark, sf, A.SKY), ["snr"])


@query("audit_compare", f"SELECT {_STATS} FROM cm", BASE + ", " + _CMP)
def _(spark, sf):
    return rounded(_compared(spark, sf))


@query("diff_report", f"SELECT {_STATS}, 40.0 AS budget, max(abs(d)) > 40 AS exceeds FROM cm", BASE + ", " + _CMP)
def _(spark, sf):
    return rounded(audit.budgets(_compared(spark, sf), {"snr": 40.0}))


@query("tolerance_verdict", f"SELECT 'snr' AS variable, {r('max(abs(d))', 'max_abs')}, 50.0 AS atol, count(d) > 0 AND max(abs(d)) <= 50 AND avg(abs(d)) <= 20 AS passed FROM cm", BASE + ", " + _CMP)
def _(spark, sf):
    out = audit.verdicts(_compared(spark, sf), "scientific", {"snr": (50.0, 20.0, 0.05)})
    return rounded(out.select("variable", "max_abs", "atol", "passed"))


@query("audit_alignment", "SELECT count(*) FILTER (c AND s) AS shared, count(*) FILTER (NOT s) AS dropped_a, count(*) FILTER (NOT c) AS dropped_b FROM (SELECT epoch, bool_or(receiver = 'canopy_01') AS c, bool_or(receiver = 'reference_01') AS s FROM o GROUP BY 1)", BASE)
def _(spark, sf):
    return audit.alignment(A.receiver(spark, sf, A.CANOPY), A.receiver(spark, sf, A.SKY), "epoch")


@query("wrap_azimuth", f"SELECT epoch, sid, {r('CASE WHEN d > 180 THEN d - 360 WHEN d <= -180 THEN d + 360 ELSE d END', 'diff', 4)} FROM (SELECT epoch, sid, degrees(phi) - degrees(3 * theta) AS d FROM vod)", BASE)
def _(spark, sf):
    d = C.wrapped_difference(F.degrees("phi"), F.degrees(3 * F.col("theta")))
    return rounded(A.depth(spark, sf).select("epoch", "sid", d.alias("diff")), 4)


@query("vod_decomposition", f"""SELECT count(*) AS n, {r('avg(ac)', 'mean_actual')}, {r('avg(pr)', 'mean_predicted')}, {r('avg(ac - pr)', 'mean_residual')}, {r('1 - var_pop(ac - pr) / var_pop(ac)', 'explained', 4)} FROM
    (SELECT va - vb AS ac, vb * (sin(radians(ea)) / sin(radians(eb)) - 1) AS pr FROM (SELECT 90 - degrees(theta) AS ea, 91 - degrees(theta) AS eb, vod AS va, vod * 1.01 AS vb FROM vod) WHERE ea > 5 AND eb > 5)""", BASE)
def _(spark, sf):
    e = 90 - F.degrees("theta")
    p = A.depth(spark, sf).select(e.alias("elev_a"), (e + 1).alias("elev_b"), F.col("vod").alias("vod_a"), (F.col("vod") * 1.01).alias("vod_b"))
    out = audit.depth_decomposition(p)
    return out.select("n", *[(F.round(c, 6) + 0.0).alias(c) for c in ("mean_actual", "mean_predicted", "mean_residual")], (F.round("explained", 4) + 0.0).alias("explained"))


# --- scalar functions -----------------------------------------------------------


@query("gps_week", "SELECT event_id, (date_diff('day', DATE '1980-01-06', ts::DATE) // 7)::INTEGER AS week, (date_diff('day', DATE '1980-01-06', ts::DATE) % 7)::INTEGER AS day FROM events")
def _(spark, sf):
    return A.table(spark, sf, "events").select("event_id", gnss.gps_week(F.col("ts")).alias("week"), gnss.gps_day_of_week(F.col("ts")).cast("int").alias("day"))


@query("yyyydoy", "SELECT event_id, year(ts)::VARCHAR || lpad(dayofyear(ts)::VARCHAR, 3, '0') AS yyyydoy, ts::DATE::VARCHAR AS day FROM events")
def _(spark, sf):
    e = A.table(spark, sf, "events").select("event_id", gnss.yyyydoy(F.col("ts")).alias("yyyydoy"))
    return e.withColumn("day", gnss.date_of_yyyydoy(F.col("yyyydoy")).cast("string"))


@query("sid_parse", "SELECT DISTINCT sid, split_part(sid, '|', 1) AS sv, sid[1] AS system, split_part(sid, '|', 2) AS band, split_part(sid, '|', 3) AS code, true AS valid FROM o", BASE)
def _(spark, sf):
    o = A.observations(spark, sf).select("sid").distinct()
    return o.select("sid", *[c.alias(n) for n, c in gnss.sid_parts(F.col("sid")).items()], gnss.valid_sid(F.col("sid")).alias("valid"))


@query("nmea_checksum", "SELECT event_id, upper(printf('%02x', list_reduce(list_transform(string_split('GP,' || event_type || ',' || user_id, ''), lambda c: ascii(c)), lambda a, c: xor(a, c)))) AS checksum FROM events")
def _(spark, sf):
    s = F.concat_ws(",", F.lit("GP"), "event_type", F.col("user_id").cast("string"))
    return A.table(spark, sf, "events").select("event_id", gnss.nmea_checksum(s).alias("checksum"))


@query("sbf_fields", "SELECT event_id, CASE WHEN user_id % 256 <> 255 THEN (user_id % 256) * 0.25 + CASE WHEN event_id % 20 IN (1, 2) THEN 0 ELSE 10 END END::DOUBLE AS cn0, CASE WHEN user_id % 16 >= 8 THEN user_id % 16 - 16 ELSE user_id % 16 END AS offset_, round(1602.0 + (user_id % 14 - 8) * 9 / 16.0, 6) AS freq FROM events")
def _(spark, sf):
    e = A.table(spark, sf, "events")
    u = F.col("user_id")
    return e.select("event_id", gnss.cn0(u % 256, F.col("event_id") % 20).alias("cn0"), gnss.signed_bits(u, 4).alias("offset_"), F.round(gnss.glonass_frequency(F.lit("G1"), u % 14), 6).alias("freq"))


@query("date_range_last", "SELECT max(ts) AS last_ts, min(ts) AS first_ts, count(DISTINCT ts::DATE) AS days FROM events")
def _(spark, sf):
    return A.table(spark, sf, "events").agg(F.max("ts").alias("last_ts"), F.min("ts").alias("first_ts"), F.countDistinct(F.to_date("ts")).alias("days"))


@query("sampling_interval", "SELECT user_id, median(g) AS spacing FROM (SELECT user_id, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts)) / 1e6 AS g FROM events) WHERE g IS NOT NULL GROUP BY 1")
def _(spark, sf):
    e = A.table(spark, sf, "events").select("user_id", C.micros(F.col("ts")).alias("t"))
    gaps = e.selectExpr("user_id", "(t - lag(t) over (partition by user_id order by t)) / 1e6D as g").where("g is not null")
    return gaps.groupBy("user_id").agg(F.median("g").alias("spacing"))


# --- vectors ----------------------------------------------------------------

_VEC = "SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z, label FROM embeddings"


@query("nn_join", """SELECT vec_id, cell_id AS nearest FROM (SELECT v.vec_id, g.cell_id, row_number() OVER (PARTITION BY v.vec_id ORDER BY round(pow(sx - sin(g.theta) * cos(g.phi), 2) + pow(sy - sin(g.theta) * sin(g.phi), 2) + pow(sz - cos(g.theta), 2), 12), g.cell_id) AS k
    FROM (SELECT vec_id, sin(theta) * cos(phi) AS sx, sin(theta) * sin(phi) AS sy, cos(theta) AS sz FROM (SELECT vec_id, CASE WHEN atan2(y, x) < 0 THEN atan2(y, x) + 2 * pi() ELSE atan2(y, x) END AS phi, acos(abs(z) / sqrt(x*x + y*y + z*z)) AS theta FROM t)) v CROSS JOIN grid g) WHERE k = 1""", GRID + f", t AS ({_VEC})")
def _(spark, sf):
    e = [F.col("embedding")[i].cast("double") for i in range(3)]
    v = A.table(spark, sf, "embeddings").select("vec_id", F.pmod(F.atan2(e[1], e[0]), F.lit(C.TWO_PI)).alias("phi"), F.acos(F.abs(e[2]) / F.sqrt(e[0] * e[0] + e[1] * e[1] + e[2] * e[2])).alias("theta"))
    return grids.assign_cells(v, A.grid(spark), math.radians(1.2 * A.GRID_DEGREES)).select("vec_id", F.col("cell_id").alias("nearest"))
