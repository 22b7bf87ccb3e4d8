"""Queries of grid neighbours, stored masks, period tables and metadata documents."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from leafray.operators import bitmaps, documents, filters, periods, topology
from leafray.plans import adapters as A
from leafray.plans import registry as R
from leafray.plans.registry import query, r, rounded
from leafray.sources.scratch import shared_folder

_BESIDE = """, beside AS (SELECT a.cell_id, b.cell_id AS neighbor_id FROM grid a JOIN grid b ON a.cell_id <> b.cell_id AND (
    (abs(a.theta_min - b.theta_min) < 1e-9 AND (abs(a.phi_max - b.phi_min) < 1e-9 OR abs(a.phi_min - b.phi_max) < 1e-9 OR (a.phi_min < 1e-9 AND b.phi_max > 2 * pi() - 1e-9) OR (b.phi_min < 1e-9 AND a.phi_max > 2 * pi() - 1e-9)))
    OR ((abs(a.theta_max - b.theta_min) < 1e-9 OR abs(a.theta_min - b.theta_max) < 1e-9) AND a.phi_min < b.phi_max - 1e-9 AND b.phi_min < a.phi_max - 1e-9)))"""
_CELLS = "(SELECT cell_id, sum(vod) AS s, count(vod) AS n FROM vg GROUP BY 1)"


@query(
    "neighbor_means",
    f"""SELECT c.cell_id, {r('c.s / c.n', 'own')}, {r('sum(o.s) / sum(o.n)', 'around')}, count(*) AS neighbors, count(o.cell_id) AS observed
    FROM {_CELLS} c JOIN beside USING (cell_id) LEFT JOIN {_CELLS} o ON o.cell_id = beside.neighbor_id GROUP BY c.cell_id, c.s, c.n""",
    R.GRID + _BESIDE,
)
def _(spark, sf):
    """Mean depth of each observed cell and of all observations in the cells beside it."""
    cells = A.gridded(spark, sf).groupBy("cell_id").agg(F.sum("vod").alias("s"), F.count("vod").alias("n"))
    other = cells.select(F.col("cell_id").alias("neighbor_id"), F.col("s").alias("s_o"), F.col("n").alias("n_o"))
    met = cells.join(topology.neighbors(A.grid(spark)), "cell_id").join(other, "neighbor_id", "left")
    out = met.groupBy("cell_id", "s", "n").agg(F.sum("s_o").alias("s_o"), F.sum("n_o").alias("n_o"), F.count(F.lit(1)).alias("neighbors"), F.count("n_o").alias("observed"))
    return rounded(out.select("cell_id", (F.col("s") / F.col("n")).alias("own"), (F.col("s_o") / F.col("n_o")).alias("around"), "neighbors", "observed"))


@query(
    "stored_mask",
    f"""SELECT sid, epoch, {r('vod')}, coalesce(abs(vod - m) <= 1.5 * s, false) AS kept FROM vod, (SELECT avg(vod) AS m, stddev_pop(vod) AS s FROM vod)""",
    R.BASE,
)
def _(spark, sf):
    """A filter's mask, kept as bitmaps of hours in the shared folder and applied from there."""
    depth = A.depth(spark, sf)
    flagged = filters.apply(depth, filters.ZScore(1.5))
    path = shared_folder(spark, "masks")
    bitmaps.pack(flagged, F.col("mask_zscore"), 3600, "kept").write.parquet(path)
    return rounded(bitmaps.apply(depth, spark.read.parquet(path), "kept", 3600).select("sid", "epoch", "vod", "kept"))


#: Three kinds of periods of each customer: from order to order, forty days from a finished order on, and open ends.
PERIODS = """
po AS (SELECT o_custkey AS cust, o_orderdate::DATE AS d, min(o_orderpriority) AS priority, max(o_totalprice) AS price, bool_or(o_orderstatus = 'F') AS finished FROM orders GROUP BY ALL),
pa AS (SELECT cust, d AS a, lead(d) OVER (PARTITION BY cust ORDER BY d) AS b, priority AS v FROM po),
pb AS (SELECT cust, d AS a, d + 40 AS b, price AS v FROM po WHERE finished),
pc AS (SELECT cust, min(d) AS a, NULL::DATE AS b, count(*) AS v FROM po WHERE price > 200000 GROUP BY 1),
at_ AS (SELECT cust, a AS t FROM pa UNION SELECT cust, b FROM pa UNION SELECT cust, a FROM pb UNION SELECT cust, b FROM pb UNION SELECT cust, a FROM pc),
seg AS (SELECT cust, t AS a, lead(t) OVER (PARTITION BY cust ORDER BY t) AS b FROM at_ WHERE t IS NOT NULL),
last_ AS (SELECT seg.cust, seg.a, seg.b, x.a AS xa, x.b AS xb, x.v AS xv, y.a AS ya, y.b AS yb, y.v AS yv, z.a AS za, z.b AS zb, z.v AS zv
    FROM seg ASOF LEFT JOIN pa x ON x.cust = seg.cust AND x.a <= seg.a ASOF LEFT JOIN pb y ON y.cust = seg.cust AND y.a <= seg.a ASOF LEFT JOIN pc z ON z.cust = seg.cust AND z.a <= seg.a)"""


#: Orders that a task takes where they are dealt by customer.
PART = 100_000


def order_parts(spark, sf) -> int:
    return 1 + A.table(spark, sf, "orders").count() // PART


def order_periods(spark, sf):
    """The three tables, dealt by customer into as many partitions as the number of orders asks for."""
    o = A.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("cust"), F.col("o_orderdate").cast("date").alias("start"))
    o = o.agg(F.min("o_orderpriority").alias("priority"), F.max("o_totalprice").alias("price"), F.bool_or(F.col("o_orderstatus") == "F").alias("finished"))
    o = o.repartition(order_parts(spark, sf), "cust")
    turns = o.select("cust", "start", F.lead("start").over(Window.partitionBy("cust").orderBy("start")).alias("end"), "priority")
    stays = o.where("finished").select("cust", "start", F.date_add("start", 40).alias("end"), "price")
    open_ = o.where("price > 200000").groupBy("cust").agg(F.min("start").alias("start"), F.count(F.lit(1)).alias("orders")).withColumn("end", F.lit(None).cast("date"))
    return turns, stays, open_


@query(
    "period_timeline",
    """SELECT cust, a AS start, b AS "end", CASE WHEN x THEN xv END AS priority, CASE WHEN y THEN yv END AS price, CASE WHEN z THEN zv END AS orders
    FROM (SELECT *, xa IS NOT NULL AND (xb IS NULL OR xb > a) AS x, ya IS NOT NULL AND (yb IS NULL OR yb > a) AS y, za IS NOT NULL AS z FROM last_) WHERE x OR y OR z""",
    PERIODS,
)
def _(spark, sf):
    """Three period tables with gaps, overlaps and open ends, cut at the union of their ends."""
    turns, stays, open_ = order_periods(spark, sf)
    return periods.timeline({"turns": turns, "stays": stays, "open": open_}, "cust")


#: Events as updates of their user's document; what an event says depends on its kind.
_UPDATES = """
up AS (SELECT user_id, epoch_us(ts)::HUGEINT * 1000000000 + event_id AS at_, event_type AS t, event_id AS e, (props->>'k')::INTEGER AS k FROM events),
doc AS (SELECT user_id, arg_max(t, at_) FILTER (t IN ('view', 'click')) AS title, arg_max(k, at_) AS k, max(at_) FILTER (t = 'purchase') AS bought,
  arg_max(e % 90, at_) FILTER (t = 'purchase') AS lat, nullif(arg_max(CASE WHEN e % 2 = 0 THEN 'CC-BY-4.0' ELSE '' END, at_) FILTER (t = 'error'), '') AS license,
  arg_max(e % 3, at_) FILTER (t NOT IN ('view', 'click', 'purchase', 'error')) AS shape, count(*) AS n FROM up GROUP BY 1)"""


def _documents(spark, sf):
    e = A.table(spark, sf, "events")
    at = F.struct("ts", "event_id")
    kind, n = F.col("event_type"), F.col("event_id")
    said = (
        F.when(kind.isin("view", "click"), F.format_string('"identity": {"title": "%s"}', kind))
        .when(kind == "purchase", F.format_string('"spatial": {"geospatial_lat": %d}', n % 90))
        .when(kind == "error", F.when(n % 2 == 0, F.lit('"publisher": {"license": "CC-BY-4.0"}')).otherwise(F.lit('"publisher": {"license": null}')))
        # a value, an object or an empty list in the same place
        .otherwise(F.when(n % 3 == 0, F.lit('"references": "none"')).when(n % 3 == 1, F.lit('"references": {"access_url": "x"}')).otherwise(F.lit('"references": {"access_url": ""}')))
    )
    docs = e.select("user_id", at.alias("at"), F.format_string('{"props": %s, %s}', F.col("props"), said).alias("document"))
    return documents.merged(docs, "user_id", "at")


@query("document_merge", "SELECT user_id, title, k, lat::DOUBLE AS lat, license, CASE WHEN shape = 0 THEN 'none' END AS reference, CASE shape WHEN 1 THEN 'x' WHEN 2 THEN '' END AS access_url FROM doc", _UPDATES)
def _(spark, sf):
    """Each user's document, merged from all updates by dotted path; a value replaces an object, and an object a value."""
    d = _documents(spark, sf)
    own = lambda path: F.try_variant_get(F.try_parse_json(F.col("fields")[path]), "$", "string")
    seen = documents.inventory(d, "user_id").select("user_id", "title", "lat", "license")
    other = d.select(F.col("user_id").alias("u"), own("props.k").cast("int").alias("k"), own("references").alias("reference"), own("references.access_url").alias("access_url"))
    return seen.join(other, F.col("user_id") == F.col("u")).drop("u")


@query(
    "document_issues",
    """SELECT user_id, 7 - (title IS NOT NULL)::INTEGER AS datacite, 11 - (title IS NOT NULL)::INTEGER - (lat IS NOT NULL)::INTEGER AS acdd,
    6 - (title IS NOT NULL)::INTEGER - (license IS NOT NULL)::INTEGER AS stac, 10 - (license IS NOT NULL)::INTEGER - coalesce(shape = 1, false)::INTEGER AS fair FROM doc""",
    _UPDATES,
)
def _(spark, sf):
    """Rules of four standards that each user's document doesn't meet."""
    broken = documents.issues(_documents(spark, sf))
    of = lambda s: F.size(F.filter("issues", lambda i: i["standard"] == s)).alias(s)
    return broken.select("user_id", *[of(s) for s in ("datacite", "acdd", "stac", "fair")])
