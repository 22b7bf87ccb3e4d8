"""Views that give the driver's tables the shape of receiver observations, and the same as SQL."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafray.functions.columns import finite_columns, micros
from leafray.operators import grids, vod

GRID_DEGREES = 10.0
CANOPY, SKY = "canopy_01", "reference_01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as hourly means per receiver and signal: receiver, epoch, sid, phi, theta, snr."""
    e = finite_columns(table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value"), "value").where("value is not null")
    hour = F.floor(micros(F.col("ts")) / 3_600_000_000).cast("long")
    prn = F.col("user_id") % 8 + 1
    system = F.when(F.col("user_id") % 3 == 0, "G").when(F.col("user_id") % 3 == 1, "E").otherwise("R")
    signal = F.when(system == "G", "|L1|C").when(system == "E", "|E1|C").otherwise("|G1|C")
    obs = e.select(
        F.when(F.col("event_id") % 2 == 0, CANOPY).otherwise(SKY).alias("receiver"),
        F.timestamp_micros(hour * 3_600_000_000).cast("timestamp_ntz").alias("epoch"),
        F.concat(system, F.lpad(prn.cast("string"), 2, "0"), signal).alias("sid"),
        prn.alias("prn"),
        hour.alias("k"),
        (20 + F.col("value") - 30 * F.floor(F.col("value") / 30)).alias("snr"),
    )
    angles = obs.withColumn("phi", F.radians((F.col("prn") * 37 + F.col("k") * 5) % 360)).withColumn("theta", F.radians((F.col("prn") * 11 + F.col("k") * 3) % 90))
    return angles.groupBy("receiver", "epoch", "sid", "phi", "theta").agg(F.avg("snr").alias("snr"))


def receiver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return observations(spark, sf_dir).where(F.col("receiver") == name).drop("receiver")


def depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vod.tau_omega(receiver(spark, sf_dir, CANOPY), receiver(spark, sf_dir, SKY))


def grid(spark: SparkSession) -> DataFrame:
    return grids.equal_area(spark, GRID_DEGREES)


def gridded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth with the nearest cell of the 10 degree grid; no direction is farther than 1.2 steps from a centre."""
    return grids.assign_cells(depth(spark, sf_dir), grid(spark), math.radians(1.2 * GRID_DEGREES))


SQL = """
obs AS (SELECT CASE WHEN event_id % 2 = 0 THEN 'canopy_01' ELSE 'reference_01' END AS receiver,
    time_bucket(INTERVAL '1 hour', ts) AS epoch,
    CASE user_id % 3 WHEN 0 THEN 'G' WHEN 1 THEN 'E' ELSE 'R' END || lpad(CAST(1 + user_id % 8 AS VARCHAR), 2, '0')
      || CASE user_id % 3 WHEN 0 THEN '|L1|C' WHEN 1 THEN '|E1|C' ELSE '|G1|C' END AS sid,
    1 + user_id % 8 AS prn, CAST(floor(epoch_us(ts) / 3600000000.0) AS BIGINT) AS k,
    20 + value - 30 * floor(value / 30) AS snr0 FROM events WHERE value IS NOT NULL),
o AS (SELECT receiver, epoch, sid, radians((prn * 37 + k * 5) % 360) AS phi, radians((prn * 11 + k * 3) % 90) AS theta, avg(snr0) AS snr FROM obs GROUP BY ALL),
vod AS (SELECT c.epoch, c.sid, c.phi, c.theta, c.snr - r.snr AS delta_snr, -ln(pow(10, (c.snr - r.snr) / 10)) * cos(c.theta) AS vod
    FROM o c JOIN o r ON c.epoch = r.epoch AND c.sid = r.sid WHERE c.receiver = 'canopy_01' AND r.receiver = 'reference_01')"""

SQL_GRID = """
ring AS (SELECT i, radians(5) + i * radians(10) AS theta_min, radians(15) + i * radians(10) AS theta_max,
    CAST(round_even((cos(radians(5) + i * radians(10)) - cos(radians(15) + i * radians(10))) / (1 - cos(radians(5))), 0) AS INTEGER) AS n
    FROM generate_series(0, 7) g(i)),
ring1 AS (SELECT *, coalesce(sum(n) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM ring),
grid AS (SELECT 0::BIGINT AS cell_id, 0.0::DOUBLE AS phi, 0.0::DOUBLE AS theta, 0.0::DOUBLE AS phi_min, 2 * pi() AS phi_max, 0.0::DOUBLE AS theta_min, radians(5) AS theta_max
    UNION ALL SELECT (1 + before + j)::BIGINT, (j + 0.5) * 2 * pi() / n, (theta_min + theta_max) / 2, j * 2 * pi() / n, (j + 1) * 2 * pi() / n, theta_min, theta_max
    FROM ring1, LATERAL (SELECT unnest(range(n)) AS j)),
dir AS (SELECT DISTINCT phi, theta FROM vod),
near AS (SELECT phi, theta, cell_id FROM (SELECT d.phi, d.theta, g.cell_id, row_number() OVER (PARTITION BY d.phi, d.theta ORDER BY
    round(pow(sin(d.theta) * cos(d.phi) - sin(g.theta) * cos(g.phi), 2) + pow(sin(d.theta) * sin(d.phi) - sin(g.theta) * sin(g.phi), 2)
      + pow(cos(d.theta) - cos(g.theta), 2), 12), g.cell_id) AS k FROM dir d CROSS JOIN grid g) WHERE k = 1),
vg AS (SELECT v.*, n.cell_id FROM vod v JOIN near n USING (phi, theta))"""

SQL_PERCELL = """
pc AS (SELECT cell_id, time_bucket(INTERVAL '6 hours', epoch) AS time, avg(vod) AS value, count(vod) AS count, count(vod)::DOUBLE AS weight
    FROM vg WHERE vod IS NOT NULL GROUP BY ALL)"""
