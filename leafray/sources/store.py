"""Versioned Parquet groups: a manifest row per version, an ingest ledger, guarded appends."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafray.operators.joins import ledger_verdicts

MANIFEST = "grp string, version string, action string, written_at timestamp, message string, parts array<string>"
LEDGER = "grp string, file_hash string, start timestamp_ntz, end timestamp_ntz, version string, action string, written_at timestamp"


class Store:
    """Groups below one folder of any file system that Spark writes to.

    Every write adds a folder of Parquet files, one folder a day, and then one
    manifest row that lists the folders of the new version; readers see a
    version, and its ledger rows, only once its manifest row is there, so a job
    that dies leaves the last version whole. A group has one writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _files(self, name: str):
        """The file system, and a path below the root in it."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _table(self, name: str, schema: str) -> DataFrame:
        files, path = self._files(name)
        if not files.exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def history(self, group: str | None = None) -> DataFrame:
        m = self._table("manifest", MANIFEST)
        return (m if group is None else m.where(F.col("grp") == group)).orderBy(F.desc("written_at"))

    def groups(self) -> DataFrame:
        return self._table("manifest", MANIFEST).select("grp").distinct()

    def ledger(self, group: str) -> DataFrame:
        """Files of committed versions."""
        committed = self._table("manifest", MANIFEST).where(F.col("grp") == group).select("version")
        return self._table("ledger", LEDGER).where(F.col("grp") == group).join(committed, "version", "left_semi").select(*[c.split()[0] for c in LEDGER.split(", ")])

    def _parts(self, group: str, version: str | None = None) -> list[str]:
        m = self._table("manifest", MANIFEST).where(F.col("grp") == group)
        row = (m if version is None else m.where(F.col("version") == version)).orderBy(F.desc("written_at")).limit(1).collect()
        return list(row[0].parts) if row else []

    def read(self, group: str, version: str | None = None, start=None, end=None, days: tuple | None = None) -> DataFrame:
        """A version's rows, of the closed time range or days if given; other days aren't read."""
        parts = self._parts(group, version)
        if not parts:
            raise KeyError(f"no group {group!r}")
        df = self.spark.read.option("basePath", f"{self.root}/data").parquet(*[f"{self.root}/data/{p}" for p in parts]).drop("part")
        if days is not None:
            df = df.where(F.col("date").between(*days))
        if start is not None:
            df = df.where((F.col("date") >= F.to_date(F.lit(start))) & (F.col("epoch") >= F.lit(start)))
        if end is not None:
            df = df.where((F.col("date") <= F.to_date(F.lit(end))) & (F.col("epoch") <= F.lit(end)))
        return df.drop("date")

    def _commit(self, group: str, df: DataFrame, kept: list[str], action: str, message: str, version: str | None = None) -> str:
        version = version or uuid.uuid4().hex[:12]
        out = df.withColumn("date", F.to_date("epoch"))
        # a day's rows come together, so each task writes few files
        out.repartition("date", F.pmod(F.xxhash64("sid"), F.lit(8))).sortWithinPartitions("date", "sid", "epoch").write.partitionBy("date").parquet(f"{self.root}/data/part={version}")
        row = self.spark.range(1).select(F.lit(group).alias("grp"), F.lit(version).alias("version"), F.lit(action).alias("action"), F.current_timestamp().alias("written_at"), F.lit(message).alias("message"), F.array(*[F.lit(p) for p in [*kept, f"part={version}"]]).alias("parts"))
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/manifest")
        return version

    def write(self, group: str, df: DataFrame, message: str = "") -> str:
        return self._commit(group, df, [], "write", message)

    def append(self, group: str, df: DataFrame, message: str = "", version: str | None = None) -> str:
        return self._commit(group, df, self._parts(group), "append", message, version)

    def overwrite_interval(self, group: str, df: DataFrame, start: dt.datetime, end: dt.datetime, message: str = "") -> str:
        """The group without epochs of the closed interval, and ``df``; only the days of the interval are written again."""
        first, last = f"date={start:%Y-%m-%d}", f"date={end:%Y-%m-%d}"
        kept = []
        for part in self._parts(group):
            if "/" in part:
                days = [part.split("/")[1]]
            else:
                files, path = self._files(f"data/{part}")
                days = [d.getPath().getName() for d in files.listStatus(path) if d.isDirectory()]
            kept += [f"{part.split('/')[0]}/{d}" for d in days if not first <= d <= last]
        day = lambda t: F.lit(t).cast("date")
        touched = self.read(group, days=(day(start), day(end))).where(~F.col("epoch").between(F.lit(start), F.lit(end)))
        return self._commit(group, touched.unionByName(df, allowMissingColumns=True), kept, "overwrite", message)

    def freeze(self, group: str, path: str, version: str | None = None) -> DataFrame:
        """A version's rows as plain Parquet at ``path``, with the version beside them, to compare later states with."""
        parts = self.history(group) if version is None else self.history(group).where(F.col("version") == version)
        named = F.broadcast(parts.select(F.col("version").alias("frozen_version")).limit(1))
        self.read(group, version).join(named).write.parquet(path)
        return self.spark.read.parquet(path)

    def inventory(self) -> DataFrame:
        """Per group: versions, when it was first and last written, files in its ledger."""
        m = self._table("manifest", MANIFEST)
        files = self._table("ledger", LEDGER).join(m.select("version"), "version", "left_semi").groupBy("grp").agg(F.count(F.lit(1)).alias("files"))
        known = m.groupBy("grp").agg(F.count(F.lit(1)).alias("versions"), F.min("written_at").alias("first_written"), F.max("written_at").alias("last_written"))
        return known.join(files, "grp", "left").withColumn("files", F.coalesce("files", F.lit(0)))

    def ingest(self, group: str, obs: DataFrame) -> DataFrame:
        """Append the files of ``obs`` (with file_hash) that the ledger has neither by hash nor by time; returns every file's verdict."""
        version = uuid.uuid4().hex[:12]
        files = obs.groupBy("file_hash").agg(F.min("epoch").alias("start"), F.max("epoch").alias("end"))
        ledger_verdicts(files, self.ledger(group)).write.parquet(f"{self.root}/verdicts/{version}")
        verdicts = self.spark.read.parquet(f"{self.root}/verdicts/{version}")
        fresh = verdicts.where("reason is null")
        if fresh.isEmpty():
            return verdicts
        # the ledger's rows come first and count from the manifest's row on, so that neither is ever without the other
        rows = fresh.select(F.lit(group).alias("grp"), "file_hash", "start", "end", F.lit(version).alias("version"), F.lit("append").alias("action"), F.current_timestamp().alias("written_at"))
        rows.write.mode("append").parquet(f"{self.root}/ledger")
        self.append(group, obs.join(fresh.select("file_hash"), "file_hash", "left_semi"), "ingest", version)
        return verdicts

    def compare_versions(self, group: str, a: str, b: str) -> dict[str, int]:
        x, y = self.read(group, a), self.read(group, b)
        return {"added": y.exceptAll(x).count(), "removed": x.exceptAll(y).count()}
