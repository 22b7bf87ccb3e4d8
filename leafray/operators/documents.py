"""Metadata documents: semi-structured columns, merged by dotted path, checked by rules kept as a table, listed as an inventory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Standard, rule, the paths that it speaks of, and how many of them must be there.
RULES = [
    *[("datacite", p, [p], 1) for p in ("identity.id", "identity.title", "creator.name", "creator.institution", "temporal.created", "identity.store_type", "publisher.name")],
    *[("acdd", p, [p], 1) for p in ("identity.title", "identity.id", "identity.conventions", "creator.name", "creator.email", "creator.institution", "temporal.created")],
    *[("acdd", p, [p], 1) for p in ("identity.keywords", "identity.description", "spatial.geospatial_lat", "spatial.geospatial_lon")],
    *[("stac", p, [p], 1) for p in ("identity.id", "identity.title", "identity.description", "spatial.bbox", "spatial.extent_temporal_interval", "publisher.license")],
    ("fair", "F1", ["identity.id"], 1),
    ("fair", "F1 persistent", ["identity.persistent_identifier"], 1),
    ("fair", "F2", ["identity.title", "identity.description", "identity.keywords", "creator.name", "creator.institution", "temporal.collected_start", "spatial.geospatial_lat"], 5),
    ("fair", "F4", ["spatial.bbox"], 1),
    ("fair", "A1", ["references.access_url"], 1),
    ("fair", "I2", ["identity.conventions"], 1),
    ("fair", "I3", ["references.related_stores", "references.publications"], 1),
    ("fair", "R1.1", ["publisher.license"], 1),
    ("fair", "R1.2 software", ["processing.software"], 1),
    ("fair", "R1.2 lock", ["environment.uv_lock_hash"], 1),
]
# Columns of the inventory, their paths and types.
INVENTORY = {
    "id": ("identity.id", "string"),
    "title": ("identity.title", "string"),
    "store_type": ("identity.store_type", "string"),
    "source_format": ("identity.source_format", "string"),
    "site": ("spatial.site.name", "string"),
    "creator": ("creator.name", "string"),
    "institution": ("creator.institution", "string"),
    "license": ("publisher.license", "string"),
    "created": ("temporal.created", "string"),
    "updated": ("temporal.updated", "string"),
    "time_start": ("temporal.collected_start", "string"),
    "time_end": ("temporal.collected_end", "string"),
    "lat": ("spatial.geospatial_lat", "double"),
    "lon": ("spatial.geospatial_lon", "double"),
    "total_epochs": ("summaries.total_epochs", "long"),
    "total_sids": ("summaries.total_sids", "long"),
    "file_count": ("summaries.file_count", "long"),
    "store_size_mb": ("summaries.store_size_mb", "double"),
}
#: Values that count as empty.
EMPTY = ("null", '""', "[]", "{}")


def leaves(docs: DataFrame, document: str = "document", depth: int = 8) -> DataFrame:
    """A row per value of each JSON text: the other columns, path (dotted) and value (as JSON).

    Objects are opened down to ``depth`` levels; what lies deeper stays whole,
    and so do lists and empty objects. Texts that aren't JSON objects give nothing.
    """
    keep = [c for c in docs.columns if c != document]
    opened = lambda v: F.try_variant_get(v, "$", "map<string,variant>")
    level = docs.select(*keep, F.lit("").alias("path"), F.try_parse_json(F.col(document)).alias("value"))
    out = None
    for i in range(depth):
        inner = level.select(*keep, F.col("path").alias("above"), F.explode(opened(F.col("value"))).alias("name", "value"))
        inner = inner.select(*keep, F.when(F.col("above") == "", F.col("name")).otherwise(F.concat_ws(".", "above", "name")).alias("path"), "value")
        more = F.coalesce(F.size(opened(F.col("value"))) > 0, F.lit(False)) if i + 1 < depth else F.lit(False)
        done = inner.where(~more).withColumn("value", F.coalesce(F.to_json("value"), F.lit("null")))
        out = done if out is None else out.unionByName(done)
        level = inner.where(more)
    return out


def merged(docs: DataFrame, key: str, at: str, document: str = "document", depth: int = 8) -> DataFrame:
    """One document per ``key``: key and ``fields``, a map from dotted path to JSON value, the latest by ``at`` (unique within a key) of each path.

    An update of ``a`` takes the place of all ``a.b`` said before, and one of ``a.b`` that of a value of ``a``.
    """
    each = leaves(docs.select(key, at, document), document, depth)
    latest = each.groupBy(key, "path").agg(F.max_by("value", at).alias("value"), F.max(at).alias("at_"))
    parts = F.split("path", r"\.")
    above = F.explode(F.transform(F.filter(F.sequence(F.lit(1), F.size(parts)), lambda n: n < F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), ".")))
    below = latest.select(F.col(key).alias("key_"), F.col("path").alias("inner_"), F.col("at_").alias("inner_at_"), above.alias("outer_"))
    met = latest.join(below, (F.col(key) == F.col("key_")) & (F.col("path") == F.col("outer_")))
    gone = met.select("key_", F.when(F.col("at_") > F.col("inner_at_"), F.col("inner_")).otherwise(F.col("path")).alias("gone_")).distinct()
    kept = latest.join(gone, (F.col(key) == F.col("key_")) & (F.col("path") == F.col("gone_")), "left_anti")
    return kept.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("path", "value")))).alias("fields"))


def present(fields: Column, path: Column) -> Column:
    """Whether a path, or anything below it, has a value that isn't empty."""
    own = F.coalesce(~fields[path].isin(*EMPTY), F.lit(False))
    return own | F.exists(F.map_entries(fields), lambda e: e.key.startswith(F.concat(path, F.lit("."))) & ~e.value.isin(*EMPTY))


def issues(docs: DataFrame, rules: list[tuple] = RULES, fields: str = "fields") -> DataFrame:
    """``docs`` with ``issues``, an array of (standard, rule) of the rules that a document doesn't meet; all rules in one pass, without a join."""
    table = F.array(*[F.struct(F.lit(s).alias("standard"), F.lit(r).alias("rule"), F.array(*map(F.lit, p)).alias("paths"), F.lit(n).alias("need")) for s, r, p, n in rules])
    broken = F.filter(table, lambda r: F.size(F.filter(r["paths"], lambda p: present(F.col(fields), p))) < r["need"])
    return docs.withColumn("issues", F.transform(broken, lambda r: F.struct(r["standard"].alias("standard"), r["rule"].alias("rule"))))


def inventory(docs: DataFrame, key: str, fields: str = "fields") -> DataFrame:
    """One typed row per document; what is absent or of another type is null."""
    plain = lambda path: F.try_variant_get(F.try_parse_json(F.col(fields)[path]), "$", "string")
    return docs.select(key, *[plain(path).try_cast(kind).alias(name) for name, (path, kind) in INVENTORY.items()])
