"""Documents merged by dotted path, and rules of presence."""

import json
import random

from leafray.operators import documents


def merge(updates):
    """Plain merging: an update of a place takes away what lies below it, and values above it."""
    flat = {}

    def walk(prefix, value):
        if isinstance(value, dict) and value:
            for k, v in value.items():
                yield from walk([*prefix, k], v)
        else:
            yield ".".join(prefix), value

    for u in updates:
        for path, value in walk([], u):
            for old in list(flat):
                if old.startswith(path + ".") or path.startswith(old + "."):
                    del flat[old]
            flat[path] = value
    return flat


def test_merge_against_plain(spark):
    r = random.Random(6)

    def tree(depth):
        return {k: tree(depth - 1) if depth and r.random() < 0.5 else r.choice([1, "x", None, [1, 2], {}, True, 2.5]) for k in r.sample("abcd", r.randint(1, 3))}

    data = {i: [tree(3) for _ in range(r.randint(1, 5))] for i in range(40)}
    rows = [(i, n, json.dumps(d)) for i, docs in data.items() for n, d in enumerate(docs)]
    rows += [(100, 1, None), (101, 1, "no json"), (102, 1, "[1]"), (103, 1, "{}")]
    out = documents.merged(spark.createDataFrame(rows, "id long, at long, document string"), "id", "at")
    got = {x.id: {p: json.loads(v) for p, v in x.fields.items()} for x in out.collect()}
    # updates within one document agree, so only documents of one order count
    assert got == {i: merge(docs) for i, docs in data.items()}


def test_rules_and_inventory(spark):
    full = {"identity": {"id": "i", "title": "t", "store_type": "s", "conventions": ["ACDD"], "keywords": ["k"], "description": "d", "persistent_identifier": "doi"}}
    full |= {"creator": {"name": "n", "institution": "i", "email": "e"}, "publisher": {"name": "p", "license": "l"}, "temporal": {"created": "2024", "collected_start": "2023"}}
    full |= {"spatial": {"bbox": [1, 2, 3, 4], "extent_temporal_interval": ["a", "b"], "geospatial_lat": 47.5, "geospatial_lon": "east", "site": {"name": "hill"}}}
    full |= {"references": {"access_url": "u", "publications": ["p"]}, "processing": {"software": {"leafray": "1"}}, "environment": {"uv_lock_hash": "h"}, "summaries": {"total_epochs": 12}}
    less = {k: dict(v) for k, v in full.items()}
    less["identity"] |= {"title": "", "keywords": []}
    less["references"] = {"access_url": "u", "related_stores": [], "publications": []}
    rows = [("full", 1, json.dumps(full)), ("less", 1, json.dumps(less)), ("none", 1, json.dumps({"x": 1}))]
    docs = documents.merged(spark.createDataFrame(rows, "id string, at long, document string"), "id", "at")
    found = {x.id: {tuple(i) for i in x.issues} for x in documents.issues(docs).collect()}
    assert found["full"] == set()
    assert found["less"] == {("datacite", "identity.title"), ("acdd", "identity.title"), ("acdd", "identity.keywords"), ("stac", "identity.title"), ("fair", "I3")}
    assert len(found["none"]) == len({(s, r) for s, r, *_ in documents.RULES})
    listed = {x.title: x for x in documents.inventory(docs.withColumnRenamed("id", "store"), "store").collect()}
    t = listed["t"]
    assert (t.site, t.lat, t.lon, t.total_epochs, t.license, t.updated) == ("hill", 47.5, None, 12, "l", None)
