"""Exact dedup against a plain grouping."""

import re

from pyspark.sql import functions as F

from leafray.llm import exact_dedup

DATA = [(5, "a  b"), (3, "a b"), (9, "a\tb"), (4, "a c"), (1, None), (2, ""), (7, "a\u00a0b"), (None, "a c"), (8, "x"), (8, "x"), (8, "y" * 100000), (6, " a b")]


def table(spark, data=DATA):
    return spark.createDataFrame([(i, t, "s", 0) for i, t in data], "doc_id long, text string, digest string, n int")


def expected(data):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for i, t in data:
        groups.setdefault(norm(t), []).append(i)
    first = {k: min((i for i in v if i is not None), default=None) for k, v in groups.items()}
    return sorted(((i, first[norm(t)], len(groups[norm(t)])) for i, t in data), key=str)


def check(spark, **how):
    got = exact_dedup.copies(spark, table(spark), **how).collect()
    assert sorted(((x.doc_id, x.keep_id, x.group_size) for x in got), key=str) == expected(DATA)
    assert sum(x.kept for x in got) == len({x[1:] for x in expected(DATA)} | {0}) - 1
    assert all(x.doc_id == x.keep_id for x in got if x.kept)


def test_groups(spark):
    check(spark)


def test_colliding_digest_is_caught_by_the_byte_check(spark):
    check(spark, digest=lambda c: F.unhex(F.lpad(F.hex(F.length(c) % 3), 2, "0")))


def test_state_lasts_over_batches(spark):
    docs = table(spark).repartition(6)
    rows = exact_dedup.shared_dir(spark, "t")
    written = exact_dedup.materialize(exact_dedup.entries(docs), f"{rows}/rows")
    state = exact_dedup.stream_state(spark, f"{rows}/rows", written.schema, rows, files_per_batch=1)
    groups = {x[1:] for x in expected(DATA)}
    assert sorted(x.n for x in state.collect()) == sorted(n for _, n in groups)


def test_drop_keeps_one_of_each_and_all_columns(spark):
    out = exact_dedup.drop_copies(spark, table(spark))
    assert out.columns == ["doc_id", "text", "digest", "n"]
    got = sorted(((x.doc_id, x.text) for x in out.collect()), key=str)
    assert got == sorted([(3, "a b"), (4, "a c"), (1, None), (7, "a\u00a0b"), (8, "x"), (8, "y" * 100000), (6, " a b")], key=str)


def test_empty(spark):
    assert exact_dedup.copies(spark, table(spark, [])).count() == 0
    assert exact_dedup.drop_copies(spark, table(spark, [])).count() == 0


def test_many_null_and_repeated_ids(spark):
    """Rows that share an id, or have none, don't all meet each other."""
    docs = spark.range(40_000).selectExpr("case when id % 2 = 0 then 7 end as doc_id", "concat('text ', id div 4) as text")
    got = exact_dedup.copies(spark, docs)
    assert got.where("group_size = 4").count() == 40_000
    assert exact_dedup.drop_copies(spark, docs).count() == 10_000
