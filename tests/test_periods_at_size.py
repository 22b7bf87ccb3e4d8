"""What a task takes of period tables."""

import datetime as dt

from leafray.operators import periods
from leafray.plans import sky
from leafray.sources import text

DAY = lambda n: None if n is None else dt.datetime(2020, 1, 1) + dt.timedelta(days=n)


def frame(spark, rows, name):
    return spark.createDataFrame([(k, DAY(a), DAY(b), v) for k, a, b, v in rows], f"svn string, start timestamp_ntz, end timestamp_ntz, {name} string")


def test_timeline_reads_a_table_once(spark):
    """Tables that come dealt by the key are neither shuffled again nor computed twice."""
    tables = {n: frame(spark, [(f"k{i}", i, i + 3, n) for i in range(20)], n).repartition(7, "svn") for n in "ab"}
    out = periods.timeline(tables, "svn")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == len(tables)
    assert sorted((x.svn, x.a, x.b) for x in out.collect()) == sorted((f"k{i}", "a", "b") for i in range(20))


def test_timeline_is_not_cut_by_a_period_that_does_not_count(spark):
    a = frame(spark, [("k", 0, 5, "short"), ("k", 0, 9, "long"), ("k", 20, None, "open")], "a")
    b = frame(spark, [("k", 3, 9, "x"), ("k", 9, 9, "empty")], "b")
    out = periods.timeline({"a": a, "b": b}, "svn").orderBy("start").collect()
    assert [(x.start, x.end, x.a, x.b) for x in out] == [(DAY(0), DAY(3), "long", None), (DAY(3), DAY(9), "long", "x"), (DAY(20), None, "open", None)]


def test_orders_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(sky, "PART", 300)
    n = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
    for table in sky.order_periods(spark, "/root/testdata/sf0.001"):
        assert table.rdd.getNumPartitions() == 1 + n // 300


def test_catalog_of_a_file_in_many_ranges(spark, tmp_path):
    """A file is read by byte ranges; the blocks of a range are those that begin in it or before it, in the same file."""
    line = lambda i: f" S{i:05d} 2020:{1 + i % 300:03d}:00000 0000:000:00000 {i % 7}"
    for name, first in (("a", 0), ("b", 50_000)):
        prn, mass = [line(i) for i in range(first, first + 20_000)], [line(i) for i in range(first, first + 9_000)]
        body = [" S99999 2020:001:00000 0000:000:00000 9", "+SATELLITE/PRN", *prn, "-SATELLITE/PRN", "*no block", " S99999 2020:001:00000 0000:000:00000 9", "+SATELLITE/MASS", *mass, "-SATELLITE/MASS", ""]
        (tmp_path / f"{name}.snx").write_bytes("\r\n".join(body).encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = text.numbered_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 20
        tables = periods.catalog(lines)
        for name, n in (("prn", 20_000), ("mass", 9_000)):
            got = [x.svn for x in tables[name].collect()]
            assert sorted(got) == [f"S{first + i:05d}" for first in (0, 50_000) for i in range(n)]
        assert {x.start.year for x in tables["mass"].select("start").distinct().collect()} == {2020}
        assert text.read_validity(spark, str(tmp_path), "SATELLITE/MASS").count() == 18_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
