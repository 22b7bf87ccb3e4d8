"""Stateful streams: pieces of a log against the batch reader of the whole, and days given out once."""

import datetime as dt
import functools
import operator
import random
import time

import pytest

from leafray.sources import text
from leafray.streaming import groups, nmea


@pytest.fixture
def stateful(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield spark
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def sentence(body):
    return f"${body}*{functools.reduce(operator.xor, map(ord, body)):02X}"


def log(seed, epochs):
    r = random.Random(seed)
    out = ["junk before any epoch", sentence("GPGSV,1,1,01,05,40,083,46")]
    for i in range(epochs):
        out.append(sentence(f"GPRMC,{i // 60:02d}{i % 60:02d}00.{r.choice(['', '00'])},A,4740.0,N,01618.0,E,0,0,010124,,"))
        for talker in ("GP", "GL", "GA", "GB"):
            for _ in range(r.randint(0, 2)):
                sats = "".join(f",{r.choice([1, 5, 33, 40, 70]):02d},40,083,{r.choice(['', '31', '45'])}" for _ in range(r.randint(1, 4)))
                x = sentence(f"{talker}GSV,2,1,04{sats}")
                out.append(x if r.random() < 0.9 else x[:-2] + "ZZ")
        if r.random() < 0.3:
            out.append(sentence(f"GPGGA,{i // 60:02d}{i % 60:02d}00.00,4740.0,N,01618.0,E,1,08,1,250,M,0,M,,"))
    return "\r\n".join(out)


def run(spark, source, out, checkpoint, patience_ms=600_000, seconds=None):
    writer = nmea.epochs(nmea.read_pieces(spark, source, 5), patience_ms).writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    # with timers of processing time there is always one more batch to run, so the query is stopped when files no longer come
    query = writer.trigger(processingTime="1 second").start(out)
    until, idle = time.monotonic() + 60, 0
    while time.monotonic() < until and idle < (seconds or 1) and query.exception() is None:
        time.sleep(0.5)
        seen = query.recentProgress
        idle = len(seen) and next((i for i, p in enumerate(reversed(seen)) if p.numInputRows), len(seen))
    query.stop()
    assert query.exception() is None


def rows(df):
    return sorted((x.receiver, x.epoch, x.sv, x.snr) for x in df.collect())


def test_pieces_cut_anywhere(stateful, tmp_path):
    """Pieces that come out of order, twice and over restarts give the rows of the batch reader; the last epoch stays open until its timer."""
    spark, r = stateful, random.Random(2)
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    (tmp_path / "in").mkdir()
    (tmp_path / "whole").mkdir()
    pieces = []
    for receiver in ("north", "south"):
        whole = log(receiver, 25)
        (tmp_path / "whole" / f"{receiver}.nmea").write_text(whole, newline="")
        cuts = sorted(r.sample(range(1, len(whole)), 7))
        pieces += [(f"{receiver}_{i:03d}.nmea", whole[a:b]) for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(whole)]))]
    r.shuffle(pieces)
    for at in range(0, len(pieces), 8):
        for name, content in pieces[at : at + 8]:
            (tmp_path / "in" / name).write_text(content, newline="")
        run(spark, source, out, checkpoint)
    for name, content in pieces[:2]:
        (tmp_path / "in" / name.replace("_", "_0")).write_text(content, newline="")
    run(spark, source, out, checkpoint)
    whole = text.read_nmea(spark, str(tmp_path / "whole")).selectExpr("regexp_extract(file, '([a-z]+)[.]nmea$', 1) AS receiver", "epoch", "sv", "snr")
    last = {x.receiver: x.epoch for x in whole.groupBy("receiver").agg({"epoch": "max"}).withColumnRenamed("max(epoch)", "epoch").collect()}
    want = rows(whole)
    assert rows(spark.read.parquet(out)) == [x for x in want if x[1] < last[x[0]]]
    # a timer closes what stays open; the files only wake the stream
    (tmp_path / "in" / "north_900.nmea").write_text("\n", newline="")
    (tmp_path / "in" / "south_900.nmea").write_text("\n", newline="")
    run(spark, source, out, checkpoint, patience_ms=1000, seconds=4)
    assert rows(spark.read.parquet(out)) == want


def days(spark, tmp_path, arrivals, late):
    """Runs the stream once per arrival, each a list of (receiver, file_hash, start hour, end hour)."""
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    zero = dt.datetime(2024, 1, 1)
    schema = "receiver string, file_hash string, start timestamp_ntz, end timestamp_ntz"
    got = []
    for arrived in arrivals:
        data = [(r, h, zero + dt.timedelta(hours=a), zero + dt.timedelta(hours=b) - dt.timedelta(hours=1)) for r, h, a, b in arrived]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(source)
        stream = groups.complete_groups(spark.readStream.schema(schema).parquet(source), 3600, late)
        stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(out).awaitTermination()
        new = sorted((x.receiver, x.date.day, tuple(x.files), x.n_epochs, x.complete) for x in spark.read.parquet(out).collect())
        got.append([x for x in new if not any(x in g for g in got)])
        assert len(new) == sum(map(len, got))
    return got


def test_days_come_once(stateful, tmp_path):
    got = days(
        stateful,
        tmp_path,
        [
            [("a", "f1", 0, 12), ("a", "f1", 0, 12), ("b", "g1", 0, 24)],  # a repeated file covers nothing new
            [("a", "f2", 12, 30)],  # over midnight
            [("a", "f2", 12, 30), ("a", "f3", 0, 24)],  # repeated, and late for a day that is out
            [("b", "g2", 24, 40), ("a", "f4", 30, 47)],  # one epoch short
            [("b", "g9", 24 * 9, 24 * 9 + 5)],  # the watermark passes the second day
            [("a", "f5", 47, 48), ("b", "g3", 40, 48)],  # too late
        ],
        "3 days",
    )
    assert got[0] == [("b", 1, ("g1",), 24, True)]
    assert got[1] == [("a", 1, ("f1", "f2"), 24, True)]
    assert got[2] == got[3] == []
    assert got[4] == [("a", 2, ("f2", "f4"), 23, False), ("b", 2, ("g2",), 16, False)]
    assert got[5] == []
