"""Archives against what was written, at every split; the deduplication against brute force."""

import base64
import gzip
import hashlib
import io
import random

import pytest

from leafray.llm import warc
from leafray.sources.ranges import byte_ranges


def b32(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def brute(data, least=0):
    out = []
    groups = {}
    for i, (page, p) in enumerate(data):
        groups.setdefault(p or b"", []).append((-1 if page is None else page, i))
    for i, (page, p) in enumerate(data):
        p = p or b""
        top, _ = max(groups[p], key=lambda x: x[0])
        alone = len(p) < least or len(groups[p]) == 1
        out.append((page, len(p), b32(p), None if alone else top, alone))
    return out


def check(got, data, least=0):
    """``got`` (page_id, bytes, digest, type, refers_to): of equal payloads one response, of the largest page_id, the rest its revisits."""
    want = brute(data, least)
    assert sorted(map(str, [x[:3] for x in got])) == sorted(map(str, [x[:3] for x in want]))
    tops = {d: None if t == -1 else t for _, _, d, t, alone in want if not alone}
    alone = {d for _, _, d, _, a in want if a}
    for d in {x[2] for x in got}:
        same = [x for x in got if x[2] == d]
        if d in alone:
            assert all(x[3:] == ("response", None) for x in same)
        else:
            assert [x[0] for x in same if x[3] == "response"] == [tops[d]]
            assert all(x[4] == tops[d] for x in same if x[3] == "revisit")
            assert len(same) == 1 + sum(x[3] == "revisit" for x in same)


def pages(spark, data):
    return spark.createDataFrame([(f"http://x/{i}\r\nWARC-Type: evil", p, d, "c") for i, (d, p) in enumerate(data)], "url string, payload binary, page_id long, size string")


def rows(found):
    return [(x.page, x.payload_bytes, x.payload_digest, x.record_type, x.first) for x in found.select("*", warc.page_of(found.record_id).alias("page"), warc.page_of(found.refers_to).alias("first")).collect()]


def corpus(seed):
    r = random.Random(seed)
    noise = lambda n: r.randbytes(n)
    shared = [b"", b"x", noise(900), b"<html>" * 400]
    data = [(i, r.choice(shared) if r.random() < 0.3 else noise(r.randint(0, 4000))) for i in r.sample(range(5000), 150)]
    # payloads that look like members and records, and a long one
    data += [(6000, warc.MAGIC * 50), (6001, gzip.compress(b"no record")), (6002, b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc"), (6003, noise(300_000)), (6004, b"a" * 3_000_000)]
    return data + [(None, b"x"), (None, None), (None, b"only null"), (None, b"only null"), (7000, b"twice"), (7000, b"twice"), (7000, b"twice"), (7001, None)]


@pytest.mark.parametrize("split", [700, 20_000, 0])
def test_round_trip(spark, tmp_path, split):
    data = corpus(split)
    warc.write_archives(spark, pages(spark, data).repartition(3), str(tmp_path / "a"))
    found = warc.read_archives(spark, f"file://{tmp_path}/a", split)
    check(rows(found), data)
    assert found.where("not intact").count() == 0
    again = spark.read.format("warc").option("split", split).load(str(tmp_path / "a")).where("record_type = 'response'")
    assert sorted(bytes(x.payload) for x in again.collect()) == sorted({p or b"" for _, p in data})


def test_small_payloads_are_all_responses(spark, tmp_path):
    data = corpus(9)
    warc.write_archives(spark, pages(spark, data), str(tmp_path / "a"), least=10)
    check(rows(warc.read_archives(spark, str(tmp_path / "a"), 5000)), data, 10)


def test_empty(spark, tmp_path):
    warc.write_archives(spark, pages(spark, []), str(tmp_path / "a"))
    assert warc.read_archives(spark, str(tmp_path / "a")).count() == 0


def test_any_gzip_reader_reads_the_archives(spark, tmp_path):
    warc.write_archives(spark, pages(spark, [(1, b"one"), (2, b"one")]), str(tmp_path / "a"))
    text = b"".join(gzip.open(p).read() for p in (tmp_path / "a").glob("*.warc.gz"))
    assert text.count(b"WARC/1.1\r\n") == 2
    assert b"WARC-Type: revisit" in text and b"\r\nWARC-Type: evil" not in text
    assert b"WARC-Refers-To: <urn:page:2:" in text


def foreign(*blocks):
    """Records as another program may write them: other fields, no HTTP, folded lines."""
    out = []
    for i, (kind, content) in enumerate(blocks):
        head = f"WARC/1.0\r\nwarc-type: {kind}\r\nWARC-Record-ID: <urn:x:{i}>\r\nX-Long: a\r\n  b\r\nContent-length: {len(content)}\r\n\r\n".encode()
        to = io.BytesIO()
        with gzip.GzipFile("named.warc", "wb", 1, to) as f:
            f.write(head + content + b"\r\n\r\n")
        out.append(to.getvalue())
    return out


def owners(data, split):
    class File(io.BytesIO):
        pass

    return [[x[0] for x in warc.owned(File(data), len(data), r.start, r.end)] for r in byte_ranges([("f", len(data))], split)]


def test_every_record_has_one_owner():
    r = random.Random(1)
    parts = foreign(*[(r.choice(["warcinfo", "request", "metadata"]), r.randbytes(r.randint(0, 700))) for _ in range(40)])
    starts = [sum(map(len, parts[:i])) for i in range(len(parts))]
    data = b"".join(parts)
    for split in range(150, 2000, 37):
        assert [x for o in owners(data, split) for x in o] == starts
    (_, _, (header, http, payload)), *_ = warc.owned(io.BytesIO(data), len(data), 0, 1)
    assert header["x-long"] == "a b" and not http


def test_damage_is_not_passed_over():
    parts = foreign(*[("metadata", bytes([i]) * 300) for i in range(9)])
    broken = b"".join(parts[:4]) + b"junk" + b"".join(parts[4:])
    with pytest.raises(warc.Damaged):
        owners(broken, 10_000)
    cut = bytearray(b"".join(parts))
    cut[len(parts[0]) + 60] ^= 255
    with pytest.raises(warc.Damaged):
        owners(bytes(cut), 10_000)


def test_an_archive_inside_a_record(spark, tmp_path):
    """Members of a stored archive show in the bytes of the outer one; they aren't records of it."""
    r = random.Random(3)
    inner = b"".join(foreign(*[("metadata", r.randbytes(500)) for _ in range(30)]))
    packer = warc.zlib.compressobj(0, warc.zlib.DEFLATED, 31)
    outer = packer.compress(b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: %d\r\n\r\n" % len(inner) + inner + b"\r\n\r\n") + packer.flush()
    ends = foreign(("warcinfo", b"a"), ("warcinfo", b"b"))
    (tmp_path / "a.warc.gz").write_bytes(ends[0] + outer + ends[1])
    (tmp_path / "b.warc.gz").write_bytes(b"".join(foreign(("warcinfo", b"c"), ("metadata", r.randbytes(3000)), ("warcinfo", b"d"))))
    for split in (2_000, 5_000, 0):
        found = warc.read_archives(spark, str(tmp_path), split)
        assert sorted(x.record_type for x in found.collect()) == ["metadata", "resource"] + ["warcinfo"] * 4


def test_files_of_lost_attempts_do_not_count(spark, tmp_path):
    warc.write_archives(spark, pages(spark, [(1, b"one")]), str(tmp_path / "a"))
    (tmp_path / "a" / "part-00000-lost.warc.gz").write_bytes(foreign(("warcinfo", b"lost"))[0][:20])
    assert warc.read_archives(spark, str(tmp_path / "a")).count() == 1
