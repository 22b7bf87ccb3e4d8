"""WARC archives: a writer, and a reader whose tasks share files by byte ranges.

Both are the data source ``warc``. Every record is a gzip member of its own. A
task of the reader has a byte range: it looks for the magic bytes of gzip from
the start of the range, takes a candidate for a member only if it inflates and
begins with a whole record header whose length it keeps, and owns the members
that begin in its range, reading the last one beyond the range's end. From one
member it goes to the next one at its end.

A payload that holds an archive itself can show members that aren't the file's.
``untiled`` finds files whose records don't lie end to end; ``read_archives``
reads those again from their first byte, unsplit.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, WriterCommitMessage

from leafray.llm.common import join_counted, materialize, shared_dir, sieved
from leafray.sources.ranges import ByteRange, byte_ranges, files, opened, store

# Fixed values of the formats.
MAGIC = b"\x1f\x8b\x08"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32_OF_DIGITS = ("0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")

#: Bytes of a range, of a read, of payloads in a batch, and the longest record header that is looked for.
SPLIT, READ, BATCH, HEADER = 64 << 20, 1 << 20, 8 << 20, 1 << 20

RECORD = "file string, offset long, length long, record_type string, record_id string, headers map<string,string>, http map<string,string>, payload binary"
_ARROW = pa.schema(
    [
        ("file", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
        ("record_type", pa.string()),
        ("record_id", pa.string()),
        ("headers", pa.map_(pa.string(), pa.string())),
        ("http", pa.map_(pa.string(), pa.string())),
        ("payload", pa.binary()),
    ]
)


def sha1_digest(payload: Column) -> Column:
    """SHA-1 as archives write it: 32 characters of upper-case base32."""
    hexed = F.sha1(payload)
    part = lambda g: F.lpad(F.conv(F.substring(hexed, 1 + 10 * g, 10), 16, 32), 8, "0")
    return F.translate(F.concat(*[part(g) for g in range(4)]), *BASE32_OF_DIGITS)


# --- writing ---------------------------------------------------------------


def _value(text: str) -> str:
    """A header's value on one line: what would end the line is percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record_bytes(record_type: str, record_id: str, date: str, uri: str | None, payload: bytes, size: int, digest: str, refers_to: str | None) -> bytes:
    """A record with an HTTP response: the payload follows its header, but not in a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    body = http + payload if record_type == "response" else http
    lines = [VERSION, f"WARC-Type: {record_type}", f"WARC-Record-ID: <{_value(record_id)}>", f"WARC-Date: {_value(date)}"]
    if uri is not None:
        lines.append(f"WARC-Target-URI: {_value(uri)}")
    lines += [f"WARC-Payload-Digest: sha1:{digest}"]
    if record_type == "revisit":
        lines += [f"WARC-Refers-To: <{_value(refers_to or '')}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(lines).encode() + body + b"\r\n\r\n"


def member(record: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


@dataclass
class Written(WriterCommitMessage):
    name: str


class _Writer(DataSourceArrowWriter):
    """One file per task, named by its attempt; the driver lists the files that count in a manifest, so those of lost attempts don't."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex[:12]}.warc.gz"
        fs, place = store(self.path)
        fs.create_dir(place, recursive=True)
        with fs.open_output_stream(f"{place}/{name}", compression=None) as out:
            for batch in iterator:
                for row in batch.to_pylist():
                    out.write(member(record_bytes(**row)))
        return Written(name)

    def commit(self, messages: list[Written | None]) -> None:
        fs, place = store(self.path)
        fs.create_dir(place, recursive=True)
        with fs.open_output_stream(f"{place}/_manifest-{uuid.uuid4().hex[:12]}.json", compression=None) as out:
            out.write(json.dumps([m.name for m in messages if m]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        fs, place = store(self.path)
        for m in messages:
            if m:
                fs.delete_file(f"{place}/{m.name}")


# --- reading ---------------------------------------------------------------


class Damaged(ValueError):
    """Bytes of an archive that belong to no record."""


class Stretch:
    """Bytes of a file from some place on, read as they are asked for."""

    def __init__(self, source, size: int, at: int):
        self.source, self.size, self.at, self.held = source, size, at, b""
        source.seek(at)

    def more(self) -> bool:
        block = self.source.read(min(READ, self.size - self.at - len(self.held)))
        self.held += block
        return bool(block)

    def drop(self, n: int) -> None:
        self.held, self.at = self.held[n:], self.at + n

    def find(self, end: int) -> int | None:
        """The next place before ``end`` where a member could begin; what lies before it is let go."""
        while True:
            i = self.held.find(MAGIC)
            if i >= 0:
                self.drop(i)
                return self.at if self.at < end else None
            self.drop(max(0, len(self.held) - len(MAGIC) + 1))
            if self.at >= end or not self.more():
                return None

    def inflate(self) -> tuple[bytes, int] | None:
        """The member that begins here, as its content and its length in the file; None if there is none with a record in it."""
        unpacker, out, used, at = zlib.decompressobj(31), [], 0, 0
        known = False
        while True:
            if at == len(self.held) and not self.more():
                return None
            block = self.held[at : at + READ]
            try:
                out.append(unpacker.decompress(block))
            except zlib.error:
                return None
            at += len(block)
            if not known and (unpacker.eof or sum(map(len, out)) >= HEADER):
                if header_end(b"".join(out)) is None:
                    return None
                known = True
            if unpacker.eof:
                used = at - len(unpacker.unused_data)
                return b"".join(out), used


def header_end(record: bytes) -> int | None:
    """Where the body of a record begins; None unless ``record`` begins with a whole header that states its length."""
    end = record.find(b"\r\n\r\n", 0, HEADER)
    if not record.startswith(b"WARC/") or end < 0 or not re.search(rb"\r\ncontent-length:[ \t]*\d+[ \t]*(\r\n|$)", record[:end], re.I):
        return None
    return end + 4


def fields(header: bytes) -> dict[str, str]:
    """Fields of a header by their lower-case names; folded lines are joined, of repeated fields the last counts."""
    lines = re.sub(rb"\r\n[ \t]+", b" ", header).split(b"\r\n")[1:]
    pairs = (line.split(b":", 1) for line in lines if b":" in line)
    return {k.strip().lower().decode("utf-8", "replace"): v.strip().decode("utf-8", "replace") for k, v in pairs}


def parsed(record: bytes) -> tuple[dict[str, str], dict[str, str], bytes] | None:
    """Header, HTTP header (empty without one) and payload of a record; None if it isn't as long as it says."""
    at = header_end(record)
    if at is None:
        return None
    header = fields(record[: at - 4])
    body = record[at : at + int(header["content-length"])]
    if len(body) != int(header["content-length"]) or record[at + len(body) :].strip(b"\r\n"):
        return None
    if not header.get("content-type", "").startswith("application/http"):
        return header, {}, body
    end = body.find(b"\r\n\r\n")
    return (header, fields(body[:end]), body[end + 4 :]) if end >= 0 else (header, {}, body)


def owned(source, size: int, start: int, end: int, gaps: bool = False):
    """Offset, length and parts of the records that begin from ``start`` to before ``end``.

    Bytes before the first record of a later range belong to the range before.
    Anything else between records is damage, or shows that the first one was
    none of the file's own: an error, unless a later range may have ``gaps``.
    """
    here, first = Stretch(source, size, start), start > 0
    gaps = gaps and start > 0
    while here.at < end:
        begin = here.at
        while (at := here.find(end)) is not None:
            found = here.inflate()
            parts = parsed(found[0]) if found else None
            if parts:
                break
            here.drop(1)
        if at is None:
            if not (first or gaps) and min(end, size) > begin:
                raise Damaged(f"no record from byte {begin}")
            return
        if not (first or gaps) and at != begin:
            raise Damaged(f"no record from byte {begin} to {at}")
        first = False
        yield at, found[1], parts
        here.drop(found[1])


class _Reader(DataSourceReader):
    def __init__(self, path: str, split: int, payload: bool, gaps: bool):
        self.path, self.split, self.payload, self.gaps = path, split, payload, gaps

    def partitions(self) -> list[ByteRange]:
        fs, place = store(self.path)
        found = files(self.path)
        if fs.get_file_info(place).is_file:
            return byte_ranges(found, self.split)
        import pyarrow.fs as pafs

        manifests = [f.path for f in fs.get_file_info(pafs.FileSelector(place)) if f.base_name.startswith("_manifest-")]
        if manifests:
            listed = {name for m in manifests for name in json.loads(fs.open_input_stream(m, compression=None).read())}
            found = [(p, n) for p, n in found if os.path.basename(p) in listed]
        return byte_ranges([(p, n) for p, n in found if p.endswith(".gz")], self.split)

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        with opened(partition.path) as source:
            for at, length, (header, http, payload) in owned(source, partition.size, partition.start, partition.end, self.gaps):
                unbracketed = header.get("warc-record-id", "").strip("<>")
                row = (partition.path, at, length, header.get("warc-type"), unbracketed, list(header.items()), list(http.items()), payload if self.payload else None)
                rows.append(dict(zip(_ARROW.names, row, strict=True)))
                held += len(payload)
                if held > BATCH or len(rows) >= 2_000:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _ARROW)


class Warc(DataSource):
    """``spark.read.format("warc").load(path)`` and ``df.write.format("warc").save(path)``.

    Options of reads: ``split``, the bytes of a range (0: files are read whole);
    ``payload`` (false: payloads are null); ``gaps`` (true: ranges but the first
    of a file pass over bytes between records, for readers that call ``untiled``).
    Reads give RECORD: file, offset and length of the member, record_type,
    record_id (without brackets), headers and http (fields by lower-case name),
    payload (of an HTTP response without its header). Writes take the columns
    of ``record_bytes``.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return RECORD

    def reader(self, schema) -> _Reader:
        flag = lambda name, default: self.options.get(name, default).lower() == "true"
        return _Reader(self.options["path"], int(self.options.get("split", SPLIT)), flag("payload", "true"), flag("gaps", "false"))

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"])


# --- archives as tables ----------------------------------------------------


def write_archives(spark: SparkSession, pages: DataFrame, path: str, least: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """A record per row of ``pages`` (page_id, url, payload binary) into ``path``.

    Of rows with equal payloads of at least ``least`` bytes, the one with the
    largest page_id (null is smallest) is the response and the others revisit
    it; other rows are responses. Of rows that repeat both, one is the response.
    A null payload is empty. A record's id is urn:page:ID:DIGEST, with a number where rows
    could repeat; ``page_of`` reads the page_id from it. Other columns are ignored.
    """
    spark.dataSource.register(Warc)
    root = shared_dir(spark, "warc")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("payload"), F.lit(b"")).alias("payload"))
    # equal bytes by a digest that no two known texts share; the format's own SHA-1 does have collisions
    rows = rows.withColumn("size", F.octet_length("payload").cast("long")).withColumn("same", F.when(F.col("size") >= least, F.unhex(F.sha2("payload", 256))))
    groups = rows.where("same is not null").groupBy("same").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = materialize(groups, f"{root}/groups")
    marked = sieved(rows, [F.hex("same")], groups, [F.hex("same")])
    own_id = lambda *more: F.concat_ws(":", F.lit("urn:page"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.substring(F.hex(F.coalesce("same", F.unhex(F.sha2("payload", 256)))), 1, 16), *more)
    none = F.lit(None).cast("string")
    alone = marked.where("not maybe_").select(F.lit("response").alias("record_type"), own_id().alias("record_id"), "url", "payload", "size", sha1_digest(F.col("payload")).alias("digest"), none.alias("refers_to"))
    doubtful = materialize(marked.where("maybe_").drop("maybe_").withColumn("row", F.monotonically_increasing_id()), f"{root}/doubtful")
    doubtful = doubtful.withColumn("record_id", own_id(F.col("row").cast("string")))
    first = doubtful.groupBy("same").agg(F.max(F.struct("page_id", "row", "record_id")).alias("first"), F.count(F.lit(1)).alias("n"))
    found = join_counted(doubtful, first, "same", "n", doubtful.count())
    is_first = F.col("row") == F.col("first.row")
    shared = found.select(
        F.when(is_first, "response").otherwise("revisit").alias("record_type"),
        "record_id",
        "url",
        F.when(is_first, F.col("payload")).otherwise(F.lit(b"")).alias("payload"),
        "size",
        sha1_digest(F.col("payload")).alias("digest"),
        F.when(~is_first, F.col("first.record_id")).alias("refers_to"),
    )
    records = alone.unionByName(shared)
    records.select("record_type", "record_id", F.lit(date).alias("date"), F.col("url").alias("uri"), "payload", "size", "digest", "refers_to").write.format("warc").mode("append").save(path)


def page_of(record_id: Column) -> Column:
    return F.regexp_extract(record_id, r"^urn:page:(-?\d+):", 1).try_cast("long")


def untiled(records: DataFrame) -> DataFrame:
    """Files of ``records`` (file, offset, length) whose records, in order, don't each begin where the one before ends."""
    order = Window.partitionBy("file").orderBy("offset", "length")
    before = F.coalesce(F.lag(F.col("offset") + F.col("length")).over(order), F.lit(0))
    return records.select("file", (F.col("offset") != before).alias("off")).where("off").select("file").distinct()


def read_archives(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """What the archives below ``path`` say of each record: file, offset, length, record_id, record_type, uri, payload_bytes, payload_digest, refers_to, intact.

    Size and digest of a response are those of the payload that was read, and
    intact says whether its header states the same digest; a revisit has no
    payload, so its are those that its headers state. Payloads stay in the
    archives: ``spark.read.format("warc")`` gives them.
    """
    spark.dataSource.register(Warc)
    root = shared_dir(spark, "warc-read")
    load = lambda split: _described(spark.read.format("warc").options(split=split, gaps=True).load(path))
    found = materialize(load(split), f"{root}/records")
    off = materialize(untiled(found), f"{root}/untiled")
    if off.isEmpty():
        return found
    whole = load(0).join(off, "file", "left_semi")
    return found.join(off, "file", "left_anti").unionByName(whole)


def _described(records: DataFrame) -> DataFrame:
    header = lambda name: F.col("headers")[name]
    stated = F.regexp_replace(header("warc-payload-digest"), "^sha1:", "")
    full = F.col("record_type") != "revisit"
    digest = F.when(full, sha1_digest(F.col("payload"))).otherwise(stated)
    return records.select(
        "file",
        "offset",
        "length",
        "record_id",
        "record_type",
        header("warc-target-uri").alias("uri"),
        F.when(full, F.octet_length("payload")).otherwise(F.col("http")["content-length"].try_cast("long")).cast("long").alias("payload_bytes"),
        digest.alias("payload_digest"),
        F.btrim(header("warc-refers-to"), F.lit("<>")).alias("refers_to"),
        F.coalesce(digest == stated, F.lit(True)).alias("intact"),
    )
