"""RINEX 3 observation files as the data source ``rinex3``.

A file is read by byte ranges. A task owns the epochs whose mark (a line that
begins with ``>``) lies in its range, whatever range their last line lies in.
Of an epoch outside the wanted time only the mark is decoded.

The time comes as options (``start``, ``end``, inclusive), which belong to the
loaded table and hold in any plan. ``rinex3_once`` also takes Spark's filters on
``epoch``. Spark 4.1 keeps filters that it gave to a Python source in the loaded
table and applies them to later plans of the same load as well, so a load of it
must serve one query only; ``scan_once`` makes one for each call.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import datasource as D
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

from leafray.sources.ranges import ByteRange, byte_ranges, files, opened
from leafray.sources.text import BAND_OF_DIGIT

#: Bytes of a range and of a read, and rows of a batch.
SPLIT, READ, BATCH = 64 << 20, 1 << 20, 20_000
OBSERVATIONS = "file string, epoch timestamp_ntz, sid string, snr double, pseudorange double, phase double, doppler double, lli int, ssi int"
HEADER = (
    "file string, labels array<string>, version double, file_type string, system string, program string, run_by string, date string, "
    "marker_name string, marker_number string, marker_type string, observer string, agency string, receiver_number string, receiver_type string, "
    "receiver_version string, antenna_number string, antenna_type string, position array<double>, antenna_delta array<double>, "
    "codes map<string,array<string>>, code_counts map<string,int>, signal_unit string, interval double, first_obs timestamp_ntz, last_obs timestamp_ntz, "
    "time_system string, phase_shifts array<struct<system:string,code:string,cycles:double>>, slots map<string,int>, biases map<string,double>, leap_seconds int"
)
_COLUMNS = {"S": "snr", "C": "pseudorange", "L": "phase", "D": "doppler"}
_ARROW = pa.schema(
    [("file", pa.string()), ("epoch", pa.timestamp("us")), ("sid", pa.string()), *[(c, pa.float64()) for c in ("snr", "pseudorange", "phase", "doppler")], ("lli", pa.int32()), ("ssi", pa.int32())]
)


def number(text: str, kind: type = float):
    try:
        return kind(text)
    except ValueError:
        return None


def moment(text: str) -> dt.datetime | None:
    """Year, month, day, hour, minute and seconds."""
    p = text.split()
    try:
        return dt.datetime(*map(int, p[:5])) + dt.timedelta(seconds=float(p[5]))
    except (ValueError, IndexError, OverflowError, TypeError):
        return None


def header_lines(source) -> tuple[list[str], int]:
    """The lines of the header, and where the body begins."""
    held = b""
    while True:
        at = held.find(b"END OF HEADER")
        end = held.find(b"\n", at) if at >= 0 else -1
        if end >= 0:
            return held[: end + 1].decode("ascii", "replace").splitlines(), end + 1
        block = source.read(65_536)
        if not block:
            return held.decode("ascii", "replace").splitlines(), len(held)
        held += block


def codes_of(lines: Iterable[str]) -> tuple[dict[str, list[str]], dict[str, int]]:
    """Observation codes of each system in their order, and the numbers of them that are announced."""
    codes, counts, system = {}, {}, ""
    for line in lines:
        if line[60:].strip() == "SYS / # / OBS TYPES":
            if line[0] != " ":
                system = line[0]
                counts[system] = number(line[3:6], int)
            codes.setdefault(system, []).extend(line[7:60].split())
    return codes, counts


def parsed_header(lines: list[str]) -> dict:
    """The header's fields; what is absent is null, lists and maps are empty."""
    by: dict[str, list[str]] = {}
    for line in lines:
        by.setdefault(line[60:].strip(), []).append(line[:60])
    first = lambda label: by.get(label, [""])[0].ljust(60)
    part = lambda label, a, b: first(label)[a:b].strip() or None
    floats = lambda label: [number(x) for x in first(label).split()]
    codes, counts = codes_of(lines)
    slots = " ".join(x[4:] for x in by.get("GLONASS SLOT / FRQ #", [])).split()
    biases = " ".join(by.get("GLONASS COD/PHS/BIS", [])).split()
    shifts = [x for x in by.get("SYS / PHASE SHIFT", []) if x[:5].strip()]
    pairs = lambda words, kind: [(k, number(v, kind)) for k, v in zip(words[::2], words[1::2])]
    return {
        "labels": sorted(by),
        "version": number(first("RINEX VERSION / TYPE")[:9]),
        "file_type": part("RINEX VERSION / TYPE", 20, 21),
        "system": part("RINEX VERSION / TYPE", 40, 41),
        "program": part("PGM / RUN BY / DATE", 0, 20),
        "run_by": part("PGM / RUN BY / DATE", 20, 40),
        "date": part("PGM / RUN BY / DATE", 40, 60),
        "marker_name": part("MARKER NAME", 0, 60),
        "marker_number": part("MARKER NUMBER", 0, 20),
        "marker_type": part("MARKER TYPE", 0, 20),
        "observer": part("OBSERVER / AGENCY", 0, 20),
        "agency": part("OBSERVER / AGENCY", 20, 60),
        "receiver_number": part("REC # / TYPE / VERS", 0, 20),
        "receiver_type": part("REC # / TYPE / VERS", 20, 40),
        "receiver_version": part("REC # / TYPE / VERS", 40, 60),
        "antenna_number": part("ANT # / TYPE", 0, 20),
        "antenna_type": part("ANT # / TYPE", 20, 40),
        "position": floats("APPROX POSITION XYZ"),
        "antenna_delta": floats("ANTENNA: DELTA H/E/N"),
        "codes": list(codes.items()),
        "code_counts": list(counts.items()),
        "signal_unit": part("SIGNAL STRENGTH UNIT", 0, 20),
        "interval": number(first("INTERVAL")[:10]),
        "first_obs": moment(first("TIME OF FIRST OBS")[:43]),
        "last_obs": moment(first("TIME OF LAST OBS")[:43]),
        "time_system": part("TIME OF FIRST OBS", 48, 51),
        "phase_shifts": [{"system": x[0].strip(), "code": x[2:5].strip(), "cycles": number(x[6:14])} for x in shifts],
        "slots": pairs(slots, int),
        "biases": pairs(biases, float),
        "leap_seconds": number(first("LEAP SECONDS")[:6], int),
    }


def epochs(source, start: int, end: int) -> Iterator[bytes]:
    """The epochs whose mark lies from ``start`` to before ``end``; ``start`` is behind the header."""
    source.seek(start - 1)
    base, held, ended = start - 1, b"", False
    while True:
        at = held.find(b"\n>")
        while at < 0:
            block = source.read(READ)
            if not block:
                return
            # the line feed of a mark may be the last byte held
            base, held = base + max(0, len(held) - 1), held[-1:] + block
            at = held.find(b"\n>")
        if base + at + 1 >= end:
            return
        while (to := held.find(b"\n>", at + 2)) < 0 and not ended:
            block = source.read(READ)
            ended, held = not block, held + block
        yield held[at + 1 : to if to >= 0 else len(held)]
        if to < 0:
            return
        base, held = base + to, held[to:]


class Columns:
    """Observations of one file as columns, a row per epoch and signal."""

    def __init__(self, file: str, codes: dict[str, list[str]]):
        self.file = file
        # per system: place of the cell, column, and the part of the signal's name behind the satellite
        self.cells = {}
        for system, names in codes.items():
            bands = BAND_OF_DIGIT.get(system, {})
            named = [(3 + 16 * k, _COLUMNS.get(c[0]), f"|{bands.get(c[1:2], 'UnknownBand' + c[1:2])}|{c[2:3]}") for k, c in enumerate(names)]
            self.cells[system] = [x for x in named if x[1]]
        self.clear()

    def clear(self) -> None:
        self.columns = {c: [] for c in _ARROW.names[1:]}

    def __len__(self) -> int:
        return len(self.columns["sid"])

    def add(self, epoch: dt.datetime, lines: list[str]) -> None:
        """The observations of an epoch; zero strength is missing."""
        c = self.columns
        for line in lines:
            cells = self.cells.get(line[:1])
            if cells is None or len(line) < 3:
                continue
            sv, at = line[:3].replace(" ", "0"), {}
            for place, column, signal in cells:
                value = number(line[place : place + 14])
                if value is None or (column == "snr" and value == 0):
                    continue
                row = at.get(signal)
                if row is None:
                    row = at[signal] = len(c["sid"])
                    for name, values in c.items():
                        values.append(None)
                    c["epoch"][row], c["sid"][row] = epoch, sv + signal
                c[column][row] = value
                if column == "phase":
                    for name, digit in (("lli", line[place + 14 : place + 15]), ("ssi", line[place + 15 : place + 16])):
                        if digit.isdigit():
                            c[name][row] = int(digit)

    def batch(self) -> pa.RecordBatch:
        arrays = [pa.array([self.file] * len(self), pa.string()), *[pa.array(v, _ARROW.field(n).type) for n, v in self.columns.items()]]
        self.clear()
        return pa.RecordBatch.from_arrays(arrays, schema=_ARROW)


_TESTS: dict[type, Callable] = {
    D.EqualTo: lambda e, v: e == v,
    D.GreaterThan: lambda e, v: e > v,
    D.GreaterThanOrEqual: lambda e, v: e >= v,
    D.LessThan: lambda e, v: e < v,
    D.LessThanOrEqual: lambda e, v: e <= v,
    D.In: lambda e, v: e in v,
}


def _naive(value):
    """A filter's constant as the files' times are held."""
    if isinstance(value, (tuple, list)):
        return tuple(map(_naive, value))
    return value.astimezone(dt.UTC).replace(tzinfo=None) if isinstance(value, dt.datetime) and value.tzinfo else value


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.split, self.header = options["path"], int(options.get("split", SPLIT)), options.get("content") == "header"
        bounds = ((D.GreaterThanOrEqual, options.get("start")), (D.LessThanOrEqual, options.get("end")))
        self.filters: list[tuple[type, object]] = [(kind, dt.datetime.fromisoformat(v)) for kind, v in bounds if v]

    def partitions(self) -> list[ByteRange]:
        found = files(self.path)
        return [ByteRange(p, 0, n, n) for p, n in found] if self.header else byte_ranges(found, self.split)

    def read(self, partition: ByteRange) -> Iterator:
        with opened(partition.path) as source:
            lines, body = header_lines(source)
            if self.header:
                row = {"file": partition.path} | parsed_header(lines)
                yield tuple({k: dict(v) if k in ("codes", "code_counts", "slots", "biases") else v for k, v in row.items()}.values())
                return
            if partition.end <= body:
                return
            found = Columns(partition.path, codes_of(lines)[0])
            for epoch in epochs(source, max(partition.start, body), partition.end):
                when = moment(epoch[1:].split(b"\n", 1)[0][:29].decode("ascii", "replace"))
                if when is None or not all(_TESTS[kind](when, value) for kind, value in self.filters):
                    continue
                found.add(when, epoch.decode("ascii", "replace").splitlines()[1:])
                if len(found) >= BATCH:
                    yield found.batch()
            if len(found):
                yield found.batch()


class _FilteredReader(_Reader):
    def pushFilters(self, filters: list) -> Iterable:  # noqa: N802 (Spark's name)
        """Takes comparisons of ``epoch`` with constants, and that it isn't null; the rest stays with Spark."""
        for f in filters:
            of_epoch = not self.header and getattr(f, "attribute", None) == ("epoch",)
            if of_epoch and type(f) in _TESTS:
                self.filters.append((type(f), _naive(f.value)))
            elif not (of_epoch and type(f) is D.IsNotNull):
                yield f


class Rinex3(DataSource):
    """Options: ``path`` (a file or folder), ``split`` (bytes of a range; 0 for whole files), ``start`` and ``end`` (ISO times) and ``content`` (header: one row per file)."""

    @classmethod
    def name(cls) -> str:
        return "rinex3"

    def schema(self) -> str:
        return HEADER if self.options.get("content") == "header" else OBSERVATIONS

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)


class Rinex3Once(Rinex3):
    @classmethod
    def name(cls) -> str:
        return "rinex3_once"

    def reader(self, schema) -> _FilteredReader:
        return _FilteredReader(self.options)


def read_rinex3(spark: SparkSession, path: str, split: int = SPLIT, start: dt.datetime | None = None, end: dt.datetime | None = None) -> DataFrame:
    """Observations in long form, of the epochs from ``start`` to ``end``, both included."""
    spark.dataSource.register(Rinex3)
    bounds = {k: v.isoformat() for k, v in (("start", start), ("end", end)) if v is not None}
    return spark.read.format("rinex3").options(split=split, **bounds).load(path)


def scan_once(spark: SparkSession, path: str, condition: Column, split: int = SPLIT) -> DataFrame:
    """Observations that meet ``condition``, with comparisons of ``epoch`` pushed into the scan. For one query: see above."""
    spark.dataSource.register(Rinex3Once)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("rinex3_once").option("split", split).load(path).where(condition)


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: the fields of its header, codes and slots as maps."""
    spark.dataSource.register(Rinex3)
    return spark.read.format("rinex3").option("content", "header").load(path)


def file_signals(headers: DataFrame, satellites: dict[str, int]) -> DataFrame:
    """The signals that a file can hold: every code of its header for every satellite of the code's system; file, sid, sv, system, band, code."""
    bands = F.create_map(*[F.lit(x) for s, digits in BAND_OF_DIGIT.items() for d, name in digits.items() for x in (s + d, name)])
    each = headers.select("file", F.explode("codes").alias("system", "names")).select("file", "system", F.explode("names").alias("name"))
    digit, known = F.substring("name", 2, 1), F.create_map(*[F.lit(x) for s, n in satellites.items() for x in (s, n)])
    each = each.select("file", "system", F.coalesce(bands[F.concat("system", digit)], F.concat(F.lit("UnknownBand"), digit)).alias("band"), F.substring("name", 3, 1).alias("code")).distinct()
    sv = F.concat("system", F.lpad(F.col("number").cast("string"), 2, "0"))
    each = each.where(known[F.col("system")].isNotNull()).withColumn("number", F.explode(F.sequence(F.lit(1), known[F.col("system")])))
    return each.select("file", F.concat_ws("|", sv, "band", "code").alias("sid"), sv.alias("sv"), "system", "band", "code")
