"""RINEX 2 observation files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafray.sources.text import BAND_OF_DIGIT

# Columns of the kinds of observations, and the codes that name their tracking.
KINDS = {"C": "pseudorange", "P": "pseudorange", "L": "phase", "D": "doppler", "S": "snr"}
TRACKING = {"C1": "C", "P1": "P", "C2": "C", "P2": "P"}
# Observations on a line, satellites on an epoch line.
PER_LINE, SATELLITES = 5, 12
_SCHEMA = "file string, epoch timestamp_ntz, sid string, snr double, pseudorange double, phase double, doppler double, lli int, ssi int"


def satellite(text: str) -> str:
    """Three characters; without a letter it is a GPS satellite."""
    text = text.strip()
    system, number = (text[0], text[1:]) if text[:1].isalpha() else ("G", text)
    return system + number.strip().zfill(2)


def _epoch(line: str) -> tuple[dt.datetime, int, int] | None:
    """Time, flag and number of satellites (or of special lines) of an epoch line."""
    try:
        year, *rest = (int(line[a:b].strip() or 0) for a, b in ((1, 3), (4, 6), (7, 9), (10, 12), (13, 15)))
        flag, n = int(line[28:29].strip() or 0), int(line[29:32].strip() or 0)
        if 2 <= flag <= 6:
            return dt.datetime.min, flag, n
        time = dt.datetime(year + (1900 if year >= 80 else 2000), *rest) + dt.timedelta(seconds=float(line[15:26].strip() or 0))
        return time, flag, n
    except ValueError:
        return None


def parse(text: str) -> Iterator[dict]:
    """Rows (epoch, sid and values); a value of zero is missing, special records and unreadable epochs are passed over."""
    lines, codes, at = text.splitlines(), [], 0
    while at < len(lines):
        label, body = lines[at][60:].strip(), lines[at][:60]
        at += 1
        if label == "# / TYPES OF OBSERV":
            codes += body[6:].split()
        if label == "END OF HEADER":
            break
    per_satellite = -(-len(codes) // PER_LINE)
    while at < len(lines):
        head = _epoch(lines[at]) if len(lines[at]) >= 32 else None
        line, at = lines[at], at + 1
        if head is None:
            continue
        time, flag, n = head
        if flag >= 2:
            at += n * (per_satellite if flag == 6 else 1)
            continue
        names = line[32:68]
        while len(names) < 3 * n and len(names) // 3 >= SATELLITES and at < len(lines):
            names, at = names.ljust(len(names) + -len(names) % 36) + lines[at][32:68], at + 1
        for k in range(n):
            cells = "".join(x[:80].ljust(80) for x in lines[at : at + per_satellite])
            at += per_satellite
            yield from _values(satellite(names[3 * k : 3 * k + 3]), time, codes, cells)


def _values(sv: str, time: dt.datetime, codes: list[str], cells: str) -> Iterator[dict]:
    found: dict[str, dict] = {}
    for k, code in enumerate(codes):
        cell = cells[16 * k : 16 * k + 16]
        band = BAND_OF_DIGIT.get(sv[0], {}).get(code[1:2])
        try:
            value = float(cell[:14])
        except ValueError:
            continue
        if band is None or code[0] not in KINDS or value == 0:
            continue
        row = found.setdefault(f"{sv}|{band}|{TRACKING.get(code, 'X')}", {})
        row[KINDS[code[0]]] = value
        if code[0] == "L":
            row |= {n: int(c) for n, c in (("lli", cell[14:15]), ("ssi", cell[15:16])) if c.isdigit()}
    for sid, values in found.items():
        yield {"epoch": time, "sid": sid, **values}


def read_rinex2(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """Observations in long form, of the closed time range if given; one task per file."""
    schema = pa.schema([("file", pa.string()), ("epoch", pa.timestamp("us")), ("sid", pa.string()), *[(n, pa.float64()) for n in ("snr", "pseudorange", "phase", "doppler")], ("lli", pa.int32()), ("ssi", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held = []
                for row in parse(text):
                    held.append({"file": file} | row)
                    if len(held) == 20_000:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held = []
                yield pa.RecordBatch.from_pylist(held, schema)

    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    out = whole.mapInArrow(run, _SCHEMA)
    if start is not None:
        out = out.where(F.col("epoch") >= F.lit(start))
    return out if end is None else out.where(F.col("epoch") <= F.lit(end))
