"""RINEX 3 by byte ranges: rows, header, pushed filters and the format's rules."""

import datetime as dt
import io
import random

import pytest
from pyspark.sql import functions as F

from leafray.operators import headers, signals
from leafray.sources import ranges, rinex3

START = dt.datetime(2024, 1, 1)


def line(text, label):
    return f"{text:<60}{label}"


GOOD = [
    line(f"{3.04:9.2f}{'':11}{'OBSERVATION DATA':<20}{'M: Mixed':<20}", "RINEX VERSION / TYPE"),
    line(f"{'prog':<20}{'me':<20}{'20240101 000000 UTC':<20}", "PGM / RUN BY / DATE"),
    line("SITE", "MARKER NAME"),
    line("7", "MARKER NUMBER"),
    line(f"{'o':<20}{'a b':<40}", "OBSERVER / AGENCY"),
    line(f"{'1':<20}{'REC':<20}{'v2':<20}", "REC # / TYPE / VERS"),
    line(f"{'2':<20}{'ANT':<20}", "ANT # / TYPE"),
    line(f"{4075578.0:14.4f}{931852.0:14.4f}{4801568.0:14.4f}", "APPROX POSITION XYZ"),
    line(f"{0.5:14.4f}{0.0:14.4f}{0.0:14.4f}", "ANTENNA: DELTA H/E/N"),
    line("G    4 C1C L1C D1C S1C", "SYS / # / OBS TYPES"),
    line("R    4 C1C L1C D1C S1C", "SYS / # / OBS TYPES"),
    line("E   14 C1C L1C D1C S1C C5Q L5Q D5Q S5Q C7Q L7Q D7Q S7Q C8Q", "SYS / # / OBS TYPES"),
    line("       L8Q", "SYS / # / OBS TYPES"),
    line("G L1C  0.25000", "SYS / PHASE SHIFT"),
    line("  2 R01  1 R02 -4", "GLONASS SLOT / FRQ #"),
    line(" C1C  -71.940 C1P  -71.940", "GLONASS COD/PHS/BIS"),
    line(f"{30.0:10.3f}", "INTERVAL"),
    line("  2024     1     1     0     0    0.0000000     GPS", "TIME OF FIRST OBS"),
    line("    18", "LEAP SECONDS"),
    line("", "END OF HEADER"),
]


def epoch(seconds, rows):
    t = START + dt.timedelta(seconds=seconds)
    return [f"> {t:%Y %m %d %H %M} {t.second + t.microsecond / 1e6:10.7f}  0{len(rows):3d}", *rows]


def row(sv, *values):
    return sv + "".join(f"{v:14.3f}{x}" if v is not None else " " * 16 for v, x in values)


def body(n, seed=1):
    r = random.Random(seed)
    out = []
    for i in range(n):
        rows = [row(f"{s}{k:02d}", (2e7 + r.random() * 1e6, "  "), (1e8, "15" if r.random() < 0.5 else " 7"), (None if r.random() < 0.2 else -500.0, "  "), (r.choice([0.0, 30.5, 45.0]), "  ")) for s in "GRE" for k in range(1, r.randint(1, 5))]
        out += epoch(30 * i, rows)
        if r.random() < 0.05:
            out += ["> broken", row("G01", (1.0, "  "))]
    return out


def written(path, head=GOOD, lines=(), end="\n"):
    path.write_bytes(end.join([*head, *lines, ""]).encode())
    return str(path)


def plain(text):
    """All rows of a file, read line by line."""
    out, codes, system, when, in_head = [], {}, None, None, True
    for x in text.splitlines():
        if in_head:
            if x[60:].strip() == "SYS / # / OBS TYPES":
                system = x[0].strip() or system
                codes.setdefault(system, []).extend(x[7:60].split())
            in_head = x[60:].strip() != "END OF HEADER"
        elif x.startswith(">"):
            when = rinex3.moment(x[1:])
        elif when is not None:
            found = {}
            for i, c in enumerate(codes[x[0]]):
                cell = x[3 + 16 * i : 19 + 16 * i]
                if cell[:14].strip() and not (c[0] == "S" and float(cell[:14]) == 0):
                    at = found.setdefault(c[1:], {})
                    at[c[0]] = float(cell[:14])
                    if c[0] == "L":
                        at |= {"lli": int(cell[14:15].strip() or -1), "ssi": int(cell[15:16].strip() or -1)}
            for signal, v in found.items():
                sid = f"{x[:3]}|{rinex3.BAND_OF_DIGIT[x[0]][signal[0]]}|{signal[1]}"
                out.append((when, sid, v.get("S"), v.get("C"), v.get("L"), v.get("D"), *[None if v.get(k, -1) < 0 else v[k] for k in ("lli", "ssi")]))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(x) for x in df.drop("file").collect()), key=str)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_split_file_gives_every_row_once(spark, tmp_path, end):
    path = written(tmp_path / "a.rnx", GOOD, body(60), end)
    want = plain(open(path).read())
    for split in (997, 4096, 0):
        df = rinex3.read_rinex3(spark, path, split)
        assert rows(df) == want
        assert split == 0 or df.rdd.getNumPartitions() > 3


def test_ranges_of_every_width(monkeypatch, tmp_path):
    monkeypatch.setattr(rinex3, "READ", 61)
    path = written(tmp_path / "a.rnx", GOOD, body(9))
    data = open(path, "rb").read()
    _, begin = rinex3.header_lines(io.BytesIO(data))
    want = data[begin:].split(b"\n>")
    want = [want[0], *[b">" + x for x in want[1:]]]
    for split in range(40, 3000, 71):
        got = []
        for r in ranges.byte_ranges([(path, len(data))], split):
            if r.end > begin:
                got += rinex3.epochs(io.BytesIO(data), max(r.start, begin), r.end)
        assert got == want


def test_filters_reach_the_scan(spark, tmp_path):
    path = written(tmp_path / "a.rnx", GOOD, body(50))
    at = lambda s: START + dt.timedelta(seconds=s)
    whole = rinex3.read_rinex3(spark, path, 2000)
    everything = spark.createDataFrame(whole.collect(), whole.schema)
    for test in (F.col("epoch").between(at(300), at(600)), (F.col("epoch") > at(300)) & (F.col("epoch") < at(360)), F.col("epoch") == at(90), F.col("epoch").isin(at(30), at(60))):
        part = rinex3.scan_once(spark, path, test, 2000)
        plan = part._jdf.queryExecution().executedPlan().toString()
        # nothing of the condition is left for Spark
        assert "Filter (" not in plan and "BatchScan rinex3_once" in plan, plan
        assert rows(part) == rows(everything.where(test)) != []
    # a condition on something else stays with Spark
    part = rinex3.scan_once(spark, path, (F.col("epoch") >= at(900)) & (F.col("snr") > 40))
    assert "Filter (" in part._jdf.queryExecution().executedPlan().toString()
    assert rows(part) == [x for x in rows(everything) if x[0] >= at(900) and x[2] and x[2] > 40]


def test_time_range_of_a_load_holds_in_any_plan(spark, tmp_path):
    path = written(tmp_path / "a.rnx", GOOD, body(50))
    at = lambda s: START + dt.timedelta(seconds=s)
    part = rinex3.read_rinex3(spark, path, 2000, at(300), at(600))
    a, b = part.where(F.col("epoch") == at(330)), part.where(F.col("epoch") == at(360))
    assert rows(a.union(b)) == [x for x in rows(part) if x[0] in (at(330), at(360))] != []
    assert {x[0] for x in rows(part)} == {at(s) for s in range(300, 601, 30)}


def test_an_epoch_outside_is_not_decoded(monkeypatch, tmp_path):
    """Only the mark of an epoch that the filter excludes is looked at."""
    path = written(tmp_path / "a.rnx", GOOD, body(20))
    reader = rinex3._FilteredReader({"path": path})
    assert list(reader.pushFilters([rinex3.D.EqualTo(("epoch",), START)])) == []
    seen = []
    monkeypatch.setattr(rinex3.Columns, "add", lambda self, when, lines: seen.append(when))
    (part,) = reader.partitions()
    list(reader.read(part))
    assert seen == [START]


def test_header(spark, tmp_path):
    written(tmp_path / "a.rnx")
    h = rinex3.read_headers(spark, str(tmp_path)).first()
    assert (h.version, h.file_type, h.system, h.marker_name, h.marker_number, h.agency) == (3.04, "O", "M", "SITE", "7", "a b")
    assert (h.receiver_type, h.receiver_version, h.antenna_type, h.interval, h.leap_seconds, h.time_system) == ("REC", "v2", "ANT", 30.0, 18, "GPS")
    assert h.position == [4075578.0, 931852.0, 4801568.0] and h.first_obs == START and h.last_obs is None
    assert h.codes["G"] == ["C1C", "L1C", "D1C", "S1C"] and len(h.codes["E"]) == 14 and h.code_counts == {"G": 4, "R": 4, "E": 14}
    assert h.slots == {"R01": 1, "R02": -4} and h.biases == {"C1C": -71.94, "C1P": -71.94}
    assert [tuple(x) for x in h.phase_shifts] == [("G", "L1C", 0.25)]


def test_signals_of_a_file(spark, tmp_path):
    written(tmp_path / "a.rnx", [x.replace("G    4 C1C", "G    4 C9C") for x in GOOD])
    found = rinex3.file_signals(rinex3.read_headers(spark, str(tmp_path)), signals.SATELLITES)
    assert found.count() == found.distinct().count() == 32 * 2 + 24 + 36 * 4
    assert found.where("sid = 'G32|UnknownBand9|C'").count() == 1 and found.where("sid = 'E01|E5a|Q'").count() == 1


BROKEN = {
    "version": lambda h: [x.replace("3.04", "2.11") for x in h],
    "required_lines": lambda h: [x for x in h if "MARKER NAME" not in x],
    "known_systems": lambda h: [x.replace("R    4 ", "X    4 ") for x in h],
    "code_format": lambda h: [x.replace("D1C S1C C5Q", "D1C S1C C5 ") for x in h],
    "bands": lambda h: [x.replace("G    4 C1C", "G    4 C7C") for x in h],
    "attributes": lambda h: [x.replace("G    4 C1C", "G    4 C1Q") for x in h],
    "code_counts": lambda h: [x.replace("R    4 ", "R    5 ") for x in h],
    "glonass_slots": lambda h: [x for x in h if "GLONASS SLOT" not in x],
    "glonass_biases": lambda h: [x for x in h if "COD/PHS" not in x],
    "phase_shifts": lambda h: [x.replace("G L1C  0.25", "G L5X  0.25") for x in h],
    "position": lambda h: [x.replace("931852.0000", "         ?") for x in h],
    "first_epoch": lambda h: [x.replace("0    0.0000000     GPS", "7    0.0000000     GPS") for x in h],
    "last_epoch": lambda h: [*h[:-1], line("  2024     1     1     9     0    0.0000000     GPS", "TIME OF LAST OBS"), h[-1]],
}


def test_every_rule_passes_and_fails(spark, tmp_path):
    ok = [*epoch(0, [row("G01", (2e7, "  "), (1e8, "  "), (1.0, "  "), (45.0, "  "))])]
    written(tmp_path / "good.rnx", GOOD, ok)
    for name, change in BROKEN.items():
        written(tmp_path / f"{name}.rnx", change(GOOD), ok)
    written(tmp_path / "ranges.rnx", GOOD, epoch(0, [row("G01", (2.0, "  "))]))
    written(tmp_path / "strengths.rnx", GOOD, epoch(0, [row("G01", (2e7, "  "), (1e8, "  "), (1.0, "  "), (99.0, "  "))]))
    written(tmp_path / "known_bands.rnx", [x.replace("R    4 C1C", "R    4 C8C") for x in GOOD], epoch(0, [row("R01", (2e7, "  "))]))
    written(tmp_path / "empty.rnx")
    out = headers.header_conformance(rinex3.read_headers(spark, str(tmp_path)), rinex3.read_rinex3(spark, str(tmp_path)))
    broken = {x.file.split("/")[-1][:-4]: set(x.broken) for x in out.collect()}
    assert broken.pop("good") == broken.pop("empty") == set()
    assert set(broken) == set(headers.rules())
    assert all(name in found for name, found in broken.items()), broken
    assert broken["ranges"] == {"ranges"} and broken["glonass_slots"] == {"glonass_slots"} and broken["attributes"] == {"attributes"}
