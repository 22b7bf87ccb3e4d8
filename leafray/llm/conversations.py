"""Repair of the structure of conversations: the cheapest edits to system?(user assistant)+, or to nothing.

The edits of a conversation are a shortest path through its rows in four states
(nothing yet, after system, after user, after assistant). Costs are followed
backwards: per row a vector of the cost from each state to the end. Rows are
dealt in order, by ranges, so a conversation may lie over several tasks. Each
task starts its part from a guessed vector (parallel Viterbi by rank
convergence): after few rows, vectors from any start differ only by a constant,
and costs are kept as such a vector and a constant. Where the guess and the
vector that the next part really begins with differ by more, fix-up passes run
the part again, only until both agree. The parts' constants add up to the whole
cost, and their backward costs tell at every row which edits are cheapest; the
first of them in ASCII order gives the least audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafray.llm.common import join_counted, materialize, shared_dir, sieved

#: Rows and bytes of text of a part, about.
ROWS, BYTES = 20_000, 64 << 20
#: The characters that separate words, without which a text is blank.
SPACES = " \t\n\v\f\r"

# Costs of the edits.
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
# States: nothing yet, after system, after user, after assistant. What may follow is the user, but after the user the assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
_TURN = (USER, USER, ASSISTANT, USER)
_NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Where keeping a row leads, by the state and the row's initial.
_KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
INITIALS, FAULTS = "sua?", ("", "gone", "truncated")
#: Costs from each state to the end of a conversation, without rows, and the plan that goes with them.
END, END_PLANS = (0, 2 * INSERT, INSERT, 0), ("", "ua", "a", "")

# A plan tells what becomes of a row: D deleted, K kept, U or A with a new role; u or a are inserted before it (or after the last).
AUDIT = str.maketrans("uaUA", "IIRR")
Vector = tuple[int, int, int, int]


@lru_cache(maxsize=None)
def step(symbol: int, after: Vector) -> tuple[Vector, int, tuple[tuple[str, int], ...]]:
    """Costs before a row from those ``after`` it: a vector whose least cost is 0, what was taken off it, and the plan and next state from each state.

    A symbol is an initial's place in INITIALS and four times a fault's in FAULTS.
    """
    initial, fault = INITIALS[symbol % 4], FAULTS[symbol // 4]
    more = TRUNCATED if fault == "truncated" else 0

    def kept(s: int) -> int | None:
        return None if fault == "gone" or (s, initial) not in _KEPT else more + after[_KEPT[s, initial]]

    def reroled(s: int) -> int | None:
        return None if fault == "gone" else more + REROLE + after[_TURN[s]]

    cost = [min(c for c in (DELETE + after[s], kept(s), reroled(s)) if c is not None) for s in range(4)]
    for _ in range(2):
        cost = [min(cost[s], INSERT + cost[_TURN[s]]) for s in range(4)]

    def plan(s: int) -> tuple[str, int]:
        # in the order of the audit's letters, so the first that costs no more is the least
        if cost[s] == DELETE + after[s]:
            return "D", s
        if cost[s] == INSERT + cost[_TURN[s]]:
            rest, to = plan(_TURN[s])
            return _NAMES[_TURN[s]][0] + rest, to
        if cost[s] == kept(s):
            return "K", _KEPT[s, initial]
        return _NAMES[_TURN[s]][0].upper(), _TURN[s]

    plans = tuple(plan(s) for s in range(4))
    least = min(cost)
    return tuple(c - least for c in cost), least, plans


def backward(symbols: bytes, after: Vector) -> tuple[Vector, int]:
    """The vector before all rows, and the constant that belongs to it."""
    off = 0
    for x in reversed(symbols):
        after, least, _ = step(x, after)
        off += least
    return after, off


def fixed(symbols: bytes, guessed: Vector, after: Vector, begin: Vector, off: int) -> tuple[Vector, int]:
    """``backward`` from ``after``, given what it gave from ``guessed``: runs only until the two agree."""
    off_guessed = off_after = 0
    for x in reversed(symbols):
        if guessed == after:
            return begin, off - off_guessed + off_after
        guessed, least, _ = step(x, guessed)
        off_guessed += least
        after, least, _ = step(x, after)
        off_after += least
    return after, off_after


def traced(symbols: bytes, after: Vector, state: int, last: bool) -> tuple[list[str], int]:
    """The plan of each row when the rows are entered in ``state``, and the state in which they are left."""
    choices = []
    for x in reversed(symbols):
        after, _, plans = step(x, after)
        choices.append(plans)
    out = []
    for plans in reversed(choices):
        text, state = plans[state]
        out.append(text)
    if last and out:
        out[-1] += END_PLANS[state]
    return out, state


def lines(plan: str, role: str, text: str) -> list[tuple[str, str]]:
    """Roles and texts that a row's plan leaves."""
    new = {"u": ("user", ""), "a": ("assistant", ""), "K": (role, text), "U": ("user", text), "A": ("assistant", text)}
    return [new[c] for c in plan if c != "D"]


class Digest:
    """SHA-256 of ``role:text`` lines as they come."""

    def __init__(self):
        self.sha, self.begun = hashlib.sha256(), False

    def add(self, plan: str, role: str, text: str) -> None:
        for r, t in lines(plan, role, text):
            self.sha.update(f"{'\n' if self.begun else ''}{r}:{t}".encode())
            self.begun = True


_KINDS = {"boolean": pa.bool_(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}


def _arrow(ddl: str) -> pa.Schema:
    return pa.schema([(n, _KINDS[k]) for n, k in (f.split() for f in ddl.split(", "))])


_PART = (
    "key string, part long, whole boolean, rows long, blank long, duplicate long, truncated long, illegal long, turns long, first_turn long, last_turn long, "
    "low long, high long, first_initial string, last_initial string, begin array<int>, off long, audit string, sha string, symbols binary, ids binary, plans string"
)


def _described(key: str, part: int, rows: list[tuple], whole: bool) -> dict:
    """A conversation's part from its rows (turn, role, text, fault, id); a ``whole`` one is solved."""
    turns = [r[0] for r in rows if r[0] is not None]
    initials = [r[1][:1] for r in rows]
    faults = [r[3] for r in rows]
    kind = lambda f: 2 if f == "truncated" else f is not None
    symbols = bytes(("sua".find(i) if i and i in "sua" else 3) + 4 * kind(f) for i, f in zip(initials, faults, strict=True))
    begin, off = backward(symbols, END)
    out = {"key": key, "part": part, "whole": whole, "rows": len(rows), "symbols": symbols, "begin": list(begin), "off": off}
    out |= {f: faults.count(f) for f in ("blank", "duplicate", "truncated")}
    out |= {"illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), "first_initial": initials[0], "last_initial": initials[-1]}
    out |= {"turns": len(set(turns)), "low": min(turns, default=None), "high": max(turns, default=None), "first_turn": rows[0][0], "last_turn": rows[-1][0]}
    out |= {"audit": None, "sha": None, "plans": None, "ids": np.array([r[4] for r in rows], np.int64).tobytes()}
    if whole:
        made, _ = traced(symbols, END, START, True)
        digest = Digest()
        for p, r in zip(made, rows, strict=True):
            digest.add(p, r[1], r[2])
        out |= {"audit": "".join(made).translate(AUDIT), "sha": digest.sha.hexdigest(), "plans": " ".join(made)}
    return out


def _parts(batches: Iterator[pa.RecordBatch], most_rows: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Conversations of a range of rows in order, in parts of bounded size.

    The first and the last one may go on in another range, and a long one is
    cut; the others are whole and done.
    """
    schema = _arrow(_PART)
    number = TaskContext.get().partitionId() << 32
    held, size, key, whole, done = [], 0, None, False, []

    def close(whole: bool) -> None:
        nonlocal held, size, number
        if held:
            done.append(_described(key, number, held, whole))
            held, size, number = [], 0, number + 1

    for batch in batches:
        for k, *row in zip(*(batch.column(c).to_pylist() for c in ("key", "turn", "role", "text", "fault", "id")), strict=True):
            if k != key:
                close(whole)
                # nothing is known of what lies before the range's first row
                whole, key = key is not None, k
            elif len(held) >= most_rows or size >= most_bytes:
                whole = False
                close(whole)
            held.append(row)
            size += len(row[2])
        if len(done) > 1000:
            yield pa.RecordBatch.from_pylist(done, schema)
            done = []
    close(False)
    yield pa.RecordBatch.from_pylist(done, schema)


def _mapped(rows: DataFrame, make: Callable[[dict], list[dict]], ddl: str) -> DataFrame:
    """``make`` of every row of ``rows``, which are parts of bounded size."""
    schema = _arrow(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield pa.RecordBatch.from_pylist(make(batch.slice(i, 1).to_pylist()[0]), schema)

    return rows.mapInArrow(run, ddl)


def _fixed(r: dict) -> list[dict]:
    begin, off = fixed(r["symbols"], tuple(r["used"]), tuple(r["wanted"]), tuple(r["begin"]), r["off"])
    return [{"key": r["key"], "part": r["part"], "begin": list(begin), "off": off, "used": r["wanted"]}]


def _exits(r: dict) -> list[dict]:
    return [{"key": r["key"], "part": r["part"], "exits": [traced(r["symbols"], tuple(r["used"]), s, False)[1] for s in range(4)]}]


def _planned(r: dict) -> list[dict]:
    return [{"key": r["key"], "part": r["part"], "plans": " ".join(traced(r["symbols"], tuple(r["used"]), r["entry"], r["is_last"])[0])}]


def _entries(t: pa.Table) -> pa.Table:
    """The state in which each part of a conversation is entered; there are as many rows as parts, none longer than a few numbers."""
    t = t.sort_by("part")
    state, out = START, []
    for exits in t["exits"].to_pylist():
        out.append(state)
        state = exits[state]
    return pa.table({"key": t["key"], "part": t["part"], "entry": pa.array(out, pa.int64()), "is_last": [i == t.num_rows - 1 for i in range(t.num_rows)]}, schema=_arrow("key string, part long, entry long, is_last boolean"))


def _rerun(parts: DataFrame, root: str) -> DataFrame:
    """Vectors and constants of the open parts, each begun from the vector that the next part begins with; key, part, begin, off, used."""
    end = F.array(*[F.lit(c).cast("int") for c in END])
    symbols = parts.select("key", "part", "symbols")
    now = parts.select("key", "part", "begin", "off", end.alias("used"))
    turn = 0
    while True:
        wanted = F.coalesce(F.lead("begin").over(Window.partitionBy("key").orderBy("part")), end)
        now = materialize(now.withColumn("wanted", wanted), f"{root}/pass{turn}")
        wrong = now.where("wanted <> used")
        if wrong.isEmpty():
            return now.drop("wanted")
        again = _mapped(wrong.join(symbols, ["key", "part"]), _fixed, "key string, part long, begin array<int>, off long, used array<int>")
        now = now.where("wanted = used").drop("wanted").unionByName(again)
        turn += 1


def _open(parts: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """The conversations that lie in several parts, or might: one row each without digest, and their parts with plans."""
    vectors = _rerun(parts, root)
    ready = vectors.select("key", "part", "used").join(parts.select("key", "part", "symbols"), ["key", "part"])
    exits = _mapped(ready, _exits, "key string, part long, exits array<int>")
    entries = exits.groupBy("key").applyInArrow(_entries, "key string, part long, entry long, is_last boolean")
    plans = materialize(_mapped(ready.join(entries, ["key", "part"]), _planned, "key string, part long, plans string"), f"{root}/plans")
    order = Window.partitionBy("key").orderBy("part")
    seam = F.concat(F.lag("last_initial").over(order), F.col("first_initial"))
    facts = parts.drop("plans", "audit", "symbols", "ids", "begin", "off", "sha")
    facts = facts.withColumn("illegal", F.col("illegal") + F.coalesce((~seam.isin("su", "ua", "au")).cast("long"), F.lit(0)))
    facts = facts.withColumn("turns", F.col("turns") - F.coalesce((F.col("first_turn") == F.lag("last_turn").over(order)).cast("long"), F.lit(0)))
    letters = F.translate(F.replace("plans", F.lit(" "), F.lit("")), "uaUA", "IIRR")
    each = facts.join(vectors.select("key", "part", "begin", F.col("off")), ["key", "part"]).join(plans, ["key", "part"])
    summed = [F.sum(c).alias(c) for c in ("rows", "blank", "duplicate", "truncated", "illegal", "turns")]
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", letters.alias("letters")))), lambda x: x["letters"]), "")
    whole = each.groupBy("key").agg(*summed, F.min("low").alias("low"), F.max("high").alias("high"), F.sum("off").alias("off"), F.min_by("begin", "part").alias("begin"), joined.alias("audit"))
    return whole, parts.select("key", "part", "ids").join(plans, ["key", "part"])


def _row_plans(parts: DataFrame) -> DataFrame:
    """Key, place, id and plan of every row of ``parts`` (key, part, ids, plans)."""

    def make(r: dict) -> list[dict]:
        ids = np.frombuffer(r["ids"], np.int64).tolist()
        return [{"key": r["key"], "part": r["part"], "place": i, "id": n, "plan": p} for i, (n, p) in enumerate(zip(ids, r["plans"].split(" "), strict=True))]

    return _mapped(parts, make, "key string, part long, place long, id long, plan string")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each conversation from its rows in order, which are let go as they are read."""
    schema = _arrow("key string, sha string")
    key, digest = None, None
    for batch in batches:
        done = []
        for k, plan, role, text in zip(*(batch.column(c).to_pylist() for c in ("key", "plan", "role", "text")), strict=True):
            if k != key:
                if digest:
                    done.append({"key": key, "sha": digest.sha.hexdigest()})
                key, digest = k, Digest()
            digest.add(plan, role, text)
        yield pa.RecordBatch.from_pylist(done, schema)
    if digest:
        yield pa.RecordBatch.from_pylist([{"key": key, "sha": digest.sha.hexdigest()}], schema)


def key_of(conv_id: Column) -> Column:
    """A conversation's key: its id as text, and one of its own for null."""
    return F.when(conv_id.isNull(), "-").otherwise(F.concat(F.lit("="), conv_id.cast("string")))


def _faulted(rows: DataFrame, root: str) -> DataFrame:
    """``rows`` with the first fault of each: blank, duplicate (of an earlier row of its conversation), truncated, or null."""
    found = rows.groupBy("same").agg(F.min(F.struct("turn", "id")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    found = materialize(found, f"{root}/repeated")
    marked = sieved(rows, [F.hex("same")], found, [F.hex("same")])
    alone = marked.where("not maybe_").drop("maybe_").withColumn("again", F.lit(False))
    met = marked.where("maybe_").drop("maybe_")
    total = rows.count()
    again = join_counted(met, found, "same", "n", total).withColumn("again", F.struct("turn", "id") != F.col("first")).drop("first", "n")
    # what the sieve let pass without need
    rest = met.join(found.select("same"), "same", "left_anti").withColumn("again", F.lit(False))
    stripped = F.rtrim("text", F.lit(SPACES))
    fault = F.when(stripped == "", "blank").when(F.col("again"), "duplicate").when(~F.right(stripped, F.lit(1)).isin(".", "!", "?"), "truncated")
    return alone.unionByName(again).unionByName(rest).withColumn("fault", fault)


def _solved(spark: SparkSession, conversations: DataFrame) -> tuple[DataFrame, DataFrame, str]:
    """Rows with ids, and the parts of all conversations, written."""
    root = shared_dir(spark, "conversations")
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(key_of(F.col("conv_id")).alias("key"), F.col("turn").cast("long").alias("turn"), filled("role").alias("role"), filled("text").alias("text"))
    # lengths first, so that no two rows run together
    same = F.concat_ws(":", F.length("key"), F.length("role"), F.concat("key", "role", "text"))
    rows = rows.withColumn("same", F.unhex(F.sha2(same, 256))).withColumn("id", F.monotonically_increasing_id())
    rows = materialize(rows, f"{root}/rows")
    order = ["key", F.asc_nulls_first("turn"), "role", "same", "id"]
    ranges = min(20_000, -(-rows.count() // ROWS)) or 1
    dealt = _faulted(rows, root).repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    cut = partial(_parts, most_rows=ROWS, most_bytes=BYTES)
    parts = dealt.select("key", "turn", "role", "text", "fault", "id").mapInArrow(cut, _PART)
    return rows, materialize(parts, f"{root}/parts"), root


def repaired(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The cheapest repair of each conversation of ``conversations`` (conv_id, turn, role, text): one row per conversation.

    Rows are taken by turn, null first; rows of one turn by role, and equal ones
    next to each other. Null roles and texts count as one space, and a null
    conv_id is a conversation. A row's first fault counts: blank (white space
    at most), duplicate (its role and text came earlier in the conversation),
    truncated (it doesn't end in a full stop, exclamation or question mark).
    Keeping a row costs 0, a new role 1, deleting 2 (blank and duplicate rows
    must go), a new empty row 5, and a truncated row that stays 5 more. The
    cheapest edits give system?(user assistant)+ by the roles' initials, or
    nothing; of equally cheap ones those whose letters (D, I, K, R) are least.

    Returns conv_id, rows, gaps (turns missing between the first and the last),
    blank, duplicate, truncated, illegal (neighbours that may not follow each
    other), cost, audit (the letters) and repaired_sha256 (of ``role:text``
    lines). An empty role has no initial and can't stay. Other columns are
    ignored. An empty table gives an empty result.
    """
    rows, parts, root = _solved(spark, conversations)
    done = parts.where("whole").select("key", "rows", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "off", "begin", "audit", "sha")
    several, planned = _open(parts.where("not whole"), root)
    texts = sieved(rows, [F.col("key")], planned, [F.col("key")]).where("maybe_").select("id", "role", "text")
    # one stream per conversation: a digest can only be taken in order, but no task holds more than a row of it
    lined = _row_plans(planned).join(texts, "id").repartition("key").sortWithinPartitions("key", "part", "place")
    digests = lined.select("key", "plan", "role", "text").mapInArrow(_digests, "key string, sha string")
    out = done.unionByName(several.join(digests, "key").select(*done.columns))
    whole = lambda c: F.col(c).cast("decimal(20,0)")
    # least passes over nulls, so null turns are told apart
    gaps = F.least(whole("high") - whole("low") + 1 - F.col("turns"), F.lit(2**63 - 1).cast("decimal(20,0)"))
    gaps = F.when(F.col("low").isNull(), 0).otherwise(gaps).cast("long")
    kind = conversations.schema["conv_id"].dataType
    return out.select(
        F.when(F.col("key") != "-", F.substring("key", 2, 2**31 - 1)).cast(kind).alias("conv_id"),
        "rows",
        gaps.alias("gaps"),
        "blank",
        "duplicate",
        "truncated",
        "illegal",
        (F.col("off") + F.col("begin")[START]).cast("long").alias("cost"),
        "audit",
        F.col("sha").alias("repaired_sha256"),
    )


def repaired_rows(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: conv_id, part, place and line (order within one), edit (K, R or I), role, text."""
    rows, parts, root = _solved(spark, conversations)
    _, planned = _open(parts.where("not whole"), root)
    planned = parts.where("whole").select("key", "part", "ids", "plans").unionByName(planned)
    kept = _row_plans(planned).join(rows.select("id", "role", "text"), "id")
    each = kept.select("key", "part", "place", "role", "text", F.posexplode(F.split("plan", "")).alias("line", "letter")).where("letter not in ('D', '')")
    new = F.when(F.lower("letter") == "u", "user").when(F.lower("letter") == "a", "assistant")
    kind = conversations.schema["conv_id"].dataType
    return each.select(
        F.when(F.col("key") != "-", F.substring("key", 2, 2**31 - 1)).cast(kind).alias("conv_id"),
        "part",
        "place",
        "line",
        F.translate("letter", "uaUA", "IIRR").alias("edit"),
        F.coalesce(new, F.col("role")).alias("role"),
        F.when(F.col("letter").isin("u", "a"), "").otherwise(F.col("text")).alias("text"),
    )
