"""Repaired conversations against a plain search through all edits, in one part and in many."""

import hashlib
import heapq
import random
import re

import pytest

from leafray.llm import conversations


def faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        end = re.search(r"[^\x20\x09-\x0D](?=[\x20\x09-\x0D]*\Z)", text)
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[0] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """Least (cost, audit), by Dijkstra's search over (row, initials' state)."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if i == len(rows) and state in ("", "a"):
            return cost, audit, lines
        if (i, state) in done:
            continue
        done.add((i, state))
        for role in ("user", "assistant"):
            if role[0] in follow[state]:
                heapq.heappush(heap, (cost + 5, audit + "I", i, role[0], (*lines, f"{role}:")))
        if i == len(rows):
            continue
        _, role, text = rows[i]
        heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state, lines))
        if found[i] in (None, "truncated"):
            more = 5 * (found[i] == "truncated")
            if role[:1] and role[:1] in follow[state]:
                heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[0], (*lines, f"{role}:{text}")))
            for new in ("user", "assistant"):
                if new[0] in follow[state]:
                    heapq.heappush(heap, (cost + more + 1, audit + "R", i + 1, new[0], (*lines, f"{new}:{text}")))


def brute(data):
    groups = {}
    for c, turn, role, text in data:
        groups.setdefault(c, []).append((turn, " " if role is None else role, " " if text is None else text))
    out = []
    for c, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        found = faults(rows)
        cost, audit, lines = cheapest(rows, found)
        turns = {r[0] for r in rows if r[0] is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        counts = [found.count(f) for f in ("blank", "duplicate", "truncated")]
        out.append((c, len(rows), max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def table(spark, data):
    return spark.createDataFrame([(t, r, x, c, 0, "k") for c, t, r, x in data], "turn long, role string, text string, conv_id long, id int, key string")


def run(spark, data):
    return sorted((tuple(x) for x in conversations.repaired(spark, table(spark, data)).collect()), key=str)


def conversation(r, c, n):
    role = lambda: r.choice(["user", "assistant"] * 6 + ["system", "User", "tool", "", None])
    # one text per turn, so that the turn gives a full order
    text = lambda t: r.choice([f"said {t}.", f"said {t}!  \n", f"cut {t}", "same?", " \v\f", "", None, f"é…{t}?"])
    return [(c, t if r.random() < 0.97 or t else None, role(), text(t)) for t in sorted(r.sample(range(2 * n + 1), n))]


def corpus(seed, sizes):
    r = random.Random(seed)
    data = [row for c, n in enumerate(sizes) for row in conversation(r, c, n)]
    data += [(None, 1, "user", "a."), (None, 2, "assistant", "b."), (9000, None, "user", "x."), (9001, 5, "system", "x."), (9002, 2**62, "user", "x."), (9002, -(2**62), "user", "y.")]
    data += [(9003, 1, "user", "same.")] * 7 + [(9003, 2, "assistant", "same.")] * 3
    r.shuffle(data)
    return data


def test_against_search(spark):
    data = corpus(1, [1, 2, 3, 4, 5, 6, 7, 8, 9] * 12)
    assert run(spark, data) == brute(data)


@pytest.mark.parametrize(("rows", "size"), [(7, 1 << 20), (40, 60)])
def test_in_many_parts(spark, monkeypatch, rows, size):
    """Long conversations over many tasks and cuts: counts, costs, audits and digests are those of the whole."""
    monkeypatch.setattr(conversations, "ROWS", rows)
    monkeypatch.setattr(conversations, "BYTES", size)
    data = corpus(rows, [300, 3, 3, 150, 0, 1, 1, 80, 5])
    assert run(spark, data) == brute(data)


def test_rows_of_repaired_conversations(spark, monkeypatch):
    monkeypatch.setattr(conversations, "ROWS", 25)
    data = corpus(5, [60, 3, 4, 5, 90])
    found = conversations.repaired_rows(spark, table(spark, data)).collect()
    lines = {}
    for x in sorted(found, key=lambda x: (x.part, x.place, x.line)):
        lines.setdefault(x.conv_id, []).append(f"{x.role}:{x.text}")
    digests = {x[0]: x[-1] for x in brute(data)}
    empty = hashlib.sha256(b"").hexdigest()
    assert {c: hashlib.sha256("\n".join(v).encode()).hexdigest() for c, v in lines.items()} == {c: d for c, d in digests.items() if d != empty}


def test_empty(spark):
    assert run(spark, []) == []
    assert conversations.repaired_rows(spark, table(spark, [])).count() == 0


def test_long_text(spark):
    data = [(1, 0, "user", "w " * 3_000_000 + "."), (1, 1, "assistant", "x" * 4_000_000), (2, 0, "user", "a.")]
    assert run(spark, data) == brute(data)


def test_vectors_agree_after_few_rows():
    """Rank convergence: from any start, vectors soon differ only by a constant, and a pass that stops there gives the same."""
    r = random.Random(4)
    for _ in range(300):
        symbols = bytes(r.choice([0, 1, 1, 1, 2, 2, 2, 3, 4, 5, 9, 10]) for _ in range(r.randint(1, 60)))
        starts = [conversations.END, (0, 0, 0, 0), (5, 0, 5, 0), (0, 5, 0, 5)]
        for a in starts:
            begin, off = conversations.backward(symbols, a)
            for b in starts:
                assert conversations.fixed(symbols, a, b, begin, off) == conversations.backward(symbols, b)
    long = bytes([1, 2] * 5 + [1, 1, 2, 2, 3, 6])
    assert len({conversations.backward(long, a)[0] for a in starts}) == 1


def test_a_conversation_with_most_rows(spark, monkeypatch):
    monkeypatch.setattr(conversations, "ROWS", 500)
    data = [(7, t, "user" if t % 2 == 0 else "assistant", "again." if t % 3 == 0 else f"t{t}.") for t in range(6000)] + [(8, 0, "user", "again.")]
    assert run(spark, data) == brute(data)
