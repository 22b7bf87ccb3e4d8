"""Removal of word passages that an earlier document already has.

Suffix automata of reference shards decide. The reference is not every text: a
passage belongs to it only if it repeats, and only as its first document has
it. Steps:

1. Whole copies. Of documents with the same words, only those of the smallest
   doc_id go on; the words of all others are removed at once.
2. Anchors. Every window of ``window`` words picks the smallest hash among its
   runs of ANCHOR words, so equal windows pick equal anchors, about one anchor
   in eighteen words. Anchors that two documents share mark where a repeat can be.
3. Reference. 128-bit hashes of the windows at shared anchors, reduced to the
   smallest doc_id of each, name the passages that repeat and the document where
   each comes first. Those passages, as words, are dealt to shards of a bounded
   size.
4. Matching. Each shard's passages become a suffix automaton whose states know
   their smallest doc_id. It is sent to every group of documents that share an
   anchor with the shard; they are streamed through it for matching statistics.
   Where the statistic reaches ``window`` in a state of a smaller doc_id, the
   window is removed. Words are compared as words here, so a hash that collides
   cannot remove anything. An anchor that stands in more than WIDE shards (a
   common line amid many passages) would send each of its documents to all of
   them; there the windows' hashes find the one shard that has the window.

Automata of all documents, broadcast to all, would grow with the corpus and
make the work quadratic; here each automaton goes only to the documents that
share an anchor with it, and a shard that many documents need is repeated for
bounded groups of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafray.llm import words
from leafray.llm.common import join_counted, materialize, shared_dir, sieved

WINDOW = 50
#: Words of an anchor.
ANCHOR = 16
#: Words of a reference shard, windows of one reference passage, and words streamed in one group, about.
SHARD, PIECE, GROUP = 40_000, 4_096, 400_000
#: Shards that an anchor may lead to.
WIDE = 8
#: Stands for a null doc_id: no smaller than any.
LAST = 2**63 - 1


class Pieces:
    """A piece's texts with, for each place where a window begins, its anchor and the halves of its 128-bit hash (as int64)."""

    def __init__(self, texts: pa.Array, window: int):
        self.words, self.window = words.Words(texts), window
        self.h = self.words.hashes()
        size = min(ANCHOR, window)
        self.anchors = _smallest(words.runs(self.h, size), window - size + 1).view(np.int64)

    def place(self, i: int) -> slice:
        """The windows of text ``i``."""
        a, b = int(self.words.first[i]), int(self.words.first[i + 1])
        return slice(a, max(a, b - self.window + 1))

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        return words.runs(self.h, self.window).view(np.int64), self.second().view(np.int64)

    def second(self) -> np.ndarray:
        return words.runs(words.mixed(self.h + np.uint64(1)), self.window)


def _smallest(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of the ``width`` values from each place on."""
    if len(x) < width:
        return x[:0]
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :])


def _values(column: pa.Array) -> list[np.ndarray]:
    """A column of lists as arrays; null is empty."""
    return [np.empty(0, np.int64) if v is None else np.asarray(v.values) for v in ((x if x.is_valid else None) for x in column)]


class Automaton:
    """Suffix automaton of several passages of words; each state knows the smallest doc_id of its occurrences."""

    def __init__(self, passages: list[tuple[int, list[bytes]]]):
        self.codes: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [LAST]
        for k, (doc, passage) in enumerate(passages):
            last = 0
            # a code that no other passage has keeps matches from running over the end
            for code in [*(self.codes.setdefault(w, len(self.codes)) for w in passage), -1 - k]:
                last = self._extend(last, code, doc)
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            up = self.link[s]
            if self.first[s] < self.first[up]:
                self.first[up] = self.first[s]

    def _state(self, length: int, moves: dict[int, int], link: int, first: int) -> int:
        self.length.append(length)
        self.next.append(moves)
        self.link.append(link)
        self.first.append(first)
        return len(self.length) - 1

    def _extend(self, last: int, code: int, doc: int) -> int:
        if code in self.next[last]:
            q = self.next[last][code]
            if self.length[q] == self.length[last] + 1:
                self.first[q] = min(self.first[q], doc)
                return q
            clone = self._clone(last, q, code)
            self.first[clone] = min(self.first[clone], doc)
            return clone
        new = self._state(self.length[last] + 1, {}, 0, doc)
        p = last
        while p != -1 and code not in self.next[p]:
            self.next[p][code] = new
            p = self.link[p]
        if p != -1:
            q = self.next[p][code]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, code)
        return new

    def _clone(self, p: int, q: int, code: int) -> int:
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q], LAST)
        self.link[q] = clone
        while p != -1 and self.next[p].get(code) == q:
            self.next[p][code] = clone
            p = self.link[p]
        return clone

    def hits(self, text: list[bytes], doc: int, window: int) -> list[int]:
        """Starts of the windows of ``text`` that occur in a passage of a smaller doc_id."""
        codes, nxt, link, length, first = self.codes, self.next, self.link, self.length, self.first
        out, v, matched = [], 0, 0
        for i, w in enumerate(text):
            c = codes.get(w)
            if c is None:
                v = matched = 0
                continue
            while v and c not in nxt[v]:
                v = link[v]
                matched = length[v]
            if c in nxt[v]:
                v = nxt[v][c]
                matched += 1
            if matched >= window:
                matched = window
                while length[link[v]] >= window:
                    v = link[v]
                if first[v] < doc:
                    out.append(i - window + 1)
        return out


def intervals(starts: list[int], window: int) -> list[tuple[int, int]]:
    """Words covered by windows at sorted ``starts``, as disjoint [begin, end)."""
    out: list[list[int]] = []
    for s in starts:
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s + window)
        else:
            out.append([s, s + window])
    return [(a, b) for a, b in out]


def _survey(docs: DataFrame, window: int) -> DataFrame:
    """row, doc_id, doc (never null), print, n_words, joined_sha (of all words), anchors."""
    names = ["row", "doc_id", "doc", "print"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in words.pieces(batches, "text"):
            p = Pieces(piece.column("text"), window)
            sha = [hashlib.sha256(p.words.joined(i)).digest() for i in range(len(p.words))]
            anchors = words.listed([np.unique(p.anchors[p.place(i)]) for i in range(len(p.words))], pa.int64())
            yield pa.RecordBatch.from_arrays([*[piece.column(c) for c in names], pa.array(p.words.counts(), pa.int64()), pa.array(sha, pa.binary()), anchors], names=[*names, "n_words", "joined_sha", "anchors"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("doc"), F.xxhash64("text").alias("print"), "text")
    return rows.mapInArrow(run, "row long, doc_id long, doc long, print long, n_words long, joined_sha binary, anchors array<long>")


def _texts(docs: DataFrame, wanted: DataFrame, repeats: bool) -> DataFrame:
    """row, doc, anchors, text of the rows in ``wanted`` (row, doc_id, doc, print, joined_sha, anchors).

    Texts are met by id and print, so that rows without an id don't all meet
    each other; with ``repeats``, rows that repeat both are one text first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in words.pieces(batches, "text"):
            w = words.Words(piece.column("text"))
            same = [hashlib.sha256(w.joined(i)).digest() == d for i, d in enumerate(piece.column("joined_sha").to_pylist())]
            yield piece.filter(pa.array(same, pa.bool_())).select(["row", "doc", "anchors", "text"])

    texts = docs.select(F.col("doc_id").alias("id2"), F.xxhash64("text").alias("print2"), "text")
    texts = sieved(texts, [F.col("id2"), F.col("print2")], wanted, [F.col("doc_id"), F.col("print")]).where("maybe_")
    texts = texts.distinct() if repeats else texts
    joined = texts.join(wanted, (F.col("print") == F.col("print2")) & F.col("doc_id").eqNullSafe(F.col("id2")))
    return joined.select("row", "doc", "anchors", "joined_sha", "text").mapInArrow(run, "row long, doc long, anchors array<long>, text string")


def _windows(texts: DataFrame, window: int, *keep: str) -> DataFrame:
    """(h, h2, ``keep``) of every distinct window at the ``anchors`` of (anchors, text, ``keep``: longs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in words.pieces(batches, "text"):
            p = Pieces(piece.column("text"), window)
            h, h2 = p.hashes()
            found = []
            for i, shared in enumerate(_values(piece.column("anchors"))):
                at = p.place(i)
                own = np.flatnonzero(np.isin(p.anchors[at], shared)) + at.start
                found.append(own[np.unique(h[own], return_index=True)[1]])
            at = np.concatenate(found)
            times = [len(f) for f in found]
            kept = [pa.array(piece.column(c).to_numpy(zero_copy_only=False).repeat(times), pa.int64()) for c in keep]
            yield pa.RecordBatch.from_arrays([pa.array(h[at]), pa.array(h2[at]), *kept], names=["h", "h2", *keep])

    return texts.select("anchors", "text", *keep).mapInArrow(run, ", ".join(f"{c} long" for c in ("h", "h2", *keep)))


def _stretches(at: np.ndarray, gap: int) -> list[np.ndarray]:
    """Sorted places, split where the next is more than ``gap`` away."""
    return np.split(at, np.flatnonzero(np.diff(at) > gap) + 1) if len(at) else []


def _passages(first: DataFrame, window: int) -> DataFrame:
    """Reference passages of (row, doc, own, text): row, doc, piece, anchors, n words, passage."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in words.pieces(batches, "text"):
            p, ids = Pieces(piece.column("text"), window), [piece.column(c).to_pylist() for c in ("row", "doc")]
            h, rows, anchors = words.runs(p.h, window).view(np.int64), [], []
            for i, own in enumerate(_values(piece.column("own"))):
                at = p.place(i)
                for found in _stretches(np.flatnonzero(np.isin(h[at], own)) + at.start, 1):
                    for k in range(0, len(found), PIECE):
                        a, b = int(found[k]), int(found[min(k + PIECE, len(found)) - 1])
                        anchors.append(np.unique(p.anchors[a : b + 1]))
                        rows.append((ids[0][i], ids[1][i], (a - at.start) // PIECE, b - a + window, p.words.between(a, b + window).decode()))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            numbers = [pa.array(c, pa.int64()) for c in columns[:4]]
            yield pa.RecordBatch.from_arrays([*numbers, pa.array(columns[4], pa.string()), words.listed(anchors, pa.int64())], names=["row", "doc", "piece", "n", "passage", "anchors"])

    return first.select("row", "doc", "own", "text").mapInArrow(run, "row long, doc long, piece long, n long, passage string, anchors array<long>")


def _queries(routed: DataFrame, window: int) -> DataFrame:
    """What is streamed: (shard, salt, row, doc, start, span) for each run of windows at the route's anchors or with its hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in words.pieces(batches, "text"):
            p, out = Pieces(piece.column("text"), window), []
            h = words.runs(p.h, window).view(np.int64)
            for i, x in enumerate(piece.select(["row", "doc", "routes"]).to_pylist()):
                at = p.place(i)
                for route in x["routes"]:
                    hit = np.isin(p.anchors[at], np.array(route["anchors"], np.int64)) | np.isin(h[at], np.array(route["hashes"], np.int64))
                    for found in _stretches(np.flatnonzero(hit), window):
                        a, b = int(found[0]), int(found[-1])
                        span = p.words.between(at.start + a, at.start + b + window).decode()
                        out.append((route["shard"], route["salt"], x["row"], x["doc"], a, span))
            columns = list(zip(*out, strict=True)) or [()] * 6
            numbers = [pa.array(c, pa.int64()) for c in columns[:5]]
            yield pa.RecordBatch.from_arrays([*numbers, pa.array(columns[5], pa.string())], names=["shard", "salt", "row", "doc", "start", "span"])

    return routed.mapInArrow(run, "shard long, salt long, row long, doc long, start long, span string")


def _matched(reference: DataFrame, queries: DataFrame, window: int) -> DataFrame:
    """Stream each group's spans through its shard's automaton: row, spans (array of begin, end)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("row", pa.int64()), ("begin", pa.int64()), ("end", pa.int64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        machine = Automaton([(d, words.split(p)) for d, p in zip(left["doc"].to_pylist(), left["passage"].to_pylist(), strict=True)])
        rows, begins, ends = [], [], []
        for row, doc, start, span in zip(*[right[c].to_pylist() for c in ("row", "doc", "start", "span")], strict=True):
            for a, b in intervals(machine.hits(words.split(span), doc, window), window):
                rows.append(row)
                begins.append(start + a)
                ends.append(start + b)
        return pa.table([pa.array(rows, pa.int64()), pa.array(begins, pa.int64()), pa.array(ends, pa.int64())], schema=schema)

    grouped = reference.groupBy("shard", "salt").cogroup(queries.groupBy("shard", "salt"))
    found = grouped.applyInArrow(run, "row long, begin long, end long")
    return found.groupBy("row").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))


def _kept(touched: DataFrame, spans: DataFrame) -> DataFrame:
    """row, spans (disjoint, sorted), n_removed, kept_text of the rows that lose words."""
    schema = pa.schema([("row", pa.int64()), ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))), ("n_removed", pa.int64()), ("kept_text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in words.pieces(batches, "text"):
            w, out = words.Words(piece.column("text")), []
            for i, x in enumerate(piece.select(["row", "spans"]).to_pylist()):
                merged: list[list[int]] = []
                for a, b in sorted((s["begin"], s["end"]) for s in x["spans"]):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                out.append({"row": x["row"], "spans": [{"begin": a, "end": b} for a, b in merged], "n_removed": sum(b - a for a, b in merged), "kept_text": w.joined(i, merged).decode()})
            yield pa.RecordBatch.from_pylist(out, schema)

    joined = touched.select("row", "text").join(spans, "row")
    return joined.mapInArrow(run, "row long, spans array<struct<begin:long,end:long>>, n_removed long, kept_text string")


def _salted(row: Column, salts: Column) -> Column:
    return F.pmod(F.xxhash64(row), salts)


def remove_repeats(spark: SparkSession, docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, row, n_words, n_removed, spans, kept_text, joined_sha.

    A word goes if it is covered by ``window`` consecutive words whose sequence
    also starts in a document with a smaller doc_id. ``spans`` are the removed
    [begin, end) word ranges. ``kept_text`` (kept words joined by one space) is
    null where nothing is removed; there joined_sha is the SHA-256 of all words
    so joined. Null text has no words. Rows that repeat a doc_id don't remove
    each other's words; a null doc_id counts as larger than all. Columns other
    than doc_id and text are ignored. An empty table gives an empty result.
    """
    root = shared_dir(spark, "repeats")
    base = materialize(_survey(docs, window), f"{root}/base")
    total = base.count()
    alike = base.where(F.col("n_words") >= window).groupBy("joined_sha").agg(F.min("doc").alias("lead"), F.max("doc").alias("most"), F.count(F.lit(1)).alias("n"))
    alike = materialize(alike.where("lead < most").select("joined_sha", "lead", "n"), f"{root}/alike")
    whole = materialize(join_counted(base.select("row", "doc", "n_words", "joined_sha"), alike, "joined_sha", "n", total).where("lead < doc").select("row", "n_words"), f"{root}/whole")
    lead = materialize(base.join(whole.select("row"), "row", "left_anti"), f"{root}/lead")

    repeats = not lead.groupBy("doc_id", "print").count().where("count > 1").isEmpty()
    anchors = lead.select("row", "doc", F.explode("anchors").alias("anchor"))
    counted = anchors.groupBy("anchor").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.count(F.lit(1)).alias("n"))
    shared = materialize(counted.where("lo < hi").select("anchor", "n"), f"{root}/shared")
    pairs = lead.agg(F.coalesce(F.sum(F.size("anchors")), F.lit(0))).first()[0]
    marked = join_counted(anchors.select("row", "anchor"), shared, "anchor", "n", pairs).groupBy("row").agg(F.collect_set("anchor").alias("anchors"))
    touched = materialize(_texts(docs, lead.drop("anchors", "n_words").join(marked, "row"), repeats), f"{root}/touched")

    first = _windows(touched, window, "doc", "row").groupBy("h", "h2").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.min_by("row", "doc").alias("row"))
    own = first.where("lo < hi").groupBy("row").agg(F.collect_list("h").alias("own"))
    passages = materialize(_passages(touched.select("row", "doc", "text").join(own, "row"), window), f"{root}/passages")
    n_shards = max(1, -(-(passages.agg(F.sum("n")).first()[0] or 0) // SHARD))
    passages = passages.withColumn("shard", F.pmod(F.xxhash64("row", "piece"), F.lit(n_shards)))

    place = passages.select("shard", F.col("doc").alias("lo"), F.explode("anchors").alias("anchor")).groupBy("anchor", "shard").agg(F.min("lo").alias("lo"))
    place = materialize(place, f"{root}/place")
    spread = materialize(place.groupBy("anchor").agg(F.count(F.lit(1)).alias("shards")).join(shared, "anchor"), f"{root}/spread")
    wide = spread.where(F.col("shards") > WIDE).select("anchor", "n")
    narrow = place.join(spread.where(F.col("shards") <= WIDE), "anchor").groupBy("anchor", "n").agg(F.collect_list(F.struct("shard", "lo")).alias("to"))
    narrow = materialize(narrow, f"{root}/narrow")
    of_row = touched.select("row", "doc", F.explode("anchors").alias("anchor"))
    by_anchor = join_counted(of_row, narrow, "anchor", "n", pairs).select("row", "doc", "anchor", F.explode("to").alias("to")).where("to.lo < doc")
    asked = by_anchor.select("row", F.col("to.shard").alias("shard"), "anchor", F.lit(None).cast("long").alias("h"))
    if not wide.isEmpty():
        asked = asked.unionByName(_wide_routes(touched, passages, of_row, wide, pairs, window))
    asked = asked.groupBy("row", "shard").agg(F.collect_set("anchor").alias("anchors"), F.collect_set("h").alias("hashes"))
    asked = materialize(asked, f"{root}/asked")
    salts = asked.groupBy("shard").agg(F.ceil(F.sum(F.size("anchors") * (window + 18) + F.size("hashes") * 2) / GROUP).alias("salts"))
    salts = materialize(salts, f"{root}/salts")
    routes = asked.join(salts, "shard").groupBy("row").agg(F.collect_list(F.struct("shard", _salted(F.col("row"), F.col("salts")).alias("salt"), "anchors", "hashes")).alias("routes"))
    queries = _queries(touched.select("row", "doc", "text").join(routes, "row"), window)
    reference = passages.join(salts, "shard").select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), "doc", "passage")
    kept = _kept(touched, _matched(reference, queries, window))
    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("n_words").alias("end")))
    kept = materialize(kept.unionByName(whole.select("row", all_of_it.alias("spans"), F.col("n_words").alias("n_removed"), F.lit("").alias("kept_text"))), f"{root}/kept")
    return base.join(kept, "row", "left").select("doc_id", "row", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), "spans", "kept_text", "joined_sha")


def _wide_routes(touched: DataFrame, passages: DataFrame, of_row: DataFrame, wide: DataFrame, pairs: int, window: int) -> DataFrame:
    """(row, shard, no anchor, h) for the windows at wide anchors, by the one shard that has the window."""
    at_wide = join_counted(of_row.select("row", "anchor"), wide, "anchor", "n", pairs).groupBy("row").agg(F.collect_set("anchor").alias("anchors"))
    texts = passages.withColumn("anchor", F.explode("anchors")).join(wide, "anchor").groupBy("row", "piece").agg(F.collect_set("anchor").alias("anchors"))
    texts = passages.drop("anchors").join(texts, ["row", "piece"]).select("anchors", F.col("passage").alias("text"), "shard")
    known = _windows(texts, window, "shard").groupBy("h", "h2").agg(F.min("shard").alias("shard"))
    asking = _windows(touched.select("row", "text").join(at_wide, "row"), window, "row")
    return asking.join(known, ["h", "h2"]).select("row", "shard", F.lit(None).cast("long").alias("anchor"), "h")
