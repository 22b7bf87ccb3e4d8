"""Near-duplicate vectors by hierarchical navigable small-world graphs.

Vectors of one label are dealt to shards of bounded size. Each shard's graph is
built once and written; every vector queries every shard of its label, in blocks
that are dealt over the cluster. A query that finds its beam full of links goes
on along the links of what it found, so that no dense neighbourhood is cut off;
and a block's beams widen until an audit of seeded queries against brute force
finds the wanted share of true links, over all and on average per query. Links
are verified by cosine in double precision on the original values.

A link counts at both ends whichever of the two found it: each end adds up a
print of its links as found from there, and vectors whose two sums differ are
compared with their whole label once more, exactly.

Equal vectors are one node with a number of copies. A block of queries returns
one count per query and the links that join its components (a spanning forest),
not all pairs.
"""

from __future__ import annotations

import io
from heapq import heappop, heappush, heapreplace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafray.llm import words
from leafray.llm.common import components, join_counted, materialize, shared_dir

THRESHOLD = 0.98
#: Nodes of a shard, and least and most queries of a block; a label has eight blocks or more where it can.
SHARD, LEAST_QUERIES, MOST_QUERIES = 8_000, 500, 8_000
#: Links per node and layer (twice as many on the lowest), beam while building, first beam of queries.
LINKS, BUILD_BEAM, BEAM = 10, 40, 32
#: How far below the threshold links are followed where a beam is full, for the first beam; it widens with the beam.
REACH = 0.01
#: Share of true links that an audit of so many queries must find.
AUDIT_RECALL, AUDIT = 0.995, 100


class Graph:
    """A navigable small-world graph over unit rows; built in row order, levels from a seed."""

    def __init__(self, x: np.ndarray, seed: int = 3):
        self.x = np.ascontiguousarray(x, np.float32)
        self.layers: list[dict[int, list[int]]] = []
        self.top = -1
        levels = (-np.log(np.random.default_rng(seed).random(len(x)) + 1e-300) / np.log(LINKS)).astype(int)
        for i, level in enumerate(levels.tolist()):
            self._insert(i, min(level, 12))
        self._reconnect()

    def _reconnect(self) -> None:
        """Pruning can leave a node that no path leads to; link it back from its own neighbours, or from the top."""
        links, reached, todo = self.layers[0] if self.layers else {}, set(), [self.top]
        while len(reached) < len(links):
            while todo:
                if (v := todo.pop()) not in reached:
                    reached.add(v)
                    todo.extend(links[v])
            lost = [v for v in links if v not in reached]
            todo = [v for v in lost if any(w in reached for w in links[v])] or lost[:1]
            for v in todo:
                for w in [w for w in links[v] if w in reached] or [self.top]:
                    links[w].append(v)

    def _beam(self, q: np.ndarray, entries: list[int], width: int, layer: int) -> list[tuple[float, int]]:
        links, x = self.layers[layer], self.x
        seen = set(entries)
        start = list(zip((x[entries] @ q).tolist(), entries, strict=True))
        todo, best = [], []
        for s, e in start:
            heappush(todo, (-s, e))
            heappush(best, (s, e))
        while todo:
            s, c = heappop(todo)
            if len(best) >= width and -s < best[0][0]:
                break
            new = [n for n in links[c] if n not in seen]
            if not new:
                continue
            seen.update(new)
            for s2, n in zip((x[new] @ q).tolist(), new, strict=True):
                if len(best) < width:
                    heappush(best, (s2, n))
                    heappush(todo, (-s2, n))
                elif s2 > best[0][0]:
                    heapreplace(best, (s2, n))
                    heappush(todo, (-s2, n))
        return best

    def _diverse(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """Neighbours none of which is closer to one chosen before than to the node; filled up with the nearest."""
        found = sorted(found, reverse=True)
        if len(found) <= most:
            return [n for _, n in found]
        ids = [n for _, n in found]
        among = self.x[ids] @ self.x[ids].T
        chosen: list[int] = []
        for k, (s, _) in enumerate(found):
            if len(chosen) < most and (not chosen or among[k, chosen].max() < s):
                chosen.append(k)
        rest = [k for k in range(len(found)) if k not in set(chosen)]
        return [ids[k] for k in [*chosen, *rest][:most]]

    def _insert(self, i: int, level: int) -> None:
        q, entries = self.x[i], [self.top] if self.top >= 0 else []
        for layer in range(len(self.layers) - 1, level, -1):
            entries = [max(self._beam(q, entries, 1, layer))[1]]
        for layer in range(min(level, len(self.layers) - 1), -1, -1):
            found = self._beam(q, entries, BUILD_BEAM, layer)
            links, most = self.layers[layer], LINKS * (1 + (layer == 0))
            links[i] = self._diverse(found, LINKS)
            for n in links[i]:
                links[n].append(i)
                if len(links[n]) > most:
                    links[n] = self._diverse(list(zip((self.x[links[n]] @ self.x[n]).tolist(), links[n], strict=True)), most)
            entries = [n for _, n in found]
        while len(self.layers) <= level:
            self.layers.append({i: []})
            self.top = i

    def near(self, q: np.ndarray, threshold: float, width: int) -> np.ndarray:
        """Rows found whose product with ``q`` may reach ``threshold``."""
        q = q.astype(np.float32)
        entries, low = [self.top], threshold - 1e-4
        for layer in range(len(self.layers) - 1, 0, -1):
            entries = [max(self._beam(q, entries, 1, layer))[1]]
        found = self._beam(q, entries, width, 0)
        hits = np.array([n for s, n in found if s >= low], np.int64)
        if len(hits) < width or width >= len(self.x):
            return hits
        # the beam is full of links: follow the graph as far as it leads, a little below the threshold too
        slack, seen, edge = REACH * width / BEAM, np.zeros(len(self.x), bool), hits
        seen[hits] = True
        out, links = [hits], self.layers[0]
        while len(edge):
            new = np.unique(np.concatenate([links[n] for n in edge.tolist()]))
            new = new[~seen[new]]
            seen[new] = True
            s = self.x[new] @ q
            out.append(new[s >= low])
            edge = new[s >= low - slack]
        return np.concatenate(out)

    def dump(self) -> bytes:
        """The links as arrays; the vectors are kept elsewhere."""
        out, arrays = io.BytesIO(), {"top": np.array([self.top, len(self.layers)])}
        for k, layer in enumerate(self.layers):
            arrays[f"nodes{k}"] = np.array(list(layer), np.int32)
            arrays[f"n{k}"] = np.array([len(v) for v in layer.values()], np.int32)
            arrays[f"links{k}"] = np.array([n for v in layer.values() for n in v], np.int32)
        np.savez(out, **arrays)
        return out.getvalue()

    @classmethod
    def load(cls, x: np.ndarray, data: bytes) -> Graph:
        self, arrays = cls.__new__(cls), np.load(io.BytesIO(data), allow_pickle=False)
        self.x = np.ascontiguousarray(x, np.float32)
        self.top, depth = arrays["top"].tolist()
        self.layers = []
        for k in range(depth):
            cut = np.concatenate([[0], np.cumsum(arrays[f"n{k}"])]).tolist()
            flat = arrays[f"links{k}"].tolist()
            self.layers.append({n: flat[cut[i] : cut[i + 1]] for i, n in enumerate(arrays[f"nodes{k}"].tolist())})
        return self


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by the largest component first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def search_group(graph: Graph, x: np.ndarray, queries: np.ndarray, threshold: float) -> tuple[list[np.ndarray], tuple[int, int]]:
    """For each query (a unit row) the rows of ``x`` within the threshold, and of the audited links how many were met and how many there are."""
    picked = np.random.default_rng(11).permutation(len(queries))[:AUDIT]
    truth = [np.flatnonzero(x @ queries[k] >= threshold) for k in picked]

    def verified(k: int, width: int) -> np.ndarray:
        near = graph.near(queries[k], threshold, width)
        return near[x[near] @ queries[k] >= threshold]

    width, wanted = BEAM, np.array([len(t) for t in truth])
    while True:
        met = np.array([len(np.intersect1d(t, verified(k, width))) for t, k in zip(truth, picked, strict=True)])
        shares = met[wanted > 0] / wanted[wanted > 0]
        if not wanted.sum() or min(met.sum() / wanted.sum(), shares.mean()) >= AUDIT_RECALL or width >= len(x):
            break
        width *= 2
    return [verified(k, width) for k in range(len(queries))], (int(met.sum()), int(wanted.sum()))


def search_all(x: np.ndarray, queries: np.ndarray, threshold: float) -> list[np.ndarray]:
    """The same by comparison with every row."""
    return [np.flatnonzero(x @ q >= threshold) for q in queries]


def _forest(a: list[int], b: list[np.ndarray]) -> list[tuple[int, int]]:
    """Of links from a[i] to each of b[i], those that join two components."""
    up: dict[int, int] = {}

    def root(v: int) -> int:
        while (w := up.get(v, v)) != v:
            up[v] = up.get(w, w)
            v = w
        return v

    out = []
    for v, others in zip(a, b, strict=True):
        for w in others.tolist():
            if (r := root(v)) != (s := root(w)):
                up[max(r, s)] = min(r, s)
                out.append((v, w))
    return out


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.stack([np.asarray(v.values, np.float64) for v in column])


def _built(index: DataFrame) -> DataFrame:
    """One row per shard of ``index``: family, shard, nodes, copies, vectors (units), links."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        x = _unit(_matrix(table["embedding"]))
        one = [table["family"][0].as_py(), table["shard"][0].as_py(), table["node"].to_pylist(), table["copies"].to_pylist(), x.tobytes(), Graph(x).dump()]
        ints = pa.list_(pa.int64())
        kinds = [pa.string(), pa.int64(), ints, ints, pa.binary(), pa.binary()]
        return pa.table([pa.array([v], k) for v, k in zip(one, kinds, strict=True)], names=["family", "shard", "nodes", "copies", "vectors", "links"])

    return index.groupBy("family", "shard").applyInArrow(run, "family string, shard long, nodes array<long>, copies array<long>, vectors binary, links binary")


def _prints(a: int, b: np.ndarray) -> np.ndarray:
    """31 bits for each link, the same from both ends."""
    low, high = np.minimum(a, b).astype(np.uint64), np.maximum(a, b).astype(np.uint64)
    return (words.mixed(words.mixed(low) + high) >> np.uint64(33)).astype(np.int64)


def _searched(graphs: DataFrame, queries: DataFrame, threshold: float, exact: bool = False) -> DataFrame:
    """Of each block: rows (node, n, balance), rows (a, b) of its forest and one row (met, wanted) of its audit.

    n is how many copies a query links with in the shard. balance adds the
    prints of links as their queries found them, and takes them off at the
    other end.
    """
    names = ["node", "n", "balance", "a", "b", "met", "wanted"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64())] * len(names), names=names)
        shard = left.select(["nodes", "copies", "vectors", "links"]).to_pylist()[0]
        ids, copies, asked = np.array(shard["nodes"]), np.array(shard["copies"]), right["q_node"].to_numpy()
        x = np.frombuffer(shard["vectors"], np.float64).reshape(len(ids), -1)
        q, audit = _unit(_matrix(right["q_embedding"])), (0, 0)
        if exact:
            found = search_all(x, q, threshold)
        else:
            found, audit = search_group(Graph.load(x, shard["links"]), x, q, threshold)
        other = [f[ids[f] != v] for f, v in zip(found, asked, strict=True)]
        ends = [_prints(int(v), ids[f]) for f, v in zip(other, asked, strict=True)]
        met_at, taken = np.unique(np.concatenate(other), return_inverse=True)
        taken = np.bincount(taken, np.concatenate(ends), len(met_at)).astype(np.int64)
        joined = np.array(_forest(asked.tolist(), [ids[f] for f in other]), np.int64).reshape(-1, 2)
        parts = [
            {"node": asked, "n": np.array([copies[f].sum() for f in other], np.int64), "balance": np.array([e.sum() for e in ends], np.int64)},
            {"node": ids[met_at], "balance": -taken},
            {"a": joined[:, 0], "b": joined[:, 1]},
            {"met": np.array([audit[0]]), "wanted": np.array([audit[1]])},
        ]
        sizes = [len(next(iter(p.values()))) for p in parts]
        columns = [pa.concat_arrays([pa.array(p[c], pa.int64()) if c in p else pa.nulls(k, pa.int64()) for p, k in zip(parts, sizes, strict=True)]) for c in names]
        return pa.table(columns, names=names)

    keys = ["family", "shard", "block"]
    # a cogroup wants its sides' columns to differ
    asked = queries.select(*[F.col(c).alias(f"q_{c}") for c in queries.columns])
    return graphs.groupBy(*keys).cogroup(asked.groupBy(*[f"q_{k}" for k in keys])).applyInArrow(run, ", ".join(f"{c} long" for c in names))


def near_vectors(spark: SparkSession, vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept, recall.

    Rows link if their labels are equal and not null, their vectors have the
    same length, and the cosine is at least ``threshold``. Vectors that are
    null, empty or zero, or hold null or non-finite numbers link with nothing.
    Equal vectors of a label link with each other. component_id is the smallest
    vec_id of the component; a null vec_id counts as larger than all. recall is
    the share of true links that all audits together met (1 without any). Other
    columns are ignored. An empty table gives an empty result.
    """
    root = shared_dir(spark, "hnsw")
    value = F.col("embedding")
    finite = F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))) & F.exists(value, lambda v: v != 0)
    usable = F.coalesce(finite & F.col("label").isNotNull(), F.lit(False))
    rows = vectors.select("vec_id", F.col("label").cast("string").alias("label"), F.transform("embedding", lambda v: v.cast("double")).alias("embedding"))
    rows = rows.withColumn("usable", usable).withColumn("row", F.monotonically_increasing_id())
    print_ = F.concat_ws("-", F.xxhash64("label", "embedding"), F.xxhash64("embedding", "label", F.lit(7)))
    rows = materialize(rows.withColumn("print", F.when(F.col("usable"), print_)), f"{root}/rows")
    total = rows.count()
    good = rows.where("usable")
    classes = materialize(good.groupBy("print").agg(F.min("row").alias("node"), F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies")), f"{root}/classes")
    nodes = good.join(classes.select(F.col("node").alias("row"), "copies"), "row")
    nodes = nodes.select(F.col("row").alias("node"), "copies", "embedding", F.concat_ws(":", "label", F.size("embedding")).alias("family"))
    nodes = materialize(nodes, f"{root}/nodes")
    families = nodes.groupBy("family").agg(F.count(F.lit(1)).alias("size"))
    per_block = F.greatest(F.lit(LEAST_QUERIES), F.least(F.lit(MOST_QUERIES), F.col("size") / 8))
    families = families.withColumn("shards", F.ceil(F.col("size") / SHARD)).withColumn("blocks", F.ceil(F.col("size") / per_block))
    families = materialize(families, f"{root}/families")
    placed = join_counted(nodes, families, "family", "size", total)
    span = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    index = placed.withColumn("shard", F.pmod(F.xxhash64("node"), F.col("shards")))
    graphs = materialize(_built(index.select("family", "shard", "node", "copies", "embedding")), f"{root}/graphs")
    spread = graphs.join(families.select("family", "blocks"), "family").withColumn("block", span("blocks"))
    queries = placed.withColumn("block", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks"))).withColumn("shard", span("shards"))
    queries = queries.select("family", "shard", "block", "node", "embedding")
    found = materialize(_searched(spread, queries, threshold), f"{root}/found")
    counts = found.where("node is not null").groupBy("node").agg(F.sum("n").alias("others"), F.sum("balance").alias("balance"))
    counts = materialize(counts, f"{root}/counts")
    lost = counts.where("balance <> 0").select("node")
    links = found.where("a is not null").select("a", "b")
    if not lost.isEmpty():
        again = _searched(spread, queries.join(lost, "node", "left_semi").select(*queries.columns), threshold, exact=True)
        again = materialize(again, f"{root}/again")
        mended = again.where("n is not null").groupBy("node").agg(F.sum("n").alias("mended"))
        counts = counts.join(mended, "node", "left").withColumn("others", F.coalesce("mended", "others"))
        links = links.union(again.where("a is not null").select("a", "b"))
    counts = counts.select("node", "others")
    mapping = components(links, f"{root}/components")
    recall = found.agg(F.coalesce(F.expr("try_divide(sum(met), sum(wanted))"), F.lit(1.0))).first()[0]
    label = classes.join(counts, "node").join(mapping, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = label.groupBy("component").agg(F.min("first_id").alias("component_id"))
    label = materialize(label.join(smallest, "component").select("print", "copies", (F.col("others") + F.col("copies") - 1).alias("n_links"), "component_id"), f"{root}/labels")
    linked = join_counted(good.select("vec_id", "print"), label, "print", "copies", total).select("vec_id", "n_links", "component_id")
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    return out.withColumn("recall", F.lit(recall))
