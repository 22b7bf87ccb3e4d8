"""MinHash near-dedup against all pairs of full sets."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from leafray.llm import minhash, words


def shingle_set(text):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(data, threshold=75):
    sets = [shingle_set(t) for _, t in data]
    group = list(range(len(data)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            x = len(a & sets[j])
            if x and 100 * x >= threshold * (len(a) + len(sets[j]) - x):
                group[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(data):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, len(sets[i]), low.get(find(i)), d == low.get(find(i))) for i, (d, _) in enumerate(data)), key=str)


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(1, 5)))
    texts = []
    for _ in range(25):
        base = [word() for _ in range(r.randint(1, 160))]
        texts.append(base)
        for _ in range(r.choice([0, 1, 3, 25])):
            copy = list(base)
            for _ in range(r.randint(0, 1 + len(base) // 14)):
                k = r.randrange(len(copy))
                copy[k : k + 1] = r.choice([[], [word()], [copy[k], word()]])
                copy = copy or ["z"]
            texts.append(copy)
    out = [(r.choice([" ", "  ", "\n"]).join(t).title() if r.random() < 0.3 else " ".join(t)) for t in texts]
    out += ["one two", "One Two", "one", "", None, " \t", "one two three four", "w " * 30000, "w " * 40]
    ids = r.sample(range(10_000), len(out))
    data = list(zip(ids, out))
    return data + [data[3], data[3], (None, out[0]), (None, "quite alone here")]


def test_against_all_pairs(spark):
    for seed in (1, 2):
        data = corpus(seed)
        table = spark.createDataFrame([(d, t, 1, "k") for d, t in data], "doc_id long, text string, node int, key string")
        got = sorted(((x.doc_id, x.n_shingles, x.component_id, x.kept) for x in minhash.near_copies(spark, table).collect()), key=str)
        expected = [(a, b, c, d if a is not None else c is None) for a, b, c, d in brute(data)]
        assert got == sorted(expected, key=str)


def test_drop_keeps_one_of_each(spark):
    data = [(i, t) for i, t in corpus(3) if i is not None]
    table = spark.createDataFrame([(t, d, "x") for d, t in data], "text string, doc_id long, node string")
    out = minhash.drop_near_copies(spark, table)
    assert out.columns == table.columns
    assert {x.doc_id for x in out.collect()} == {d for d, _, c, _ in brute(data) if d == c}


def test_empty(spark):
    table = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_copies(spark, table).count() == 0
    assert minhash.drop_near_copies(spark, table).count() == 0


def test_estimate_corrects_for_chance(spark):
    r = np.random.default_rng(0)
    for share in (0.0, 0.5, 0.75, 1.0):
        both = r.integers(0, 2**63, 3000, dtype=np.uint64)
        n = int(3000 * 2 * share / (1 + share))
        other = np.concatenate([both[:n], r.integers(0, 2**63, 3000 - n, dtype=np.uint64)])
        bits = [minhash.packed(minhash.minima(words.mixed(x))[None])[0].tolist() for x in (both, other)]
        row = spark.createDataFrame([tuple(bits)], "a array<long>, b array<long>").select(minhash.estimate(F.col("a"), F.col("b"))).first()
        assert abs(row[0] - 100 * share) < 18


def test_many_null_and_repeated_ids(spark):
    """Rows that share an id, or have none, don't all meet each other."""
    text = "concat_ws(' ', transform(sequence(1, 12), x -> concat('w', hash(id div 2, x))), if(id % 2 = 0, 'a', 'b'))"
    docs = spark.range(20_000).selectExpr("case when id % 4 < 2 then 7 end as doc_id", f"{text} as text")
    assert minhash.near_copies(spark, docs).groupBy("component").count().where("count = 2").count() == 10_000
