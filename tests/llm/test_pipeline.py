"""Dedup stages of the pipeline against brute force, with null and repeated ids."""

import re

import corpus_pipeline
from test_minhash import shingle_set

BASE = " ".join(f"w{i}" for i in range(60))


def brute(data):
    """One row of each group of equal texts, then one of each component: the smallest id, null last."""
    order = lambda i: (data[i][0] is None, data[i][0] or 0)
    first = {}
    for i in sorted(range(len(data)), key=order):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", data[i][1] or ""), i)
    left = sorted(first.values())
    sets, group = {i: shingle_set(data[i][1]) for i in left}, {i: i for i in left}
    for i in left:
        for j in left:
            x = len(sets[i] & sets[j])
            if x and 100 * x >= 75 * (len(sets[i]) + len(sets[j]) - x):
                group = {k: group[i] if g == group[j] else g for k, g in group.items()}
    return sorted((data[min((k for k in left if group[k] == g), key=order)] for g in set(group.values())), key=str)


def test_dedup_stages(spark):
    data = [(1, BASE), (None, BASE + " more"), (None, "a clean text that nothing else resembles"), (None, "another one of those, quite on its own")]
    data += [(2, "its id comes twice but this text is alone"), (2, BASE + " tail"), (9, BASE.upper() + "\n"), (None, None), (7, "same words here again"), (7, "same words here again")]
    data += [(None, " ".join(f"v{i}" for i in range(60 + k))) for k in range(2)]
    table = spark.createDataFrame([(t, d, "x") for d, t in data], "text string, doc_id long, text_sha string")
    out = corpus_pipeline.drop_near_copies(spark, corpus_pipeline.drop_copies(spark, table, ""), "")
    assert out.columns == table.columns
    got, want = sorted(((x.doc_id, x.text) for x in out.collect()), key=str), brute(data)
    # of near copies without an id, either may stay
    assert [(d, t if t is None or d is not None or t[0] != "v" else "v") for d, t in got] == [(d, t if t is None or d is not None or t[0] != "v" else "v") for d, t in want]


def test_near_dedup_keeps_one_of_repeated_rows(spark):
    table = spark.createDataFrame([(3, BASE), (3, BASE), (5, BASE + " x"), (None, "other words"), (None, "and some more")], "doc_id long, text string")
    got = sorted(((x.doc_id, x.text) for x in corpus_pipeline.drop_near_copies(spark, table, "").collect()), key=str)
    assert got == sorted([(3, BASE), (None, "other words"), (None, "and some more")], key=str)


def odd_documents():
    """Null, empty and very long texts, ties, repeats, null ids and languages, and columns that clash with inner names."""
    clean = [(i, f"a calm text about place {i} and the weather of day {i * 7} in that place", "en", f"s{i % 3}") for i in range(120)]
    odd = [(150, None, "en", "s0"), (151, "", None, None), (152, " \n", "en", None), (None, "no id here but words all the same", "fr", "s1"), (None, "no id here but words all the same", "fr", "s1")]
    odd += [(153, "very long " * 20_000, "en", "s1"), (154, BASE, "en", "s1"), (155, BASE, "en", "s2"), (155, BASE, "en", "s2"), (156, BASE + " tail", None, "s2")]
    toxic = [(200 + i, f"zork zonk blargh zork zonk {i} zork blargh", "en", "s0") for i in range(80)]
    return [(*d, 7, "x", 1.5) for d in clean + odd + toxic]


def write(spark, path, data):
    kinds = "doc_id long, text string, lang string, source string, node int, ids string, score double"
    spark.createDataFrame(data, kinds).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i >= 200)) for i in range(280) if i < 120 or i >= 200], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")


def test_every_stage_on_odd_documents(spark, tmp_path):
    from tokenizers import Tokenizer

    from leafray.llm.common import tokenizer_path

    write(spark, tmp_path, odd_documents())
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, key = docs.columns, lambda x: (x.doc_id, x.text)
    seen = {"start": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs.collect()
        assert docs.columns == columns or name == "encode"
    whole = {name: sorted(map(key, rows), key=str) for name, rows in seen.items() if name != "encode"}
    assert whole["toxicity"] == sorted((key(x) for x in seen["start"] if not 200 <= (x.doc_id or 0)), key=str)
    assert sorted(whole["near_dedup"], key=str) == brute(whole["toxicity"])
    words = {k[0]: (k[1] or "").split() for k in whole["near_dedup"]}
    assert {k[0] for k in whole["mixing"]} <= {d for d, w in words.items() if w}
    assert all(t.split() == words[d][: len(t.split())] for d, t in whole["mixing"])
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    want = sorted((d, library.encode(t, add_special_tokens=False).ids) for d, t in whole["mixing"] if d is not None)
    assert sorted((x.doc_id, x.ids) for x in seen["encode"] if x.doc_id is not None) == want
    assert all(x.round_trip and x.n_tokens == len(x.ids) and x.node == 7 for x in seen["encode"])
    assert len(corpus_pipeline.run(spark, str(tmp_path)).collect()) == len(seen["encode"])


def test_empty_documents(spark, tmp_path):
    write(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
