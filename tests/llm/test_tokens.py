"""Token operators against the tokenizers library on whole texts."""

import hashlib
import random

import numpy as np
import pytest

from leafray.llm import bpe, token_counts
from leafray.llm.common import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")
PIECES = ["a", "the", " the", "  ", "\n", " \n", "\n\n", "\t", "'s", "'", "?'re", "l'eau", "\u00e9", "\u00df", "\u65e5\u672c", "\u00a0", "\u3000", "\u2028", "\u0085", "\x1c", "\x1f", "<|endoftext|>", "<|endof", "text|>", "12", "3", "!!", "***", "\U0001f600", "qzxj", "\ufb00", "\u0418", "\u200b", "A'", "=", "====", "\r\n", "'ll", "_", "x" * 70]


def texts(seed, n, most):
    r = random.Random(seed)
    return ["".join(r.choice(PIECES) for _ in range(r.randint(0, most))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return token_counts.library(PATH)


def test_fragments_are_encoded_as_the_whole(library):
    s = bpe.Splitter(PATH)
    for t in texts(1, 4000, 40):
        ids = library.encode(t, add_special_tokens=False).ids
        assert s.encode(t).tolist() == ids, repr(t)
        assert s.decode(np.array(ids, np.int64)) == library.decode(ids, skip_special_tokens=False)


def test_small_memo_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 5)
    s = bpe.Splitter(PATH)
    for t in texts(2, 300, 60):
        assert s.encode(t).tolist() == library.encode(t, add_special_tokens=False).ids


def test_invalid_ids_decode_as_in_the_library(library):
    s, r = bpe.Splitter(PATH), random.Random(3)
    for _ in range(2000):
        ids = [r.randrange(50257) for _ in range(r.randint(0, 8))]
        assert s.decode(np.array(ids, np.int64)) == library.decode(ids, skip_special_tokens=False)


EDGE = [(1, None), (2, ""), (3, "one two"), (3, "one two"), (None, " \n "), (5, "wo<|endoftext|>rd " * 900), (6, "x" * 5000), (7, " " * 3000 + "a"), (8, "\u00e9\u3000" * 2000)]


def rows(spark, data):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in data], "doc_id long, text string, n_tokens int, ids int")


def test_counts_with_tiny_chunks(spark, library):
    data = EDGE + [(100 + i, t) for i, t in enumerate(texts(4, 60, 900))]
    got = token_counts.count_tokens(spark, rows(spark, data), PATH, chunk=200, overlap=40).collect()
    expected = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in data]
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted((tuple(x) for x in got), key=key) == sorted(expected, key=key)


def test_round_trip_and_columns(spark, library):
    data = EDGE + [(100 + i, t) for i, t in enumerate(texts(5, 60, 60))]
    got = sorted((tuple(x) for x in bpe.round_trip(rows(spark, data), PATH).collect()), key=str)
    expected = []
    for i, t in data:
        ids = library.encode(t or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        expected.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert got == sorted(expected, key=str)
    whole = bpe.decode(bpe.encode(rows(spark, data), PATH), PATH).collect()
    assert {(x.doc_id, x.decoded) for x in whole} == {(i, t or "") for i, t in data}


def test_empty_tables(spark):
    empty = rows(spark, [])
    assert token_counts.count_tokens(spark, empty, PATH).count() == 0
    assert bpe.round_trip(empty, PATH).count() == 0


def test_files_that_widen_tokens_are_refused(tmp_path):
    import json

    with open(tokenizer_path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    spec["added_tokens"] = [t | {"lstrip": True} for t in spec["added_tokens"]]
    (tmp_path / "t.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        bpe.Splitter(str(tmp_path / "t.json"))
