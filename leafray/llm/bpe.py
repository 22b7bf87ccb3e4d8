"""BPE encoding and decoding by forced-boundary splitting.

A byte pair that occurs inside no vocabulary token can never be merged over, so
the place between its bytes is a certain cut. Texts are cut there, fragments
are encoded independently (repeated fragments once), and their ids are
concatenated.

A cut must also leave the pre-tokenizer's matches as they are. Its pattern
looks ahead only, and only at white space, so a cut is used when
  - it lies between whole characters,
  - what stands left of it is not white space (a run of white space gives its
    last character away only when text follows),
  - what stands right of it is not an apostrophe (a fragment that begins with
    one could match a contraction that the whole text does not have).
Texts are first split at the special tokens' strings, as the tokenizers library
does.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from leafray.llm import words

#: Fragments kept in a worker's memo before it starts anew; bounds its memory.
MEMO = 100_000
#: Longest fragment (bytes) that is kept in the memo.
MEMO_BYTES = 64
#: Rows that are decoded at once.
DECODED = 256
#: White space beyond ASCII, as UTF-8, that the pre-tokenizer's pattern knows.
WIDE_SPACE = re.compile("[\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in plain}
    table.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))})
    return table


def forced_cuts(tokens: list[bytes]) -> np.ndarray:
    """For each pair of bytes (256 * left + right): whether a cut between them is certain and safe."""
    inside = np.zeros(65536, bool)
    for t in tokens:
        if len(t) > 1:
            b = np.frombuffer(t, np.uint8).astype(np.int32)
            inside[b[:-1] * 256 + b[1:]] = True
    cut = ~inside.reshape(256, 256)
    cut[[*range(9, 14), *range(28, 33)], :] = False
    cut[:, ord("'")] = False
    cut[:, 0x80:0xC0] = False
    return cut.reshape(-1)


def _prefixed(pre_tokenizer: dict | None) -> bool:
    """Whether any part of a pre-tokenizer puts a space before the text."""
    if not pre_tokenizer:
        return False
    return bool(pre_tokenizer.get("add_prefix_space")) or any(map(_prefixed, pre_tokenizer.get("pretokenizers", [])))


class Splitter:
    """Encoder and decoder for one byte-level BPE file; lives in a worker process."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ["RAYON_NUM_THREADS"] = "1"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        flags = [t["content"] for t in spec["added_tokens"] if any(t.get(f) for f in ("lstrip", "rstrip", "single_word"))]
        if flags or _prefixed(spec.get("pre_tokenizer")) or spec.get("normalizer"):
            raise ValueError(f"{path}: cuts are not proven for normalizers, added spaces or tokens that take in what stands beside them")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        alphabet = byte_of_char()
        by_id = {i: bytes(alphabet[c] for c in t) for t, i in spec["model"]["vocab"].items() if t not in self.special}
        self.cuts = forced_cuts(list(by_id.values()))
        by_id.update({i: t.encode() for t, i in self.special.items()})
        self.bytes_of = np.empty(max(by_id) + 1, object)
        self.bytes_of[:] = b""
        for i, b in by_id.items():
            self.bytes_of[i] = b
        self.memo: dict[bytes, bytes] = {}

    def fragments(self, text: str) -> list[bytes]:
        raw = text.encode()
        b = np.frombuffer(raw, np.uint8)
        at = np.flatnonzero(self.cuts[b[:-1].astype(np.uint16) * np.uint16(256) + b[1:]]) + 1
        if len(at) and not text.isascii():
            wide = [len(text[: m.end()].encode()) for m in WIDE_SPACE.finditer(text)]
            if wide:
                at = at[~np.isin(at, wide)]
        ends = [*at.tolist(), len(raw)]
        return [raw[i:j] for i, j in zip([0, *ends[:-1]], ends, strict=True)]

    def _learn(self, missing: list[bytes]) -> dict[bytes, bytes]:
        encoded = self.library.encode_batch_fast([f.decode() for f in missing], add_special_tokens=False)
        new = {f: np.asarray(e.ids, "<u4").tobytes() for f, e in zip(missing, encoded, strict=True)}
        if len(self.memo) + len(new) > MEMO:
            self.memo.clear()
        self.memo.update((f, i) for f, i in new.items() if len(f) <= MEMO_BYTES)
        return new

    def encode(self, text: str) -> np.ndarray:
        """The ids of ``text`` as little-endian 32-bit integers."""
        out = []
        for k, part in enumerate(self.special_split.split(text) if self.special_split else [text]):
            if k % 2:
                out.append(np.array([self.special[part]], "<u4").tobytes())
            elif part:
                fragments, memo = self.fragments(part), self.memo
                new = self._learn(missing) if (missing := list({f for f in fragments if f not in memo})) else {}
                if new:
                    # the memo may have been emptied to take in the new ones
                    out.append(b"".join([new[f] if f in new else memo[f] if f in memo else self._learn([f])[f] for f in fragments]))
                else:
                    out.append(b"".join([memo[f] for f in fragments]))
        return np.frombuffer(b"".join(out), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(self.bytes_of[ids].tolist()).decode(errors="replace")


@lru_cache(maxsize=4)
def splitter(path: str) -> Splitter:
    return Splitter(path)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with a column ``ids`` (array of int): the tokens of the whole text.

    Null and empty texts have no tokens. A column named like the new one is
    replaced; all others stay. Rows are independent, so nothing is shuffled. An
    empty table gives an empty result.
    """
    from pyspark.sql import types as T

    keep = [c for c in docs.columns if c != ids]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = splitter(path)
        for batch in words.pieces(batches, text):
            found = [s.encode(t or "").astype(np.int32) for t in batch.column(text).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            values = np.concatenate(found) if found else np.empty(0, np.int32)
            column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], column], names=[*keep, ids])

    return docs.select(*[f"`{c}`" for c in keep]).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``encoded`` with a column ``text``: the decoded ids; null ids decode to the empty text, an empty table to an empty result."""
    from pyspark.sql import types as T

    keep = [c for c in encoded.columns if c != text]
    schema = T.StructType([encoded.schema[c] for c in keep] + [T.StructField(text, T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = splitter(path)
        for whole in batches:
            for at in range(0, whole.num_rows, DECODED):
                batch = whole.slice(at, DECODED)
                out = [s.decode(np.asarray(x.values, np.int64) if x.is_valid else np.empty(0, np.int64)) for x in batch.column(ids)]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(out, pa.string())], names=[*keep, text])
            words.release()

    return encoded.select(*[f"`{c}`" for c in keep]).mapInArrow(run, schema)


def encode_checked(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, and n_tokens, ids and round_trip: whether the ids decode to the text.

    One pass, and so one Python worker a task. A null text counts as empty and
    has no ids; columns named like the new ones are replaced; an empty table
    gives an empty result.
    """
    from pyspark.sql import types as T

    new = ["n_tokens", "ids", "round_trip"]
    keep = [c for c in docs.columns if c not in (text, *new)]
    kinds = [T.IntegerType(), T.ArrayType(T.IntegerType(), False), T.BooleanType()]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(c, k, False) for c, k in zip(new, kinds, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = splitter(path)
        for batch in words.pieces(batches, text):
            found, same = [], []
            for t in batch.column(text).to_pylist():
                ids = s.encode(t or "")
                found.append(ids.astype(np.int32))
                same.append(s.decode(ids) == (t or ""))
            n = pa.array([len(x) for x in found], pa.int32())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], n, words.listed(found, pa.int32()), pa.array(same, pa.bool_())], names=[*keep, *new])

    return docs.select(*[f"`{c}`" for c in [*keep, text]]).mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Digests of the tokens and of the text decoded from them: doc_id, n_tokens, ids_sha256, decoded_sha256.

    One pass: ids and decoded text of a batch never leave its task. Null text
    counts as empty; repeated rows give repeated results, an empty table none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = splitter(path)
        for batch in words.pieces(batches, "text"):
            n, ids_sha, text_sha = [], [], []
            for t in batch.column(1).to_pylist():
                ids = s.encode(t or "")
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
                text_sha.append(hashlib.sha256(s.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
