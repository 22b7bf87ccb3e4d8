"""Registered queries of the corpus operators, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafray.llm import bpe, conversations, exact_dedup, hnsw, minhash, mixing, mixing_queries, negatives, ngrams, quality, substring_dedup, token_counts, toxicity, warc
from leafray.llm.common import shared_dir, tokenizer_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the production weights: what each contributes of its tokens."""
    return mixing.select_tokens(spark, _table(spark, sf_dir, "documents"), **mixing_queries.production()).drop("print")


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near copies among all documents."""
    marked = minhash.near_copies(spark, _table(spark, sf_dir, "documents"))
    return marked.select("doc_id", "n_shingles", "component_id", "kept")


def _rounded(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_tokens", *[F.round(c, 6).alias(c) for c in ("log_score", "mean_log_score")])


def op3_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text by the counts of all others, three orders."""
    return _rounded(ngrams.scores(spark, _table(spark, sf_dir, "documents"), leave_out=True))


def op3_backoff_trigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text by the counts of all texts, its own among them."""
    return _rounded(ngrams.scores(spark, _table(spark, sf_dir, "documents")))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score of every document, learned from the labels of the training fold."""
    return toxicity.scored(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded, and decoded again."""
    return bpe.round_trip(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text."""
    counted = token_counts.count_tokens(spark, _table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score of every document, learned from the labels of the training fold."""
    return quality.scored(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document when passages that a smaller doc_id has go."""
    found = substring_dedup.remove_repeats(spark, _table(spark, sf_dir, "documents"))
    sha = F.coalesce(F.sha2("kept_text", 256), F.lower(F.hex("joined_sha")))
    return found.select("doc_id", "n_words", "n_removed", sha.alias("kept_sha256"))


def op9_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near copies among all vectors of equal label."""
    found = hnsw.near_vectors(spark, _table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", "component_id", "kept", (F.col("recall") >= 0.99).alias("recall_passed"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts among all documents."""
    marked = exact_dedup.copies(spark, _table(spark, sf_dir, "documents"))
    return marked.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the rows whose vec_id is divisible by 50, against all rows, in units of 1/256."""
    x = lambda v: v.cast("double") * 256
    # from 2^52 on every double is whole
    whole = lambda v: F.when(F.abs(x(v)) < 2.0**52, F.floor(x(v)).cast("double")).otherwise(x(v))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), F.transform("embedding", whole).alias("vector"))
    return negatives.hard_negatives(spark, vectors, F.col("vec_id") % 50 == 0)


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archives and read back by byte ranges."""
    path = shared_dir(spark, "archives")
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", F.col("html").cast("binary").alias("payload"))
    warc.write_archives(spark, pages, path)
    found = warc.read_archives(spark, path)
    return found.select(warc.page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", warc.page_of(F.col("refers_to")).alias("refers_to"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by a hash of conversation and turn, and repaired."""
    own = _table(spark, sf_dir, "conversations")
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    chance = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn"))) % 20
    text = F.when(F.col("chance") == 1, "").when(F.col("chance") == 2, F.regexp_replace(filled("text"), "[.!?]", "")).otherwise(filled("text"))
    role = F.when(F.col("chance") == 4, "user").otherwise(filled("role"))
    rows = own.withColumn("chance", chance).where("chance <> 0")
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.sequence(F.lit(1), F.when(F.col("chance") == 3, 2).otherwise(1))).alias("time"))
    found = conversations.repaired(spark, rows).drop("rows").withColumnRenamed("conv_id", "found_id")
    all_ = own.select("conv_id").distinct()
    out = all_.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


OP10_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""

#: Ends a chain of CTEs that has the rows ``node`` (id, and what is asked for of it) and the links ``edge`` (a, b), both ways:
#: ``low`` is the smallest id that each can reach. Components are small here; on whole corpora this would not end.
_REACHED = """
walk AS (SELECT id, id AS low FROM node UNION SELECT e.b, w.low FROM walk w JOIN edge e ON e.a = w.id WHERE w.low < e.b),
reach AS (SELECT id, min(low) AS low FROM walk GROUP BY id)"""

OP2_SQL = (
    r"""
WITH RECURSIVE w AS (SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT id, hash(array_to_string(list_slice(w, i, least(i + 4, len(w))), ' ')) AS s FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
c AS (SELECT x.id AS a, y.id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.id <> y.id GROUP BY ALL),
edge AS (SELECT c.a, c.b FROM c JOIN n x ON x.id = c.a JOIN n y ON y.id = c.b WHERE 100 * c.c >= 75 * (x.n + y.n - c.c)),
node AS (SELECT w.id, coalesce(n.n, 0) AS n FROM w LEFT JOIN n ON n.id = w.id),"""
    + _REACHED
    + """
SELECT node.id AS doc_id, node.n AS n_shingles, reach.low AS component_id, node.id = reach.low AS kept FROM node JOIN reach ON reach.id = node.id
"""
)

OP8_SQL = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
k AS (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM t),
d AS (SELECT w, row_number() OVER () AS c FROM (SELECT DISTINCT w FROM k)),
g AS (SELECT doc_id, i, list(c) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING) AS g FROM k JOIN d ON d.w = k.w),
h AS (SELECT doc_id, i, hash(g) AS h, hash(list_reverse(g)) AS h2 FROM g WHERE len(g) = 50),
f AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h, h2) AS lo FROM h) WHERE lo < doc_id),
r AS (SELECT k.doc_id, k.i, k.w, coalesce(max(f.i) OVER (PARTITION BY k.doc_id ORDER BY k.i) > k.i - 50, false) AS gone FROM k LEFT JOIN f ON f.doc_id = k.doc_id AND f.i = k.i),
x AS (SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS lost, string_agg(w, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM r GROUP BY doc_id)
SELECT t.doc_id, coalesce(x.n, 0) AS n_words, coalesce(x.lost, 0) AS n_removed, sha256(coalesce(x.kept, '')) AS kept_sha256 FROM t LEFT JOIN x ON x.doc_id = t.doc_id
"""

OP9_SQL = (
    """
WITH RECURSIVE v AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS e FROM embeddings),
u AS (SELECT *, sqrt(list_inner_product(e, e)) AS size FROM v WHERE label IS NOT NULL AND len(list_filter(e, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(e, lambda c: c <> 0)) > 0),
edge AS (SELECT x.id AS a, y.id AS b FROM u x JOIN u y ON x.label = y.label AND x.id <> y.id AND len(x.e) = len(y.e) WHERE list_inner_product(x.e, y.e) / (x.size * y.size) >= 0.98),
node AS (SELECT id FROM v),"""
    + _REACHED
    + """
SELECT node.id AS vec_id, (SELECT count(*) FROM edge WHERE edge.a = node.id) AS n_links, reach.low AS component_id, node.id = reach.low AS kept, true AS recall_passed FROM node JOIN reach ON reach.id = node.id
"""
)

OP11_SQL = """
WITH v AS (SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.row AS a, a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id AS id, list_inner_product(a.e, c.e)::BIGINT AS score FROM v a JOIN v c ON a.row <> c.row AND len(a.e) = len(c.e) WHERE a.vec_id % 50 = 0),
p AS (SELECT a, anchor_id, id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY a ORDER BY score DESC, id) AS k FROM s WHERE same QUALIFY k <= 5),
n AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.a, p.k ORDER BY s.score DESC, s.id) AS r
  FROM p JOIN s ON s.a = p.a AND NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score QUALIFY r <= 3)
SELECT anchor_id, positive_id, r::INTEGER AS rank, negative_id, positive_score, negative_score FROM n
"""

OP12_SQL = """
WITH t AS (SELECT page_id, row_number() OVER () AS row, coalesce(html, '') AS p FROM pages),
w AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY page_id DESC NULLS LAST, row) AS k, max(page_id) OVER (PARTITION BY p) AS first, octet_length(encode(p)) AS n, sha1(p) AS h FROM t)
SELECT page_id, n::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + 10 * (i // 8)::INTEGER, 10))::BIGINT >> (35 - 5 * (i % 8)::INTEGER)) & 31)::INTEGER, 1)), '') AS payload_digest,
  CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN k > 1 THEN first END AS refers_to FROM w
"""


def _op13_sql() -> str:
    """Forwards, state by state: the least (cost, audit) in which each of the four states is reached, with the lines written so far."""
    moved = lambda of, cost, letter, line="''": f"{{'c': {of}.c + {cost}, 'a': {of}.a || '{letter}', 'o': {of}.o || {line}}}"
    least = lambda *options: f"list_sort([{', '.join(options)}])[1]"
    new = {"u": "'user:' || text || chr(10)", "a": "'assistant:' || text || chr(10)"}
    empty = {"u": "'user:' || chr(10)", "a": "'assistant:' || chr(10)"}
    kept = lambda of, r: moved(of, f"CASE WHEN r = '{r}' THEN stay ELSE 1000000 END", "K", "role || ':' || text || chr(10)")
    reroled = lambda of, r: moved(of, "stay + 1", "R", new[r])
    rows = [
        least(moved("e0", 2, "D")) + " AS n0",
        least(moved("e1", 2, "D"), kept("e0", "s")) + " AS n1",
        least(moved("e2", 2, "D"), *[f(e, "u") for e in ("e0", "e1", "e3") for f in (kept, reroled)]) + " AS n2",
        least(moved("e3", 2, "D"), kept("e2", "a"), reroled("e2", "a")) + " AS n3",
    ]
    nothing = "{'c': 0, 'a': '', 'o': ''}"
    user = least("n2", *[moved(n, 5, "I", empty["u"]) for n in ("n0", "n1", "n3")])
    return f"""
WITH RECURSIVE raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
hashed AS (SELECT *, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(k, ''), lambda x: ord(x)::BIGINT),
  lambda c, b: list_reduce([xor(c, b)] || range(8), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) % 20 AS h FROM raw),
damaged AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role, CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(CASE WHEN h = 3 THEN [1, 2] ELSE [1] END) FROM hashed WHERE h <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, substr(role, 1, 1) AS r FROM damaged),
faulted AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
  WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE '' END AS fault,
  coalesce(lag(r) OVER (PARTITION BY conv_id ORDER BY i) || r NOT IN ('su', 'ua', 'au'), false) AS broken FROM placed),
row_ AS (SELECT *, CASE fault WHEN '' THEN 0 WHEN 'truncated' THEN 5 ELSE 1000000 END AS stay FROM faulted),
ids AS (SELECT DISTINCT conv_id FROM conversations),
walk AS (SELECT conv_id, 0::BIGINT AS i, {nothing} AS e0, {{'c': 1000000, 'a': '', 'o': ''}} AS e1, {{'c': 5, 'a': 'I', 'o': 'user:' || chr(10)}} AS e2,
  {{'c': 10, 'a': 'II', 'o': 'user:' || chr(10) || 'assistant:' || chr(10)}} AS e3 FROM ids
  UNION ALL SELECT conv_id, i, n0, n1, u, {least('n3', moved('u', 5, 'I', empty['a']))} FROM (SELECT *, {user} AS u FROM (SELECT row_.conv_id, row_.i, {', '.join(rows)}
    FROM walk JOIN row_ ON row_.conv_id IS NOT DISTINCT FROM walk.conv_id AND row_.i = walk.i + 1))),
ended AS (SELECT conv_id, {least('e0', 'e3')} AS e FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (broken) AS illegal FROM row_ GROUP BY conv_id)
SELECT ended.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  e.c::BIGINT AS cost, e.a AS audit, sha256(e.o[:-2]) AS repaired_sha256 FROM ended LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM ended.conv_id
"""


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_minhash": op2_minhash,
    "op3_backoff": op3_backoff,
    "op3_backoff_trigrams": op3_backoff_trigrams,
    "op4_toxicity": op4_toxicity,
    "op5_bpe": op5_bpe,
    "op6_token_counts": op6_token_counts,
    "op7_quality": op7_quality,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_hnsw": op9_hnsw,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_negatives": op11_negatives,
    "op12_warc": op12_warc,
    "op13_conversations": op13_conversations,
}
ORACLES = {"op1_mixing": mixing_queries.sql(), "op2_minhash": OP2_SQL, "op3_backoff": ngrams.LEFT_OUT_SQL, "op3_backoff_trigrams": ngrams.SQL, "op8_substring_dedup": OP8_SQL, "op9_hnsw": OP9_SQL, "op10_exact_dedup": OP10_SQL, "op11_negatives": OP11_SQL, "op12_warc": OP12_SQL, "op13_conversations": _op13_sql()}
