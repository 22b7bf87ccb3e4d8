"""The production mixture and its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafray.llm.mixing import weight_by

DOMAIN_WEIGHTS = {"d0": 4, "d1": 3, "d2": 2, "d3": 1}
LANG_WEIGHTS = {"en": 6, "de": 2, "fr": 2}
BUDGET, EPOCHS, SEED = 1.0, 3, 1


def production() -> dict:
    """Domains are sources by number modulo four; sources of a language weigh the same."""
    number = F.expr("try_cast(regexp_extract(coalesce(source, ''), '[0-9]+', 0) as bigint)")
    return {
        "domain": F.concat(F.lit("d"), F.coalesce((number % 4).cast("string"), F.lit("x"))),
        "weights": {"domain": weight_by("domain", DOMAIN_WEIGHTS), "lang": weight_by("lang", LANG_WEIGHTS), "source": F.lit(1)},
        "budget": BUDGET,
        "epochs": EPOCHS,
        "seed": SEED,
    }


def _deal(name: str, rows: str, parent: str, child: str) -> str:
    """CTEs that deal the budgets of ``rows`` (parent keys, child, w, supply, budget) to ``name`` (with share)."""
    over = f"PARTITION BY {parent} ORDER BY supply::DOUBLE / greatest(w, 1), {child}"
    return f"""
{name}_a AS (SELECT *, row_number() OVER ({over}) AS k,
    budget::HUGEINT - coalesce(sum(supply) OVER ({over} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS lft,
    (sum(w) OVER ({over} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::HUGEINT AS rst FROM {rows}),
{name}_b AS (SELECT *, min(CASE WHEN supply::HUGEINT * rst > lft * w THEN k END) OVER (PARTITION BY {parent}) AS edge FROM {name}_a),
{name}_c AS (SELECT *, max(CASE WHEN k = edge THEN lft END) OVER (PARTITION BY {parent}) AS elft,
    max(CASE WHEN k = edge THEN rst END) OVER (PARTITION BY {parent}) AS erst FROM {name}_b),
{name} AS (SELECT *, CASE WHEN edge IS NULL OR k < edge THEN supply
    ELSE least(greatest((elft * w) // erst, 0), supply) END::BIGINT AS share FROM {name}_c)"""


def sql() -> str:
    cases = lambda col, ws: "CASE " + " ".join(f"WHEN {col} = '{k}' THEN {v}" for k, v in ws.items()) + " ELSE 1 END"
    return rf"""
WITH d AS (SELECT doc_id, lang, source,
    'd' || coalesce(CAST(TRY_CAST(regexp_extract(coalesce(source, ''), '[0-9]+') AS BIGINT) % 4 AS VARCHAR), 'x') AS domain,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens FROM documents),
s AS (SELECT * FROM d WHERE n_tokens > 0),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, sum(n_tokens)::BIGINT * {EPOCHS} AS supply FROM s GROUP BY ALL),
r1 AS (SELECT 0 AS top, domain, {cases("domain", DOMAIN_WEIGHTS)} AS w, sum(supply)::BIGINT AS supply,
    (SELECT floor(sum(tokens) * {BUDGET})::BIGINT FROM leaf) AS budget FROM leaf GROUP BY domain),
{_deal("g1", "r1", "top", "domain")},
r2 AS (SELECT l.domain, l.lang, {cases("l.lang", LANG_WEIGHTS)} AS w, l.supply, g.share AS budget
    FROM (SELECT domain, lang, sum(supply)::BIGINT AS supply FROM leaf GROUP BY ALL) l JOIN g1 g ON l.domain = g.domain),
{_deal("g2", "r2", "domain", "lang")},
r3 AS (SELECT l.domain, l.lang, l.source, 1 AS w, l.supply, l.tokens, g.share AS budget
    FROM leaf l JOIN g2 g ON l.domain = g.domain AND l.lang IS NOT DISTINCT FROM g.lang),
{_deal("g3", "r3", "domain, lang", "source")},
p AS (SELECT domain, lang, source, share // tokens AS whole, share % tokens AS rest FROM g3),
j AS (SELECT s.*, p.whole, p.rest FROM s JOIN p ON s.domain = p.domain AND s.lang IS NOT DISTINCT FROM p.lang AND s.source IS NOT DISTINCT FROM p.source),
o AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY substr(sha256('{SEED}:' || whole || ':' || doc_id), 1, 15), doc_id, n_tokens
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n_tokens AS pos FROM j)
SELECT doc_id, domain, lang, source, e.epoch::BIGINT AS epoch, n_tokens, n_tokens AS taken
FROM j, LATERAL (SELECT unnest(range(whole)) AS epoch) e
UNION ALL
SELECT doc_id, domain, lang, source, whole, n_tokens, least(n_tokens, rest - pos)::BIGINT FROM o WHERE pos < rest
"""
