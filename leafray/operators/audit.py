"""Comparison of two datasets: pairwise statistics, tolerances, verdicts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafray.functions.columns import ratio
from leafray.operators.ordered import exact_quantiles
from leafray.sources.scratch import written

# Tier, largest difference, mean difference, difference of missing rates.
TIERS = [("exact", 0.0, 0.0, 0.0), ("numerical", 1e-6, 1e-10, 0.0), ("scientific", 0.01, 0.01, 0.0)]
# The same of single variables in the scientific tier.
SCIENTIFIC = [
    ("snr", 0.25, 0.0, 0.01),
    ("vod", 0.01, 0.01, 0.01),
    ("phi", 0.05, 0.0, 0.0),
    ("theta", 0.05, 0.0, 0.0),
    ("carrier_phase", 1e-6, 1e-9, 0.01),
    ("pseudorange", 1e-3, 1e-6, 0.01),
    ("sat_x", 1e-3, 1e-9, 0.05),
    ("sat_y", 1e-3, 1e-9, 0.05),
    ("sat_z", 1e-3, 1e-9, 0.05),
]


def compare(a: DataFrame, b: DataFrame, variables: Sequence[str], keys: Sequence[str] = ("epoch", "sid"), by: Sequence[str] = ()) -> DataFrame:
    """One row per variable, and group of ``by``, over the rows that both have: counts, largest, RMSE, MAE, bias, correlation, quantiles, missing rates.

    The join is written to the shared folder once: statistics and both passes of
    the quantiles read the pairs from there, instead of joining anew.
    """
    keys = [*by, *[k for k in keys if k not in by]]
    right = b.select(*keys, *[F.col(v).alias(f"{v}_b") for v in variables])
    both = a.select(*keys, *variables).join(right, list(keys))
    pairs = F.explode(F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).cast("double").alias("a"), F.col(f"{v}_b").cast("double").alias("b")) for v in variables]))
    p = written(both.select(*by, pairs.alias("p")).select(*by, "p.*"), "pairs")
    d = F.col("a") - F.col("b")
    n = F.count(d)
    out = p.groupBy(*by, "variable").agg(
        n.alias("n_compared"),
        F.count_if(F.col("a").isNotNull() & F.col("b").isNull()).alias("a_only"),
        F.count_if(F.col("a").isNull() & F.col("b").isNotNull()).alias("b_only"),
        F.count_if(F.col("a").isNull() & F.col("b").isNull()).alias("neither"),
        F.count_if(d != 0).alias("n_different"),
        F.max(F.abs(d)).alias("max_abs"),
        F.sqrt(F.avg(d * d)).alias("rmse"),
        F.avg(F.abs(d)).alias("mae"),
        F.avg(d).alias("bias"),
        F.when(n >= 2, F.corr(F.when(d.isNotNull(), F.col("a")), F.when(d.isNotNull(), F.col("b")))).alias("correlation"),
        F.avg(F.col("a").isNull().cast("double")).alias("missing_a"),
        F.avg(F.col("b").isNull().cast("double")).alias("missing_b"),
        F.avg((F.col("a").isNull() == F.col("b").isNull()).cast("double")).alias("missing_agreement"),
    )
    q = exact_quantiles(p, F.abs(d), (0.5, 0.9, 0.99), by=[*by, "variable"])
    return out.join(q, [*by, "variable"], "left").select("*", *[F.get("q", F.lit(i)).alias(x) for i, x in enumerate(("p50", "p90", "p99"))]).drop("q")


def alignment(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """Labels of a column that both have, and those that only one has."""
    x, y = a.select(column).distinct().withColumn("in_a", F.lit(True)), b.select(column).distinct().withColumn("in_b", F.lit(True))
    both = x.join(y, column, "full")
    return both.agg(F.count_if(F.col("in_a") & F.col("in_b")).alias("shared"), F.count_if(F.col("in_b").isNull()).alias("dropped_a"), F.count_if(F.col("in_a").isNull()).alias("dropped_b"))


def tolerances(stats: DataFrame, tier: str, overrides: dict[str, tuple[float, float, float]] | None = None) -> DataFrame:
    """Adds the tolerances of each variable: its own if overridden, else in the scientific tier that of its kind, else the tier's."""
    base = {t[0]: t[1:] for t in TIERS}[tier]
    names = ("atol", "mae_atol", "missing_atol")
    cols = {n: F.lit(base[i]) for i, n in enumerate(names)}
    known = ({t[0]: t[1:] for t in SCIENTIFIC} if tier == "scientific" else {}) | (overrides or {})
    for variable, own in known.items():
        cols = {n: F.when(F.col("variable") == variable, F.lit(own[i])).otherwise(c) for i, (n, c) in enumerate(cols.items())}
    return stats.withColumns(cols)


def verdicts(stats: DataFrame, tier: str = "numerical", overrides=None) -> DataFrame:
    """Adds passed: all within tolerance; nothing compared fails; the exact tier wants identical values and gaps."""
    known = tolerances(stats, tier, overrides)
    near = (F.col("max_abs") <= F.col("atol")) & (F.col("mae") <= F.col("mae_atol")) & (F.abs(F.col("missing_a") - F.col("missing_b")) <= F.col("missing_atol"))
    same = (F.col("n_different") == 0) & (F.col("a_only") + F.col("b_only") == 0)
    return known.withColumn("passed", F.coalesce((F.col("n_compared") > 0) & (same if tier == "exact" else near), F.lit(False)))


def budgets(stats: DataFrame, budget: dict[str, float]) -> DataFrame:
    """Adds the physical budget of a variable and whether its largest difference exceeds it."""
    rows = stats.sparkSession.createDataFrame(list(budget.items()), "variable string, budget double")
    return stats.join(rows, "variable", "left").withColumn("exceeds", F.coalesce(F.col("max_abs") > F.col("budget"), F.lit(False)))


def run(a: DataFrame, b: DataFrame, variables: Sequence[str], group: str, tier: str = "exact", overrides=None, keys: Sequence[str] = ("epoch", "sid")) -> DataFrame:
    """The audit of two stores: every group that both have, compared variable by variable, with the verdict of the tier.

    Two runs of one pipeline, a store and its checkpoint, chunked and whole
    processing, or two ephemeris sources differ in the tier and the tables only.
    Rows that repeat an epoch and signal count once on either side.
    """
    shared = a.select(group).intersect(b.select(group))
    x, y = (df.join(shared, group, "left_semi").groupBy(group, *keys).agg(*[F.min(v).alias(v) for v in variables]) for df in (a, b))
    return verdicts(compare(x, y, variables, keys, by=[group]), tier, overrides)


def depth_decomposition(pairs: DataFrame, cutoff: float = 5.0) -> DataFrame:
    """How much of a depth difference the elevation difference explains.

    ``pairs`` has elev_a, elev_b (degrees), vod_a, vod_b. Predicted differences
    scale vod_b by the ratio of path cosines; pairs below the cutoff are left out.
    """
    ca, cb = F.sin(F.radians("elev_a")), F.sin(F.radians("elev_b"))
    known = pairs.where((F.col("elev_a") > cutoff) & (F.col("elev_b") > cutoff)).dropna(subset=["vod_a", "vod_b"])
    known = known.withColumn("actual", F.col("vod_a") - F.col("vod_b")).withColumn("predicted", F.col("vod_b") * (ratio(ca, cb) - 1))
    known = known.withColumn("residual", F.col("actual") - F.col("predicted"))
    return known.agg(
        F.count(F.lit(1)).alias("n"), F.avg("actual").alias("mean_actual"), F.avg("predicted").alias("mean_predicted"), F.avg("residual").alias("mean_residual"),
        (1 - ratio(F.var_pop("residual"), F.var_pop("actual"))).alias("explained"),
    )


def report(rows: list, title: str = "", style: str = "markdown") -> str:
    """A small result table as text."""
    if not rows:
        return title
    names = list(rows[0].asDict())
    cells = [["" if v is None else f"{v:.6g}" if isinstance(v, float) else str(v) for v in r] for r in rows]
    if style == "latex":
        body = "\n".join(" & ".join(x).replace("_", r"\_") + r" \\" for x in [names, *cells])
        return f"\\begin{{tabular}}{{{'l' * len(names)}}}\n{body}\n\\end{{tabular}}"
    if style == "typst":
        return f"#table(columns: {len(names)}, {', '.join(f'[{v}]' for x in [names, *cells] for v in x)})"
    lines = [names, ["---"] * len(names), *cells]
    return "\n".join([*([f"## {title}"] if title else []), *["| " + " | ".join(x) + " |" for x in lines]])
