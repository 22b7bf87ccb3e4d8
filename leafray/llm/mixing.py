"""Mixing sources to target weights, with DataFrame operations only.

The corpus is a tree: domains, their languages, their sources. A token budget
enters at the root and is dealt to children by weight. A child can take no more
than its supply (its tokens times the allowed epochs); what it can't take goes
to its siblings first, by their weights, and only what no sibling can take is
missed by the parent, whose own siblings then share it. Since a node's supply
is known before its parent's budget is dealt, one pass from the root does this.

A leaf reads its documents in epochs, each in its own seeded order, and takes
the prefix of that stream that its budget covers: whole epochs, then documents
in order, then the first words of one document. Tokens are words separated by
ASCII white space.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafray.llm.common import SPACE, join_counted, materialize, shared_dir, text_or_empty

WORD = r"[^\x20\x09-\x0D]+"
#: Documents of a bucket of a leaf's order, about; only the bucket at the budget's edge is put in order.
BUCKET = 2048
WIDE = "decimal(38,0)"


def weight_by(column: str, weights: dict[str, int], other: int = 1) -> Column:
    """An integer weight for each value of a column."""
    out = None
    for value, w in weights.items():
        out = F.when(F.col(column) == value, w) if out is None else out.when(F.col(column) == value, w)
    return F.lit(other) if out is None else out.otherwise(other)


def dealt(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Deal each parent's ``budget`` to its children: adds ``share``.

    ``nodes`` has one row per child with weight, supply and its parent's
    budget. In the order of supply per weight, a child is full if its supply is
    at most its part of what the children before it left; the first that isn't
    full and all after it divide the rest by weight, rounded down.
    """
    order = Window.partitionBy(*parent).orderBy(F.col("supply") / F.greatest("weight", F.lit(1)), F.col(name))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    n = nodes.select("*", F.col("supply").cast(WIDE).alias("s_"), F.col("weight").cast("decimal(9,0)").alias("w_"))
    n = n.withColumn("left_", F.col("budget").cast(WIDE) - F.coalesce(F.sum("s_").over(before), F.lit(0).cast(WIDE)))
    # all weights less those before, since a frame to the end would be summed anew for each row
    rest = F.sum("w_").over(Window.partitionBy(*parent)) - F.coalesce(F.sum("w_").over(before), F.lit(0).cast("decimal(9,0)"))
    n = n.withColumn("rest_", rest.cast("decimal(18,0)"))
    n = n.withColumn("full_", F.col("supply").cast("decimal(27,0)") * F.col("rest_").cast("decimal(10,0)") <= F.col("left_").cast("decimal(27,0)") * F.col("w_"))
    # the first child that isn't full sets the rate for all after it
    edge = Window.partitionBy(*parent)
    first = F.min(F.when(~F.col("full_"), F.struct("rank_", "left_", "rest_"))).over(edge)
    n = n.withColumn("rank_", F.row_number().over(order)).withColumn("edge_", first)
    open_ = F.floor(F.expr("try_divide(cast(edge_.left_ as decimal(27,0)) * w_, edge_.rest_)"))
    share = F.when(F.col("edge_").isNull() | (F.col("rank_") < F.col("edge_.rank_")), F.col("supply")).otherwise(F.least(F.coalesce(open_.cast("long"), F.lit(0)), F.col("supply")))
    return n.withColumn("share", F.greatest(share, F.lit(0)).cast("long")).drop("s_", "w_", "left_", "rest_", "full_", "rank_", "edge_")


def place(seed: int, epoch: Column, doc_id: Column) -> Column:
    """A document's place (60 bits) in the order of an epoch."""
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def select_tokens(
    spark: SparkSession, docs: DataFrame, domain: Column, weights: dict[str, Column], budget: float, epochs: int, seed: int = 1
) -> DataFrame:
    """The mixture: one row per document and epoch it is read in: doc_id, domain, lang, source, epoch, n_tokens, taken, print.

    ``budget`` is the mixture's size as a multiple of all tokens of ``docs``
    (doc_id, text, lang, source; other columns are ignored); ``weights`` has a
    positive integer Column for "domain", "lang" and "source". A leaf is read
    ``epochs`` times at most. taken is n_tokens but for the document where a
    leaf's budget ends. Null languages and sources are values of their own;
    documents without tokens (null, empty, white space) have nothing to take and
    give no row. Rows that repeat a doc_id are read one by one. ``print`` ties a
    row to its text. An empty table gives an empty result.
    """
    root = shared_dir(spark, "mixing")
    tree = ["domain", "lang", "source"]
    staged = docs.select("doc_id", domain.alias("domain"), "lang", "source", F.regexp_count(text_or_empty("text"), F.lit(WORD)).cast("long").alias("n_tokens"), F.xxhash64("text").alias("print"))
    staged = materialize(staged.where("n_tokens > 0").withColumn("leaf", F.to_json(F.array(*[F.coalesce(F.concat(F.lit("="), c), F.lit("")) for c in tree]))), f"{root}/staged")
    leaves = staged.groupBy("leaf", *tree).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    leaves = materialize(leaves, f"{root}/leaves")
    total, rows = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("docs"), F.lit(0))).first()

    leaf = leaves.withColumn("supply", F.col("tokens") * epochs)
    langs = leaf.groupBy("domain", "lang").agg(F.sum("supply").alias("supply"))
    domains = leaf.groupBy("domain").agg(F.sum("supply").alias("supply"))
    top = dealt(domains.withColumn("weight", weights["domain"]).withColumn("budget", F.lit(int(total * budget))).withColumn("root", F.lit(0)), ["root"], "domain")
    top = top.select(F.col("domain").alias("d1"), F.col("share").alias("budget"))
    mid = dealt(langs.join(top, F.col("domain").eqNullSafe(F.col("d1"))).withColumn("weight", weights["lang"]), ["domain"], "lang")
    mid = mid.select(F.col("domain").alias("d2"), F.col("lang").alias("l2"), F.col("share").alias("budget"))
    low = leaf.join(mid, F.col("domain").eqNullSafe(F.col("d2")) & F.col("lang").eqNullSafe(F.col("l2"))).withColumn("weight", weights["source"])
    plan = dealt(low, ["domain", "lang"], "source").select(
        "leaf",
        "docs",
        F.expr("share div tokens").alias("whole"),
        (F.col("share") % F.col("tokens")).alias("rest"),
        F.greatest(F.lit(0), F.ceil(F.log2(F.col("docs") / BUCKET))).cast("int").alias("bits"),
    )
    plan = materialize(plan, f"{root}/plan")

    known = join_counted(staged, plan, "leaf", "docs", rows)
    known = known.withColumn("place", place(seed, F.col("whole"), F.col("doc_id"))).withColumn("bucket", F.expr("shiftright(place, 60 - bits)"))
    known = materialize(known.drop("docs", "bits"), f"{root}/known")
    out = ["doc_id", *tree, "epoch", "n_tokens", "taken", "print"]
    repeats = known.where("whole > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1))).withColumn("taken", F.col("n_tokens"))

    sums = known.where("rest > 0").groupBy("leaf", "bucket").agg(F.sum("n_tokens").alias("size"), F.first("rest").alias("rest"))
    running = Window.partitionBy("leaf").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("size").over(running), F.lit(0))).where("before < rest")
    sums = materialize(sums.select("leaf", "bucket", "before", (F.col("before") + F.col("size") > F.col("rest")).alias("edge")), f"{root}/buckets")
    part = known.where("rest > 0").withColumn("epoch", F.col("whole")).join(sums, ["leaf", "bucket"])
    inside = part.where("not edge").withColumn("taken", F.col("n_tokens"))
    order = Window.partitionBy("leaf", "bucket").orderBy("place", "doc_id", "n_tokens", "print").rowsBetween(Window.unboundedPreceding, -1)
    edge = part.where("edge").withColumn("at", F.col("before") + F.coalesce(F.sum("n_tokens").over(order), F.lit(0))).where("at < rest")
    edge = edge.withColumn("taken", F.least("n_tokens", F.col("rest") - F.col("at")))
    return repeats.select(*out).unionByName(inside.select(*out)).unionByName(edge.select(*out))


def mixed_documents(spark: SparkSession, docs: DataFrame, **how) -> DataFrame:
    """The documents of the mixture, once for each epoch they are read in, with all columns of ``docs``.

    Where a leaf's budget ends inside a document, its text becomes its first
    words joined by one space; every other text and column stays as it is.
    """
    picks = select_tokens(spark, docs, **how)
    picks = picks.groupBy(F.col("doc_id").alias("pick_id"), F.col("print").alias("pick_print")).agg(F.collect_list(F.struct("epoch", "taken", "n_tokens")).alias("picks"))
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    own = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    ident, text = F.col(names["doc_id"]), F.col(names["text"])
    own = own.withColumn("own_print", F.xxhash64(text))
    found = own.join(picks, ident.eqNullSafe(F.col("pick_id")) & (F.col("own_print") == F.col("pick_print")))
    # rows that repeat id and text share one list of picks, which must count once
    if not docs.groupBy("doc_id", F.xxhash64("text")).count().where("count > 1").isEmpty():
        found = found.dropDuplicates([names["doc_id"], "own_print"])
    found = found.withColumn("pick", F.explode("picks"))
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    cut = F.when(F.col("pick.taken") < F.col("pick.n_tokens"), F.array_join(F.slice(words, 1, F.col("pick.taken").cast("int")), " ")).otherwise(text)
    return found.withColumn(names["text"], cut).select(*[F.col(n).alias(c) for c, n in names.items()])
