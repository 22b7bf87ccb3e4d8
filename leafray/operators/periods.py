"""Tables of periods on one time line, and the satellite catalogue that is made of such tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafray.operators.ordered import last_said

# Fixed values of the format: per block, the typed columns behind the satellite and its period (or, without a period, behind the satellite).
CATALOG = {
    "PRN": [("prn", "string")],
    "MASS": [("mass_kg", "double")],
    "TX_POWER": [("watts", "double")],
    "PLANE": [("plane", "string"), ("slot", "string")],
    "FREQUENCY_CHANNEL": [("channel", "int")],
    "COM": [("x_m", "double"), ("y_m", "double"), ("z_m", "double")],
}
IDENTIFIER = [("cospar_id", "string"), ("satcat", "int"), ("block", "string")]


def timeline(tables: dict[str, DataFrame], key: str, start: str = "start", end: str = "end") -> DataFrame:
    """All periods of each ``key`` cut at the union of their ends: key, start, end, and the columns of every table (null where none of its periods holds).

    ``tables`` have the key, a start, an end (excluded; null for open) and
    columns of their own. A period ends at the latest where the next one of its
    table begins; of periods that begin together the one that ends last counts,
    an open one last of all. Stretches in which no table has a period are left out, those
    without key or start are no periods, and neighbouring stretches stay apart
    where any table has an end. All tables meet in one union and one window over the key, however
    many there are; tables that come dealt by the key into equally many
    partitions aren't shuffled again, so the caller can bound what a task takes.
    """
    events, names = None, {}
    for name, df in tables.items():
        names[name] = [c for c in df.columns if c not in (key, start, end)]
        known = df.where(F.col(key).isNotNull() & F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(end) > F.col(start))))
        rank = Window.partitionBy(key, start).orderBy(F.desc_nulls_first(end), *names[name])
        known = known.withColumn("n_", F.row_number().over(rank)).where("n_ = 1")
        # each period is a row where it begins and an empty one where it ends
        both = known.select(key, end, *names[name], F.posexplode(F.array(start, end)).alias("place_", "at_")).where("at_ is not null")
        both = both.select(key, "at_", F.when(F.col("place_") == 0, F.struct(F.col(end).alias("end"), F.struct(*names[name]).alias("own"))).alias(f"p_{name}"))
        events = both if events is None else events.unionByName(both, allowMissingColumns=True)
    order = Window.partitionBy(key).orderBy("at_")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    out = events.select(key, F.col("at_").alias(start), F.lead("at_").over(order).alias(end), *[F.last(f"p_{n}", ignorenulls=True).over(so_far).alias(f"p_{n}") for n in names])
    # of the rows of one moment the last has met them all
    out = out.where(F.col(end).isNull() | (F.col(end) > F.col(start)))
    holds = {n: F.coalesce(F.col(f"p_{n}.end").isNull() | (F.col(f"p_{n}.end") > F.col(start)), F.lit(False)) & F.col(f"p_{n}").isNotNull() for n in names}
    any_ = None
    for h in holds.values():
        any_ = h if any_ is None else any_ | h
    values = [F.when(holds[n], F.col(f"p_{n}.own")[c]).alias(c) for n, cs in names.items() for c in cs]
    return out.where(any_).select(key, start, end, *values)


def sinex_time(text: Column) -> Column:
    """``YYYY:DDD:SSSSS``; all zeros mean open, hence null."""
    part = lambda i: F.split_part(text, F.lit(":"), F.lit(i + 1)).try_cast("int")
    day = F.date_add(F.make_date(part(0), F.lit(1), F.lit(1)), part(1) - 1)
    return F.when(part(0) > 0, F.timestamp_seconds(F.unix_date(day).cast("long") * 86_400 + part(2)).cast("timestamp_ntz"))


def catalog(lines: DataFrame) -> dict[str, DataFrame]:
    """The satellite tables of SINEX ``lines`` (file, line, value, as ``text.numbered_lines`` gives them): ``identifier`` and, with start and end, those of CATALOG.

    All blocks come from one pass that marks each line with its block.
    """
    block = F.regexp_extract("value", r"^[+-]SATELLITE/(\S+)", 1)
    edge = lambda sign: F.col("value").startswith(f"{sign}SATELLITE/") & (block != "")
    mark = F.when(edge("+"), block).when(edge("-"), F.lit(""))
    inside = last_said(lines, mark, "block").where(~F.col("value").rlike(r"^[+\-*%#]"))
    # exploded, since Spark writes what is only selected anew into every filter that asks for it
    fields = inside.select("block", F.explode(F.array(F.split(F.trim("value"), r"\s+"))).alias("f"))
    typed = lambda columns, at: [F.get("f", F.lit(at + i)).try_cast(t).alias(n) for i, (n, t) in enumerate(columns)]
    out = {"identifier": fields.where("block = 'IDENTIFIER'").select(F.col("f")[0].alias("svn"), *typed(IDENTIFIER, 1))}
    for name, columns in CATALOG.items():
        own = fields.where(F.col("block") == name)
        row = F.struct(F.col("f")[0].alias("svn"), sinex_time(F.get("f", F.lit(1))).alias("start"), sinex_time(F.get("f", F.lit(2))).alias("end"), *typed(columns, 3))
        out[name.lower()] = own.select(F.inline(F.array(row)))
    return out


def satellite_periods(tables: dict[str, DataFrame]) -> DataFrame:
    """What held of each satellite when: svn, start, end and the columns of all period tables, with the identifier's."""
    whole = timeline({n: t for n, t in tables.items() if n != "identifier"}, "svn")
    return whole.join(tables["identifier"].dropDuplicates(["svn"]), "svn", "left")
