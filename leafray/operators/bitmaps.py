"""Masks kept as bitmaps: a bit per signal and epoch instead of a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafray.functions.columns import micros

#: Epochs in a bitmap of 4 kB.
BITS = 32_768


def _place(epoch: Column, interval_s: float) -> tuple[Column, Column]:
    """Bitmap and bit of an epoch: its number, counted in intervals, split in two."""
    number = F.floor(micros(epoch) / int(interval_s * 1_000_000))
    stretch = F.floor(number / BITS)
    return stretch, (number - stretch * BITS).cast("long")


def pack(df: DataFrame, mask: Column, interval_s: float, name: str = "mask", by: str = "sid") -> DataFrame:
    """A row per signal and stretch of BITS epochs: name, ``by``, stretch, bits and epochs (how many bits are set).

    Only rows where ``mask`` is true set their bit; a bitmap without any is not
    kept. Epochs must lie ``interval_s`` apart or a multiple of it. Rows without
    signal or epoch are in no mask.
    """
    stretch, bit = _place(F.col("epoch"), interval_s)
    kept = df.where(F.coalesce(mask, F.lit(False)) & F.col(by).isNotNull() & F.col("epoch").isNotNull())
    made = kept.select(by, stretch.alias("stretch"), bit.alias("bit_")).groupBy(by, "stretch").agg(F.bitmap_construct_agg("bit_").alias("bits"))
    return made.select(F.lit(name).alias("name"), by, "stretch", "bits", F.bitmap_count("bits").alias("epochs"))


def apply(df: DataFrame, masks: DataFrame, name: str, interval_s: float, by: str = "sid") -> DataFrame:
    """``df`` with the boolean column ``name`` of a stored mask; false where no bit is set, null without signal or epoch.

    Rows meet their bitmap by signal and stretch (a row of ``masks`` per 32,768
    epochs), not by a key of rows, and then look at their own bit.
    """
    stretch, bit = _place(F.col("epoch"), interval_s)
    own = masks.where(F.col("name") == name).select(F.col(by).alias("by_"), F.col("stretch").alias("of_"), "bits")
    met = df.withColumn("stretch_", stretch).withColumn("bit_", bit).join(own, (F.col(by) == F.col("by_")) & (F.col("stretch_") == F.col("of_")), "left")
    octet = F.conv(F.hex(F.substring(F.col("bits"), F.floor(F.col("bit_") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    found = F.coalesce(F.getbit(octet, (F.col("bit_") % 8).cast("int")) == 1, F.lit(False))
    return met.withColumn(name, F.when(F.col(by).isNotNull() & F.col("epoch").isNotNull(), found)).drop("stretch_", "bit_", "by_", "of_", "bits")
