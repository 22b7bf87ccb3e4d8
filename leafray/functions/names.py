"""File names by a user's recipe: fixed-width fields from left to right."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafray.functions import gnss

#: Fields that a recipe may name; "skip" passes over characters.
FIELDS = ("year", "yy", "doy", "month", "day", "hour", "minute", "hour_letter", "skip")


def recipe_fields(name: Column, recipe: Sequence[tuple[str, int]]) -> dict[str, Column]:
    """The fields of ``recipe`` (field, width) and ``valid``: the name is long enough and its numbers are numbers.

    Numbers that aren't come out null. A field named twice takes its last place.
    """
    at, out, valid = 1, {}, F.lit(True)
    for field, width in recipe:
        if field not in FIELDS or width < 1:
            raise ValueError(f"unknown field or width: {field!r}, {width}")
        raw = F.substring(name, at, width)
        at += width
        if field == "hour_letter":
            out[field] = raw
        elif field != "skip":
            out[field] = raw.try_cast("int")
            valid = valid & out[field].isNotNull()
    return out | {"valid": valid & (F.length(name) >= at - 1)}


def recipe_time(fields: dict[str, Column]) -> Column:
    """The start that a recipe's fields name: year or two-digit year, then month and day or day of year, hour or its letter, minute."""
    year = fields["year"] if "year" in fields else gnss.full_year(fields["yy"])
    if "month" in fields:
        day = F.make_date(year, fields["month"], fields.get("day", F.lit(1)))
    else:
        day = F.date_add(F.make_date(year, F.lit(1), F.lit(1)), fields.get("doy", F.lit(1)) - 1)
    hour = fields["hour"] if "hour" in fields else gnss.hour_of_letter(fields["hour_letter"]) if "hour_letter" in fields else F.lit(0)
    seconds = F.coalesce(hour, F.lit(0)) * 3600 + fields.get("minute", F.lit(0)) * 60
    return day.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
