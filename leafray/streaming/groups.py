"""Days of receivers given out as they become complete, each once.

A file covers a stretch of time. A group is a receiver and a day; it is complete
when the files that came cover all of its expected epochs, and is given out at
once. What is missing when the watermark passes the day's end is given up, and
the group is given out as it is. Its state goes when the watermark has passed;
files that come later are too late.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

SCHEMA = "receiver string, date date, files array<string>, n_epochs long, n_missing long, complete boolean"
DAY = 86_400
_ZERO = dt.date(1970, 1, 1)


class CompleteDays(StatefulProcessor):
    """Rows of SCHEMA from rows (receiver, date, file_hash, first, last): numbers of the first and last epoch of the day that a file covers."""

    def __init__(self, expected: int):
        self.expected = expected

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "bits binary, given boolean")
        self.files = handle.getMapState("files", "file_hash string", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803 (Spark's names)
        end = ((key[1] - _ZERO).days + 1) * DAY * 1000
        if timerValues.getCurrentWatermarkInMs() >= end:
            return
        if self.state.exists():
            held, given = self.state.get()
            bits = int.from_bytes(held, "little")
        else:
            bits, given = 0, False
            self.handle.registerTimer(end)
        for row in rows:
            if not given and not self.files.containsKey((row.file_hash,)):
                bits |= ((1 << (row.last - row.first + 1)) - 1) << row.first
                self.files.updateValue((row.file_hash,), (row.last - row.first + 1,))
        if not given and bits.bit_count() == self.expected:
            given = True
            yield self._group(key, bits)
            self.files.clear()
        self.state.update((bits.to_bytes(-(-self.expected // 8), "little"), given))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        if self.state.exists():
            held, given = self.state.get()
            if not given:
                yield self._group(key, int.from_bytes(held, "little"))
        self.state.clear()
        self.files.clear()

    def _group(self, key, bits: int) -> Row:
        n = bits.bit_count()
        return Row(receiver=key[0], date=key[1], files=sorted(k[0] for k in self.files.keys()), n_epochs=n, n_missing=self.expected - n, complete=n == self.expected)


def complete_groups(stream: DataFrame, interval_s: int = 30, late: str = "2 days") -> DataFrame:
    """Groups of a stream of files (receiver, file_hash, start, end), as SCHEMA.

    A file that reaches over midnight counts for both days. A file that comes
    twice counts once. A group is given out once: when its day is covered at
    ``interval_s``, or when the watermark (the latest start so far, less
    ``late``) has passed its end.
    """
    day = F.explode(F.sequence(F.to_date("start"), F.to_date("end")))
    each = stream.withColumn("date", day)
    begin = F.greatest(F.col("start").cast("timestamp"), F.col("date").cast("timestamp"))
    # the last epoch of a day lies an interval before the next day
    within = lambda t: F.floor((F.unix_seconds(t.cast("timestamp")) - F.unix_date("date") * DAY) / interval_s)
    each = each.withColumn("first", F.greatest(F.lit(0), within(F.col("start")))).withColumn("last", F.least(F.lit(DAY // interval_s - 1), within(F.col("end"))))
    each = each.select("receiver", "date", "file_hash", F.col("first").cast("int").alias("first"), F.col("last").cast("int").alias("last"), begin.alias("begin"))
    held = each.withWatermark("begin", late).groupBy("receiver", "date")
    return held.transformWithState(CompleteDays(DAY // interval_s), SCHEMA, "append", "eventTime")
