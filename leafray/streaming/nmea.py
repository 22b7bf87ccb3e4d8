"""NMEA sentences as a stream: epochs put together from pieces of a receiver's log, wherever the pieces are cut.

A receiver's log comes in numbered pieces. Per receiver the state holds the
number of the next piece, the line that the last piece broke off in, the open
epoch with its sentences, and pieces that came before their turn. An epoch is
given out when the next one begins. What is held longer than ``patience`` (an
open epoch at the end of a log, pieces behind a missing one) is given out by a
timer.
"""

from __future__ import annotations

import functools
import operator
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from leafray.sources.text import satellites_in_view

SCHEMA = "receiver string, epoch double, sentences array<string>"


def valid(line: str) -> bool:
    """A sentence whose checksum is right."""
    body, check = re.match(r"\$([^*]+)\*", line), re.search(r"\*([0-9A-Fa-f]{2})\s*$", line)
    return bool(body and check) and functools.reduce(operator.xor, map(ord, body[1])) == int(check[1], 16)


def seconds_of_day(line: str) -> float | None:
    """The time of a position sentence; None of any other."""
    f = line[1:].split("*")[0].split(",")
    if f[0][2:5] not in ("RMC", "GGA") or len(f) < 2 or len(f[1]) < 6:
        return None
    try:
        return int(f[1][:2]) * 3600 + int(f[1][2:4]) * 60 + float(f[1][4:14])
    except ValueError:
        return None


class EpochsOfPieces(StatefulProcessor):
    """Rows of SCHEMA from pieces (receiver, piece, text), in order of the pieces' numbers, which begin with 0."""

    def __init__(self, patience_ms: int):
        self.patience_ms = patience_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.place = handle.getValueState("place", "next long, rest string, epoch double")
        self.sentences = handle.getListState("sentences", "line string")
        self.early = handle.getMapState("early", "piece long", "text string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803 (Spark's names)
        following = self.place.get()[0] if self.place.exists() else 0
        for row in rows:
            # a piece of a number that had its turn is a repetition
            if row.piece >= following:
                self.early.updateValue((row.piece,), (row.text,))
        yield from self._taken(key)
        self._wait(timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        self._unfinished()
        # missing pieces are given up, and with them the lines that they broke
        for piece in sorted(k[0] for k in list(self.early.keys())):
            following, _, epoch = self.place.get()
            if piece >= following:
                self.place.update((piece, "", epoch))
                yield from self._taken(key)
                self._unfinished()
        epoch = self.place.get()[2]
        held = [x[0] for x in self.sentences.get()] if self.sentences.exists() else []
        if held:
            self.sentences.clear()
            yield Row(receiver=key[0], epoch=epoch, sentences=held)

    def _unfinished(self) -> None:
        """Takes the line that a piece broke off in, if it is whole nevertheless."""
        following, rest, epoch = self.place.get() if self.place.exists() else (0, "", None)
        if valid(rest) and rest[3:6] == "GSV" and epoch is not None:
            self.sentences.appendValue((rest,))
            rest = ""
        self.place.update((following, rest, epoch))

    def _wait(self, timers) -> None:
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + self.patience_ms)

    def _taken(self, key) -> Iterator[Row]:
        following, rest, epoch = self.place.get() if self.place.exists() else (0, "", None)
        fresh = []
        while self.early.containsKey((following,)):
            lines = (rest + self.early.getValue((following,))[0]).split("\n")
            self.early.removeKey((following,))
            following, rest = following + 1, lines.pop()
            for line in (x.rstrip("\r") for x in lines):
                if not valid(line):
                    continue
                at = seconds_of_day(line)
                if at is not None and at != epoch:
                    held = [x[0] for x in self.sentences.get()] if self.sentences.exists() else []
                    if held + fresh:
                        yield Row(receiver=key[0], epoch=epoch, sentences=held + fresh)
                    self.sentences.clear()
                    epoch, fresh = at, []
                elif line[3:6] == "GSV" and epoch is not None:
                    fresh.append(line)
        if fresh:
            self.sentences.appendList([(x,) for x in fresh])
        self.place.update((following, rest, epoch))


def read_pieces(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """A stream of the files below ``path`` named ``RECEIVER_NUMBER.EXTENSION``: receiver, piece, text."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    name = F.element_at(F.split("path", "/"), -1)
    part = lambda i: F.regexp_extract(name, r"^(.*)_(\d+)\.[^.]*$", i)
    found = files.option("maxFilesPerTrigger", files_per_batch).load(path)
    found = found.select(part(1).alias("receiver"), part(2).try_cast("long").alias("piece"), F.decode("content", "ISO-8859-1").alias("text"))
    return found.where("piece is not null")


def epochs(stream: DataFrame, patience_ms: int = 600_000) -> DataFrame:
    """receiver, epoch (seconds of day), sv, snr of a stream of pieces: the greatest strength of each epoch and satellite, as the batch reader has it.

    Each epoch comes once. Sentences of an epoch that arrive after a timer gave
    it out come as that epoch again.
    """
    whole = stream.groupBy("receiver").transformWithState(EpochsOfPieces(patience_ms), SCHEMA, "append", "processingTime")
    seen = F.filter(F.flatten(F.transform("sentences", satellites_in_view)), lambda s: s["sv"].isNotNull())
    of = lambda seen, sv: F.array_max(F.transform(F.filter(seen, lambda s: s["sv"] == sv), lambda s: s["snr"]))
    each = whole.withColumn("seen", seen).select("receiver", "epoch", F.explode(F.transform(F.array_distinct(F.transform("seen", lambda s: s["sv"])), lambda sv: F.struct(sv.alias("sv"), of(F.col("seen"), sv).alias("snr")))).alias("s"))
    return each.select("receiver", "epoch", "s.sv", "s.snr")
