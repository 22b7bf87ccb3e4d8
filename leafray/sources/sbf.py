"""Receiver binary blocks (SBF): observations, and what the receiver says about epochs and satellites.

Python only finds the blocks and copies their integer fields, one row per
sub-block; scaling, signals, satellites and times are columns and joins. Files
are one task each, since blocks have no fixed places and a file is a day or less
of one receiver.
"""

from __future__ import annotations

import binascii
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafray.functions import gnss
from leafray.operators import joins, signals
from leafray.sources.scratch import shared_folder

# Block numbers.
MEAS_EPOCH, CHANNEL_STATUS, SAT_VISIBILITY, PVT_GEODETIC, DOP, RECEIVER_TIME = 4027, 4013, 4012, 4007, 4001, 5914
# Signal number, system, band, tracking code.
SIGNALS = [
    (0, "G", "L1", "C"), (1, "G", "L1", "W"), (2, "G", "L2", "W"), (3, "G", "L2", "L"), (4, "G", "L5", "Q"), (5, "G", "L1", "L"),
    (6, "J", "L1", "C"), (7, "J", "L2", "L"),
    (8, "R", "G1", "C"), (9, "R", "G1", "P"), (10, "R", "G2", "P"), (11, "R", "G2", "C"), (12, "R", "G3", "Q"),
    (13, "C", "B1C", "P"), (14, "C", "B2a", "P"),
    (15, "I", "L5", "A"),
    (17, "E", "E1", "C"), (19, "E", "E6", "C"), (20, "E", "E5a", "Q"), (21, "E", "E5b", "Q"), (22, "E", "E5", "Q"),
    (24, "S", "L1", "C"), (25, "S", "L5", "I"),
    (26, "J", "L5", "Q"), (27, "J", "L6", "E"),
    (28, "C", "B1I", "I"), (29, "C", "B2I", "I"), (30, "C", "B3I", "I"),
    (32, "J", "L1", "L"), (33, "J", "L1", "Z"),
    (34, "C", "B2b", "D"),
    (38, "J", "L1", "E"), (39, "J", "L5", "P"),
]
# Seconds that GPS time is ahead of UTC where a file doesn't say.
LEAP_SECONDS = 18

_FIELDS = "block week tow svid rx_channel type obs_info misc code_low doppler carrier_low carrier_high cn0 lock_time offset_high code_offset doppler_offset first_type first_info freq_nr azimuth elevation leap".split()
_RAW = "file string, seq long, second boolean, " + ", ".join(f"{c} long" for c in _FIELDS) + ", lat double, lon double, height double, pdop double, hdop double, vdop double"
_DOUBLES = ("lat", "lon", "height", "pdop", "hdop", "vdop")


def crc(data: bytes) -> int:
    """CRC-16 of the CCITT polynomial, from 0."""
    return binascii.crc_hqx(data, 0)


def blocks(data: bytes) -> Iterator[tuple[int, bytes]]:
    """Number and body (from the time on) of each whole block; damaged ones are passed over."""
    at = data.find(b"$@")
    while 0 <= at <= len(data) - 14:
        check, number, length = struct.unpack_from("<HHH", data, at + 2)
        if length >= 14 and length % 4 == 0 and at + length <= len(data) and crc(data[at + 4 : at + length]) == check:
            yield number & 0x1FFF, data[at + 8 : at + length]
            at = data.find(b"$@", at + length)
        else:
            at = data.find(b"$@", at + 2)


def _measurements(body: bytes) -> Iterator[dict]:
    n, size1, size2 = struct.unpack_from("<BBB", body, 6)
    at = 12
    for _ in range(n):
        names = ("rx_channel", "type", "svid", "misc", "code_low", "doppler", "carrier_low", "carrier_high", "cn0", "lock_time", "obs_info", "n2")
        one = dict(zip(names, struct.unpack_from("<BBBBIiHbBHBB", body, at), strict=True))
        at += size1
        n2 = one.pop("n2")
        yield one | {"second": False}
        shared = {k: one[k] for k in ("svid", "misc", "code_low", "doppler")} | {"first_type": one["type"], "first_info": one["obs_info"]}
        for _ in range(n2):
            names = ("type", "lock_time", "cn0", "offset_high", "carrier_high", "obs_info", "code_offset", "carrier_low", "doppler_offset")
            yield shared | dict(zip(names, struct.unpack_from("<BBBBbBHHH", body, at), strict=True)) | {"second": True}
            at += size2


def rows(data: bytes) -> Iterator[dict]:
    """The integer fields of every sub-block that is read, with its block and time, in order."""
    for seq, (number, body) in enumerate(blocks(data)):
        tow, week = struct.unpack_from("<IH", body)
        head, found = {"seq": seq, "block": number, "tow": tow, "week": week}, []
        if number == MEAS_EPOCH:
            found = _measurements(body)
        elif number == RECEIVER_TIME:
            found = [{"leap": struct.unpack_from("<b", body, 12)[0]}]
        elif number == SAT_VISIBILITY:
            n, size = struct.unpack_from("<BB", body, 6)
            found = (dict(zip(("svid", "freq_nr", "azimuth", "elevation"), struct.unpack_from("<BBHh", body, 8 + k * size), strict=True)) for k in range(n))
        elif number == CHANNEL_STATUS:
            n, size1, size2 = struct.unpack_from("<BBB", body, 6)
            at, found = 12, []
            for _ in range(n):
                found.append(dict(zip(("svid", "freq_nr"), struct.unpack_from("<BB", body, at), strict=True)))
                at += size1 + size2 * body[at + 9]
        elif number == PVT_GEODETIC:
            place = struct.unpack_from("<ddd", body, 8)
            found = [{k: v if v != -2e10 else None for k, v in zip(("lat", "lon", "height"), place, strict=True)}]
        elif number == DOP:
            p, _, h, v = struct.unpack_from("<HHHH", body, 8)
            found = [{k: x * 0.01 if x else None for k, x in (("pdop", p), ("hdop", h), ("vdop", v))}]
        for row in found:
            yield head | row


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Raw rows of all files at ``path``."""
    kinds = [("file", pa.string()), ("seq", pa.int64()), ("second", pa.bool_()), *[(c, pa.int64()) for c in _FIELDS], *[(c, pa.float64()) for c in _DOUBLES]]
    schema = pa.schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held = []
                for row in rows(content):
                    held.append({"file": file} | row)
                    if len(held) == 20_000:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held = []
                yield pa.RecordBatch.from_pylist(held, schema)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, _RAW)


#: Blocks that observations need, and those that metadata need; times come from measurements and receiver times.
OF_OBSERVATIONS = (MEAS_EPOCH, CHANNEL_STATUS, RECEIVER_TIME)
OF_METADATA = (PVT_GEODETIC, DOP, SAT_VISIBILITY, MEAS_EPOCH, RECEIVER_TIME)


def store_blocks(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """Raw rows of all files at ``path``, decoded once and kept in ``folder`` by kind of block; what reads them skips the kinds that it doesn't need."""
    names = read_blocks(spark, path).columns
    read_blocks(spark, path).write.mode("overwrite").partitionBy("block").parquet(folder)
    return spark.read.schema(_RAW).parquet(folder).select(*names)


def outputs(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Observations, and metadata per epoch and per satellite, from one pass over the files."""
    raw = store_blocks(spark, path, shared_folder(spark, "blocks"))
    return observations(spark, raw), *metadata(spark, raw)


def _timed(raw: DataFrame) -> DataFrame:
    """Adds ``epoch`` in UTC, by the leap seconds last said in the file."""
    said = F.last("leap", ignorenulls=True).over(Window.partitionBy("file").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0))
    return raw.withColumn("epoch", gnss.tow_to_time(F.col("week"), F.col("tow"), F.coalesce(said, F.lit(LEAP_SECONDS))))


def _satellites(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Adds system and sv of the receiver's own satellite numbers; unknown ones go."""
    known = joins.in_ranges(df, signals.number_ranges(spark), "svid", ["system", "shift"]).where("system is not null")
    return known.withColumn("sv", F.concat("system", F.lpad((F.col("svid") - F.col("shift")).cast("string"), 2, "0"))).drop("shift")


def observations(spark: SparkSession, raw: DataFrame) -> DataFrame:
    """file, epoch, sid, snr, pseudorange, phase, doppler of the measurements among raw rows.

    Signals that aren't known go. Carrier frequencies of GLONASS need the slot
    that a channel status of the file tells; without it phase is null, and so
    are all second signals of a first one without frequency, range or doppler.
    """
    raw = raw.where(F.col("block").isin(*OF_OBSERVATIONS))
    slots = raw.where((F.col("block") == CHANNEL_STATUS) & (F.col("svid") != 0)).groupBy("file", "svid").agg(F.max_by("freq_nr", "seq").alias("slot"))
    table = spark.createDataFrame(SIGNALS, "number int, of string, band string, code string")
    centre = spark.createDataFrame([(s, b, f) for s, b, f, *_ in signals.BANDS if b not in ("G1", "G2")] + [("C", "B2I", 1207.14)], "of string, band string, fixed double")
    table = F.broadcast(table.join(centre, ["of", "band"], "left"))
    m = _timed(raw).where(F.col("block") == MEAS_EPOCH)
    m = m.withColumn("number", gnss.signal_number(F.col("type"), F.col("obs_info"))).withColumn("first_number", gnss.signal_number(F.col("first_type"), F.col("first_info")))
    first = table.select(F.col("number").alias("first_number"), F.col("band").alias("first_band"), F.col("fixed").alias("first_fixed"))
    m = m.join(table, "number").join(first, "first_number", "left").join(slots, ["file", "svid"], "left")
    hertz = lambda fixed, band: F.coalesce(F.col(fixed), gnss.glonass_frequency(F.col(band), F.col("slot"))) * 1e6
    m = m.withColumn("hz", hertz("fixed", "band")).withColumn("first_hz", hertz("first_fixed", "first_band"))
    range1, doppler1 = gnss.pseudorange(F.col("misc"), F.col("code_low")), gnss.doppler(F.col("doppler"))
    whole = range1.isNotNull() & doppler1.isNotNull() & F.col("first_hz").isNotNull()
    m = m.where(~F.col("second") | whole)
    m = m.withColumn("pseudorange", F.when(F.col("second"), gnss.second_pseudorange(range1, F.col("offset_high"), F.col("code_offset"))).otherwise(range1))
    m = m.withColumn("doppler", F.when(F.col("second"), gnss.second_doppler(doppler1, F.col("offset_high"), F.col("doppler_offset"), F.col("hz") / F.col("first_hz"))).otherwise(doppler1))
    m = m.withColumn("phase", gnss.carrier_phase(F.col("pseudorange"), F.col("carrier_high"), F.col("carrier_low"), F.col("hz")))
    m = _satellites(spark, m.withColumn("snr", gnss.cn0(F.col("cn0"), F.col("number"))))
    return m.select("file", "epoch", gnss.make_sid(F.col("sv"), F.col("band"), F.col("code")).alias("sid"), "snr", "pseudorange", "phase", "doppler")


def metadata(spark: SparkSession, raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per epoch (file, epoch, lat, lon, height, pdop, hdop, vdop) and per satellite (file, epoch, sv, theta, phi in radians).

    These blocks come before the measurement that they belong to, so each takes
    the time of the next one in its file; what follows the last one goes.
    """
    after = Window.partitionBy("file").orderBy(F.desc("seq")).rowsBetween(Window.unboundedPreceding, 0)
    raw = raw.where(F.col("block").isin(*OF_METADATA))
    t = _timed(raw).withColumn("epoch", F.last(F.when(F.col("block") == MEAS_EPOCH, F.col("epoch")), ignorenulls=True).over(after)).where("epoch is not null")
    of_epoch = t.where(F.col("block").isin(PVT_GEODETIC, DOP)).groupBy("file", "epoch").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq"))).alias(c) for c in _DOUBLES])
    seen = _satellites(spark, t.where((F.col("block") == SAT_VISIBILITY) & (F.col("azimuth") != 65535) & (F.col("elevation") != -32768)))
    seen = seen.withColumn("theta", F.radians(90 - F.col("elevation") * 0.01)).withColumn("phi", F.radians(F.col("azimuth") * 0.01))
    return of_epoch, seen.groupBy("file", "epoch", "sv").agg(*[F.max_by(c, "seq").alias(c) for c in ("theta", "phi")])
