"""Signal identifiers, calendars, sentence checksums and raw-field decoding as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SV_PATTERN = r"^[GREJCIS]\d{2}$"
LIGHT_SPEED = 299_792_458.0


def sid_parts(sid: Column) -> dict[str, Column]:
    """Space vehicle, system, band and code of ``SV|band|code``; null parts for malformed identifiers."""
    parts = F.split(sid, r"\|")
    ok = F.size(parts) == 3
    pick = lambda i: F.when(ok, parts.getItem(i))
    return {"sv": pick(0), "system": F.substring(pick(0), 1, 1), "band": pick(1), "code": pick(2)}


def valid_sid(sid: Column) -> Column:
    parts = F.split(sid, r"\|")
    return (F.size(parts) == 3) & parts.getItem(0).rlike(SV_PATTERN)


def make_sid(sv: Column, band: Column, code: Column) -> Column:
    return F.concat_ws("|", sv, band, code)


def gps_week(ts: Column) -> Column:
    """Weeks since 1980-01-06."""
    return F.floor(F.datediff(F.to_date(ts), F.to_date(F.lit("1980-01-06"))) / 7).cast("int")


def gps_day_of_week(ts: Column) -> Column:
    return F.pmod(F.datediff(F.to_date(ts), F.to_date(F.lit("1980-01-06"))), F.lit(7))


def yyyydoy(ts: Column) -> Column:
    return F.concat(F.year(ts).cast("string"), F.lpad(F.dayofyear(ts).cast("string"), 3, "0"))


def date_of_yyyydoy(text: Column) -> Column:
    year = F.substring(text, 1, 4).cast("int")
    return F.date_add(F.make_date(year, F.lit(1), F.lit(1)), F.substring(text, 5, 3).cast("int") - 1)


def full_year(yy: Column) -> Column:
    """Two-digit years from 80 on belong to the last century."""
    return F.when(yy >= 80, yy + 1900).otherwise(yy + 2000)


def hour_of_letter(letter: Column) -> Column:
    """a to x are hours 0 to 23; a digit 0 marks a whole day."""
    low = F.lower(letter)
    return F.when(low == "0", F.lit(0)).when(low.rlike("^[a-x]$"), F.ascii(low) - 97)


def tow_to_time(week: Column, tow_ms: Column, leap_seconds: Column) -> Column:
    """UTC of a GPS week and time of week."""
    seconds = F.lit(315_964_800) + week.cast("long") * 604_800 - leap_seconds
    return F.timestamp_micros((seconds * 1_000_000 + tow_ms * 1000).cast("long")).cast("timestamp_ntz")


def nmea_checksum(payload: Column) -> Column:
    """XOR of the characters between $ and *, as two hex digits."""
    codes = F.transform(F.filter(F.split(payload, ""), lambda c: c != ""), lambda c: F.ascii(c))
    return F.lpad(F.hex(F.aggregate(codes, F.lit(0), lambda a, c: a.bitwiseXOR(c))), 2, "0")


def nmea_valid(sentence: Column) -> Column:
    payload = F.regexp_extract(sentence, r"^\$([^*]*)\*", 1)
    return (payload != "") & (F.upper(F.regexp_extract(sentence, r"\*([0-9A-Fa-f]{2})\s*$", 1)) == nmea_checksum(payload))


def cn0(raw: Column, signal: Column) -> Column:
    """Carrier-to-noise density in dB-Hz; 255 means none, two signals have no offset."""
    return F.when(raw != 255, raw * 0.25 + F.when(signal.isin(1, 2), 0.0).otherwise(10.0))


def pseudorange(misc: Column, low: Column) -> Column:
    """Metres from the 4 high and 32 low bits in millimetres; 0 and 0 mean none."""
    high = misc.bitwiseAND(15)
    return F.when((high != 0) | (low != 0), (high * 4294967296.0 + low) * 0.001)


def doppler(raw: Column) -> Column:
    return F.when(raw != -2147483648, raw * 1e-4)


def carrier_phase(range_m: Column, msb: Column, lsb: Column, frequency: Column) -> Column:
    """Cycles; -128 and 0 mean none."""
    return F.when(~((msb == -128) & (lsb == 0)), range_m / (LIGHT_SPEED / frequency) + (msb * 65536.0 + lsb) * 0.001)


def signed_bits(value: Column, bits: int) -> Column:
    v = value.bitwiseAND((1 << bits) - 1)
    return F.when(v >= 1 << (bits - 1), v - (1 << bits)).otherwise(v)


def signal_number(type_byte: Column, obs_info: Column) -> Column:
    """The low five bits of the type; 31 there means that the number is in the observation info, from 32 on."""
    low = type_byte.bitwiseAND(31)
    return F.when(low == 31, F.shiftright(obs_info, 3).bitwiseAND(31) + 32).otherwise(low)


def second_pseudorange(first: Column, offset_msb: Column, code_low: Column) -> Column:
    """Metres of a signal given as an offset from its satellite's first one; the three low bits of ``offset_msb`` are the high part."""
    return first + (signed_bits(offset_msb, 3) * 65536.0 + code_low) * 0.001


def second_doppler(first: Column, offset_msb: Column, low: Column, ratio: Column) -> Column:
    """Hertz of a signal given as an offset from the first one's, scaled by the ``ratio`` of frequencies; five high bits."""
    return first * ratio + (signed_bits(F.shiftright(offset_msb, 3), 5) * 65536.0 + low) * 1e-4


def glonass_frequency(band: Column, slot: Column) -> Column:
    """MHz of an FDMA slot numbered from 1 (slot 8 is channel 0)."""
    return F.when(band == "G1", 1602.0 + (slot - 8) * 9 / 16).when(band == "G2", 1246.0 + (slot - 8) * 7 / 16)


def file_digest(content: Column, prefix: int = 16) -> Column:
    return F.substring(F.sha2(content, 256), 1, prefix)


def is_float(text: Column) -> Column:
    return text.try_cast("double").isNotNull()
