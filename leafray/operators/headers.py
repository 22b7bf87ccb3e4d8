"""Rules of the RINEX 3.04 format for observation files: each a boolean over a file's header and the sums of its body."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the format: the codes' last letters by system and band, record types, and header lines that a file must have.
ATTRIBUTES = {
    "G": {"1": "CSLXPWYMN", "2": "CDSLXPWYMN", "5": "IQX"},
    "R": {"1": "CP", "2": "CP", "3": "IQX", "4": "ABX", "6": "ABX"},
    "E": {"1": "ABCXZ", "5": "IQX", "7": "IQX", "8": "IQX", "6": "ABCXZ"},
    "S": {"1": "C", "5": "IQX"},
    "J": {"1": "CSLXZ", "2": "SLX", "5": "IQXDPZ", "6": "SLXEZ"},
    "C": {"2": "IQX", "1": "DPXAN", "5": "DPX", "7": "IQXDPZ", "8": "DPX", "6": "IQXA"},
    "I": {"5": "ABCX", "9": "ABCX"},
}
KINDS = ("C", "L", "D", "S")
REQUIRED = (
    "RINEX VERSION / TYPE",
    "PGM / RUN BY / DATE",
    "MARKER NAME",
    "OBSERVER / AGENCY",
    "REC # / TYPE / VERS",
    "ANT # / TYPE",
    "APPROX POSITION XYZ",
    "ANTENNA: DELTA H/E/N",
    "SYS / # / OBS TYPES",
    "TIME OF FIRST OBS",
    "END OF HEADER",
)
#: Metres that a pseudorange, and dB-Hz that a strength, lies between.
RANGE_LIMITS, STRENGTH_LIMITS = (1.0e7, 6.0e7), (0.0, 70.0)


def body_facts(obs: DataFrame) -> DataFrame:
    """Sums over the observations of each file, in one aggregation: first and last epoch, values out of range, signals of systems the header must know."""
    outside = lambda c, lo, hi: F.count_if((F.col(c) < lo) | (F.col(c) > hi))
    return obs.groupBy("file").agg(
        F.min("epoch").alias("begin"),
        F.max("epoch").alias("end"),
        outside("pseudorange", *RANGE_LIMITS).alias("bad_ranges"),
        outside("snr", *STRENGTH_LIMITS).alias("bad_strengths"),
        F.count_if(F.col("sid").contains("UnknownBand")).alias("unknown_bands"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def rules() -> dict[str, Column]:
    """Name and condition of each rule, over the columns of a header and of ``body_facts``; null counts as broken."""
    systems = list(ATTRIBUTES)
    names = F.flatten(F.map_values("codes"))
    known = F.array(*[F.lit(s + b + a) for s, bands in ATTRIBUTES.items() for b, letters in bands.items() for a in letters])
    with_band = F.array(*[F.lit(s + b) for s, bands in ATTRIBUTES.items() for b in bands])
    each = F.map_entries("codes")
    # codes of known systems, with the system in front of band and letter
    full = F.flatten(F.transform(F.filter(each, lambda e: e.key.isin(systems)), lambda e: F.transform(e.value, lambda c: F.concat(e.key, F.substring(c, 2, 2)))))
    glonass = F.map_contains_key("codes", "R")
    none = F.lit(0)
    return {
        "version": F.col("version").between(3.0, 3.05),
        "required_lines": F.size(F.array_except(F.array(*[F.lit(x) for x in REQUIRED]), F.col("labels"))) == 0,
        "known_systems": F.forall(F.map_keys("codes"), lambda s: s.isin(systems)),
        "code_format": F.forall(names, lambda c: (F.length(c) == 3) & F.substring(c, 1, 1).isin(*KINDS)),
        "bands": F.forall(full, lambda c: F.array_contains(with_band, F.substring(c, 1, 2))),
        # only where the band is known, as another rule speaks of the band
        "attributes": F.forall(full, lambda c: ~F.array_contains(with_band, F.substring(c, 1, 2)) | F.array_contains(known, c)),
        "code_counts": F.forall(each, lambda e: F.coalesce(F.col("code_counts")[e.key] == F.size(e.value), F.lit(False))),
        "glonass_slots": ~glonass | (F.size("slots") > 0),
        "glonass_biases": ~glonass | F.array_contains("labels", "GLONASS COD/PHS/BIS"),
        "phase_shifts": F.forall("phase_shifts", lambda p: F.map_contains_key("codes", p["system"]) & ((p["code"] == "") | F.array_contains(F.col("codes")[p["system"]], p["code"]))),
        "position": F.coalesce((F.size("position") == 3) & ~F.exists("position", lambda x: x.isNull()), F.lit(False)),
        "first_epoch": F.col("begin").isNull() | (F.col("begin") == F.col("first_obs")),
        "last_epoch": F.col("end").isNull() | F.col("last_obs").isNull() | (F.col("end") == F.col("last_obs")),
        "ranges": F.coalesce("bad_ranges", none) == 0,
        "strengths": F.coalesce("bad_strengths", none) == 0,
        "known_bands": F.coalesce("unknown_bands", none) == 0,
    }


def header_conformance(headers: DataFrame, obs: DataFrame) -> DataFrame:
    """One row per file: n_rows, a boolean per rule, and ``broken``, the names of the rules that it breaks.

    Bodies are summed before they meet the headers, so what is joined has one
    row per file on either side.
    """
    both = headers.join(body_facts(obs), "file", "left")
    checked = {n: F.coalesce(c, F.lit(False)) for n, c in rules().items()}
    out = both.select("file", "marker_name", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), *[c.alias(n) for n, c in checked.items()])
    return out.withColumn("broken", F.filter(F.array(*[F.when(~F.col(n), F.lit(n)) for n in checked]), lambda n: n.isNotNull()))
