"""Scalar rules of timetable data as Column expressions."""

from __future__ import annotations

from unicodedata import normalize

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_METRES = 6_371_000
# fixed values of the walking model
DETOUR, METRES_PER_SECOND, EXTRA_SECONDS, LEAST_SECONDS, WALKABLE_METRES, FAR_METRES = 1.35, 1.2, 60, 120, 400, 700
UMLAUTS = {"ä": "ae", "ö": "oe", "ü": "ue", "ß": "ss"}


def filled(c: Column) -> Column:
    """The text trimmed, or null if nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def first_filled(*cs: Column) -> Column:
    return F.coalesce(*[filled(c) for c in cs])


def area_id(parent: Column, stop: Column) -> Column:
    return F.coalesce(filled(parent), stop)


def trimmed(text: Column) -> Column:
    """Without control characters and spaces at both ends."""
    return F.regexp_replace(text, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def plain(name: Column) -> Column:
    """Search form of a text without compatibility forms: lower case, umlauts spelled out, '&' and '+' as "und", punctuation and white space as one space."""
    out = F.lower(F.coalesce(trimmed(name), F.lit("")))
    for a, b in UMLAUTS.items():
        out = F.replace(out, F.lit(a), F.lit(b))
    out = F.regexp_replace(out, "[&+]", " und ")
    out = F.regexp_replace(out, r"[!-/:-@\[-`{-~]+", " ")
    return trimmed(F.regexp_replace(out, r"[ \t\n\x0B\f\r]+", " "))


def normalised(name: Column) -> Column:
    """``plain`` after compatibility forms are folded (NFKC)."""
    return plain(nfkc(name))


def nfkc(name: Column) -> Column:
    """Compatibility forms folded and accents composed; Arrow batches, as no column function does it. ASCII texts are passed through.

    Arrow arrays spare the workers pandas; that it isn't called deterministic keeps Spark
    from folding a name again, in a worker of its own, for a filter on the result.
    """

    @F.arrow_udf("string")
    def fold(s: pa.Array) -> pa.Array:
        return pa.array([x if x is None or x.isascii() else normalize("NFKC", x) for x in s.to_pylist()], pa.string())

    return fold.asNondeterministic()(name)


def contains_token(normal: Column, token: str) -> Column:
    return F.concat(F.lit(" "), normal, F.lit(" ")).contains(f" {token} ")


def seconds(time: Column) -> Column:
    """Seconds since the start of the service day of H+:MM:SS; hours may pass 24; anything else raises."""
    ok = F.trim(time).rlike(r"^[0-9]+:[0-5][0-9]:[0-5][0-9]$")
    parts = F.split(F.trim(time), ":")
    return F.when(ok, parts[0].cast("int") * 3600 + parts[1].cast("int") * 60 + parts[2].cast("int")).when(time.isNotNull(), F.raise_error(F.concat(F.lit("not a time: "), time)).cast("int"))


def lenient_seconds(time: Column) -> Column:
    return F.when(F.coalesce(F.trim(time), F.lit("")) == "", F.lit(-1)).otherwise(seconds(time))


def clock(secs: Column) -> Column:
    return F.when(secs < 0, F.lit("")).otherwise(F.format_string("%02d:%02d:%02d", F.floor(secs / 3600), F.floor(secs / 60) % 60, secs % 60))


def service_date(text: Column) -> Column:
    """YYYYMMDD or YYYY-MM-DD; null for anything else."""
    return F.coalesce(F.try_to_date(text, "yyyyMMdd"), F.try_to_date(text, "yyyy-MM-dd"))


def metres(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance, rounded half up to whole metres."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.floor(F.lit(2.0 * EARTH_METRES) * F.atan2(F.sqrt(a), F.sqrt(1 - a)) + F.lit(0.5)).cast("long")


def cell(coordinate: Column, size: float) -> Column:
    return F.floor(coordinate / F.lit(size)).cast("long")


def walking_seconds(distance: Column) -> Column:
    return F.greatest(F.lit(LEAST_SECONDS).cast("long"), F.ceil(distance * F.lit(DETOUR) / F.lit(METRES_PER_SECOND)).cast("long") + EXTRA_SECONDS)


def band(value: Column, limits: list[tuple[float, str]], beyond: str, unknown: str = "UNKNOWN") -> Column:
    out = F.when(value.isNull(), F.lit(unknown))
    for limit, name in limits:
        out = out.when(value <= limit, F.lit(name))
    return out.otherwise(F.lit(beyond))


def line_label(short: Column, long: Column, route: Column) -> Column:
    return F.coalesce(first_filled(short, long), route)


def transfer_semantic(kind: Column) -> Column:
    names = ["RECOMMENDED", "TIMED", "MINIMUM_TIME", "PROHIBITED", "IN_SEAT_ALLOWED", "IN_SEAT_FORBIDDEN"]
    out = F.when(kind.isNull(), F.lit(names[0]))
    for k, name in enumerate(names):
        out = out.when(kind == k, F.lit(name))
    return out.otherwise(F.lit("UNKNOWN"))


def transfer_scope(routes: list[Column], trips: list[Column], service: Column) -> Column:
    """What a transfer is bound to, at either of its ends."""
    has = lambda *cs: F.coalesce(*[filled(c) for c in cs]).isNotNull()
    return F.when(has(*trips) & has(service), "TRIP_SERVICE").when(has(*trips), "TRIP").when(has(*routes), "ROUTE").when(has(service), "SERVICE").otherwise("STOP")


def pedestrian(kind: Column, scope: Column) -> Column:
    return (scope == "STOP") & F.coalesce(kind.isin(0, 2), F.lit(True))


def route_family(kind: Column) -> Column:
    """Extended route types as basic ones; -1 for null."""
    out = F.when(kind.isNull(), F.lit(-1))
    for low, high, basic in ((100, 199, 2), (200, 299, 3), (300, 399, 2), (400, 699, 1), (700, 799, 3), (800, 899, 11), (900, 999, 0), (1000, 1099, 4), (1200, 1299, 4), (1300, 1399, 6), (1400, 1499, 7)):
        out = out.when(kind.between(low, high), F.lit(basic))
    return out.otherwise(kind)


def is_train(kind: Column) -> Column:
    return F.coalesce((kind == 2) | kind.between(100, 109), F.lit(False))


def is_subway(kind: Column) -> Column:
    return F.coalesce(kind.isin(1, 400, 401), F.lit(False))


def is_tram(kind: Column) -> Column:
    return F.coalesce(kind.isin(0, 900, 901), F.lit(False))


def is_bus(kind: Column) -> Column:
    return F.coalesce((kind == 3) | kind.between(700, 709), F.lit(False))


def is_rail_label(label: Column) -> Column:
    """Whether a label begins like a train's or, with a digit behind the S, like a suburban train's."""
    return F.coalesce(F.upper(trimmed(label)).rlike(r"^(?:(?:ICE|IC|EC|ECE|RE|RB)|S[0-9])"), F.lit(False))


def footpath_quality(metres_: Column) -> Column:
    """Quality of a footpath; beyond what is walkable, and without a distance, it is unknown."""
    return band(metres_, [(80, "GOOD"), (200, "ESTIMATED"), (WALKABLE_METRES, "LOW")], "UNKNOWN")


def seconds_quality(secs: Column) -> Column:
    return band(secs, [(240, "GOOD"), (360, "OK"), (600, "LONG")], "AVOID")


def candidate_quality(metres_: Column) -> Column:
    return band(metres_, [(200, "CANDIDATE"), (400, "LOW")], "UNKNOWN")


def family_quality(metres_: Column) -> Column:
    return band(metres_, [(200, "GOOD"), (400, "OK")], "LONG", unknown="GOOD")


def access_minutes(metres_: Column) -> Column:
    return F.when(metres_.isNull() | (metres_ <= 80), 2).when(metres_ <= 200, 4).when(metres_ <= 400, 6).otherwise(10)


def sanitised(text: Column) -> Column:
    return F.regexp_replace(text, "[^A-Za-z0-9]+", "_")


def service_active(mask: Column, day: Column) -> Column:
    """Whether the weekday mask (Monday 1 ... Sunday 64) has the day."""
    return mask.bitwiseAND(F.expr("1") * F.pow(F.lit(2), F.weekday(day)).cast("int")) != 0
