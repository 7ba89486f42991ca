"""Scalar Column expressions.  All JVM-side (no Python UDFs) so they stay
inside whole-stage codegen, and all time handling is TIMESTAMP_NTZ-native
so results do not depend on the session time zone."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicspark import constants as C

__all__ = [
    "safe_float", "negative_as_null", "guarded_rate", "lookup_or_default",
    "get_or_default", "epoch_to_ntz", "ntz_to_epoch", "iso_to_ntz", "ntz_to_iso_ms",
    "lookback_bound", "validate_mode", "over_length", "normalise_borough",
    "local_day", "text_or_null", "round_exact", "utc_now", "as_of_literal", "county_borough_map", "zip_header",
]

def epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")

# decimal / exponent / inf / nan text as accepted by a float() parse; Java-only
# forms (``1d``, ``0x1p3``) are rejected before the cast.
_FLOAT_TEXT = r"^\s*[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_float(x) -> Column:
    """Unparsable or NULL text -> NULL; negative "no data" sentinels -> NULL."""
    x = _c(x).cast("string")
    parsed = F.when(x.rlike(_FLOAT_TEXT), F.trim(x).try_cast("double"))
    return negative_as_null(parsed)


def negative_as_null(x) -> Column:
    x = _c(x)
    return F.when(x < 0, F.lit(None).cast("double")).otherwise(x)


def guarded_rate(part, total, scale: float = 100.0, digits: int = 2) -> Column:
    """round(part / total * scale, digits) when total is a positive number and
    part is known; else NULL.  NaN totals give NULL (NaN > 0 is true in Spark)."""
    part, total = _c(part), _c(total)
    ok = total.isNotNull() & ~F.isnan(total) & (total > 0) & part.isNotNull()
    return F.when(ok, round_exact(part / total * F.lit(scale), digits))


def round_exact(x, digits: int) -> Column:
    """Rounded as the exact binary value demands, true ties to even.  ``F.round`` works on the
    shortest decimal text, so 2.675 (just below the tie) would go up.  Where ten times the
    scaled value is next to a five, the product's rounding error (exact, by splitting the factor)
    tells on which side of the tie the value lies."""
    x = _c(x)
    scale = 10.0 ** (digits + 1)
    p, c = x * F.lit(scale), x * F.lit(134217729.0)
    hi = c - (c - x)
    q = F.rint(p)
    err = (p - q) + ((hi * F.lit(scale) - p) + (x - hi) * F.lit(scale))
    low = F.floor(q / F.lit(10.0)).cast("double")
    up = (err > 0) | ((err == 0) & (F.pmod(low, F.lit(2.0)) == 1))
    tie = (F.abs(x) < 1e12) & (F.pmod(q, F.lit(10.0)) == 5)
    return F.when(tie, F.when(up, low + 1).otherwise(low) / F.lit(10.0 ** digits)).otherwise(F.round(x, digits))


def utc_now() -> Column:
    """Now as naive UTC, whatever the session's zone."""
    return F.expr("convert_timezone(current_timezone(), 'UTC', cast(current_timestamp() as timestamp_ntz))")


def lookup_or_default(mapping: dict[str, str], key, default: str) -> Column:
    """Static dictionary lookup with a default for absent keys."""
    m = F.create_map(*[F.lit(v) for kv in sorted(mapping.items()) for v in kv])
    return F.coalesce(F.try_element_at(m, _c(key)), F.lit(default))


def county_borough_map() -> Column:
    return F.create_map(*[F.lit(v) for kv in sorted(C.COUNTY_BOROUGH.items()) for v in kv])


def get_or_default(m, key: str, default) -> Column:
    """``dict.get(key, default)`` on a map column: the default only when the key is
    absent; a present key with a JSON null stays NULL (so not ``coalesce``)."""
    m = _c(m)
    return F.when(F.map_contains_key(m, F.lit(key)), m[key]).otherwise(F.lit(default))


def epoch_to_ntz(x) -> Column:
    """Epoch seconds -> naive UTC timestamp, independent of the session zone."""
    return F.timestamp_add("SECOND", _c(x).cast("long"), epoch_ntz())


def ntz_to_epoch(x) -> Column:
    """Naive UTC timestamp -> whole epoch seconds (floor)."""
    return F.timestamp_diff("SECOND", epoch_ntz(), _c(x))


def iso_to_ntz(x) -> Column:
    """ISO-8601 text (``T`` separator, optional fraction/offset) -> TIMESTAMP_NTZ.
    The offset is ignored (all feed times are UTC); '' and bad text -> NULL."""
    return F.nullif(_c(x), F.lit("")).try_cast("timestamp_ntz")


def ntz_to_iso_ms(x) -> Column:
    return F.date_format(_c(x), "yyyy-MM-dd'T'HH:mm:ss.SSS")


def text_or_null(x) -> Column:
    return F.nullif(_c(x), F.lit(""))


def validate_mode(mode: str) -> int:
    if mode not in C.LOOKBACK_DAYS:
        raise ValueError(f"mode must be one of {sorted(C.LOOKBACK_DAYS)}, not {mode!r}")
    return C.LOOKBACK_DAYS[mode]


def as_of_literal(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.replace(tzinfo=None).isoformat(sep=" ")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def lookback_bound(mode: str, as_of) -> Column:
    """Inclusive lower bound of a load window: midnight of (as_of - n days)."""
    days = validate_mode(mode)
    shifted = F.timestamp_add("DAY", F.lit(-days), as_of_literal(as_of))
    return F.to_date(shifted).cast("timestamp_ntz")


def over_length(x, n: int) -> Column:
    return F.coalesce(F.length(_c(x)) > F.lit(n), F.lit(False))


def normalise_borough(x) -> Column:
    """Join key for borough text from different feeds: trimmed, upper case,
    inner runs of blanks collapsed."""
    return F.upper(F.regexp_replace(F.trim(_c(x)), r"\s+", " "))


def local_day(x, zone: str = "America/New_York") -> Column:
    """Naive-UTC timestamp -> calendar day in the city's zone (DST-aware)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _c(x)).cast("date")


def zip_header(header, cells) -> Column:
    """``dict(zip(header, cells))``: pairs up to the shorter side, and for a
    repeated header name the last pair wins."""
    header, cells = _c(header), _c(cells)
    n = F.least(F.size(header), F.size(cells))
    hs, cs = F.slice(header, 1, n), F.slice(cells, 1, n)
    pairs = F.transform(hs, lambda k, i: F.struct(k.alias("k"), F.get(cs, i).alias("v")))
    last = F.filter(pairs, lambda e, i: ~F.array_contains(F.slice(hs, i + 2, n), e["k"]))
    return F.map_from_entries(last)
