"""Scalar rules of the normalised schema: durations, timestamps, file names, key=value strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text forms Python's float() takes: optional sign, digits with single inner
# underscores, fraction, exponent, or a non-finite name; blanks around are fine.
_DIGITS = r"[0-9](?:_?[0-9])*"
PYTHON_FLOAT = (
    rf"(?i)^\s*[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?|nan|inf|infinity)\s*$"
)

MIN_EPOCH, MAX_EPOCH = -62135596800, 253402300800  # years 1 to 9999


def float_text(text: Column) -> Column:
    """Number in a string, NULL where Python's ``float`` would refuse it."""
    return F.when(
        text.rlike(PYTHON_FLOAT),
        F.regexp_replace(F.trim(F.regexp_replace(text, r"\s", " ")), "_", "").try_cast("double"),
    )


def epoch_micros(seconds: Column) -> Column:
    """Microseconds since the epoch, rounded half to even on the fraction alone.

    Splitting off the whole seconds first keeps the fraction exact.
    """
    whole = F.when(seconds < 0, F.ceil(seconds)).otherwise(F.floor(seconds)).cast("bigint")
    return whole * F.lit(1_000_000) + F.rint((seconds - whole) * F.lit(1e6)).cast("bigint")


def epoch_in_range(seconds: Column) -> Column:
    """False for NaN, infinities and instants outside the years 1 to 9999."""
    inside = (seconds >= MIN_EPOCH) & (seconds < MAX_EPOCH) & ~F.isnan(seconds)
    return F.when(inside, epoch_micros(seconds) < F.lit(MAX_EPOCH * 1_000_000)).otherwise(False)


def epoch_iso(seconds: Column) -> Column:
    """ISO-8601 in UTC; the fraction is printed only if there is one; 0 and NULL give NULL."""
    micros = epoch_micros(seconds)
    instant = F.timestamp_micros(micros)
    return F.when(
        (seconds != 0) & epoch_in_range(seconds),
        F.when(
            F.pmod(micros, F.lit(1_000_000)) == 0,
            F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ssxxx"),
        ).otherwise(F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")),
    )


def decoded_path(uri: Column) -> Column:
    """Readable path of an encoded file URI; a literal plus sign stays one."""
    plain = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, "^file:/+", "/")


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def render_params(params: Column) -> Column:
    """``k=v,k=v`` from a map of strings, in map order; NULL values are left out."""
    kept = F.filter(F.map_entries(params), lambda e: e["value"].isNotNull())
    return F.array_join(F.transform(kept, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")


def render_nested_params(outer: Column, name: str, inner: Column) -> Column:
    """``k=v,...,name={k:v,k:v}``: the packed form with a braced list inside."""
    braced = F.array_join(
        F.transform(F.map_entries(inner), lambda e: F.concat(e["key"], F.lit(":"), e["value"])), ","
    )
    return F.concat_ws(",", render_params(outer), F.concat(F.lit(name + "={"), braced, F.lit("}")))


def _last_of_each(entries: Column) -> Column:
    """Map of ``(key, value)`` entries; the last of several with one key counts."""
    keys = F.reverse(F.transform(entries, lambda e: e["key"]))
    last = F.filter(entries, lambda e, i: i == F.size(entries) - F.array_position(keys, e["key"]))
    return F.map_from_entries(last)


def parse_params(text: Column) -> Column:
    """Map of the ``k=v`` pairs outside braces."""
    flat = F.trim(F.regexp_replace(text, r"(?:^|,)[A-Za-z_][\w.]*=\{[^}]*\}", ""))
    flat = F.regexp_replace(flat, "^,|,$", "")
    pairs = F.filter(F.split(flat, ","), lambda p: p.contains("="))
    return _last_of_each(
        F.transform(
            pairs,
            # only the first = separates, values such as think_end_token=</a=b> keep theirs
            lambda p: F.struct(
                F.substring_index(p, "=", 1).alias("key"),
                F.regexp_replace(p, "^[^=]*=", "").alias("value"),
            ),
        )
    )


def parse_nested_params(text: Column, name: str) -> Column:
    """Map inside ``name={k:v,k:v}``; empty if the list is absent."""
    inner = F.regexp_extract(text, rf"(?:^|,){name}=\{{([^}}]*)\}}", 1)
    pairs = F.filter(F.split(inner, ","), lambda p: p.contains(":"))
    return _last_of_each(
        F.transform(
            pairs,
            lambda p: F.struct(
                F.substring_index(p, ":", 1).alias("key"),
                F.regexp_replace(p, "^[^:]*:", "").alias("value"),
            ),
        )
    )
