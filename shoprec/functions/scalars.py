"""Scalar column expressions. All are built-in functions, so they stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The prefix that marks a rating in the application log, and the size
# above which an epoch value is taken as milliseconds.
RATING_PREFIX = "PRODUCT_RATING_PREFIX:"
MILLIS_ABOVE = 100_000_000_000

# Similarities and scores are rounded before they are compared or ranked: the order of a
# distributed sum varies from run to run, and unrounded ties would change places with it.
DIGITS = 6

_SCALE = 10.0**DIGITS
_BLANKS = "".join(map(chr, range(33)))


def trimmed(text: Column) -> Column:
    """Strip blanks and control characters at both ends."""
    return F.btrim(text, F.lit(_BLANKS))


def rounded(value: Column) -> Column:
    """Value to DIGITS places, halves away from zero. Plain arithmetic: `round` on a double
    goes through a decimal object for each row."""
    return F.signum(value) * F.floor(F.abs(value) * _SCALE + 0.5) / _SCALE


def epoch_seconds(ts: Column, unit: str = "auto") -> Column:
    """Epoch seconds from a value in seconds or millis; auto tells the unit by the size."""
    millis = F.floor(ts / 1000)
    if unit == "seconds":
        return ts.cast("bigint")
    if unit == "millis":
        return millis.cast("bigint")
    if unit != "auto":
        raise ValueError(f"unit is 'seconds', 'millis' or 'auto', not {unit!r}")
    return F.when(ts > MILLIS_ABOVE, millis).otherwise(ts).cast("bigint")


def year_month(ts: Column) -> Column:
    """Epoch seconds to a yyyyMM integer in UTC, whatever the session time zone."""
    day = F.date_from_unix_date(F.floor(ts / 86400).cast("int"))
    return (F.year(day) * 100 + F.month(day)).cast("int")


def half_score(score: Column) -> Column:
    """Ten-star score to the five-point scale, two decimals."""
    return F.round(score / 2, 2)


def name_id(name: Column) -> Column:
    """32-bit id of a name: h = 31 * h + c over its UTF-16 code units, wrapped."""
    units = F.regexp_extract_all(F.hex(F.encode(name, "UTF-16BE")), F.lit("(....)"), F.lit(1))
    unsigned = F.aggregate(
        units,
        F.lit(0).cast("bigint"),
        lambda h, u: (h * 31 + F.conv(u, 16, 10).cast("bigint")).bitwiseAND(F.lit(0xFFFFFFFF)),
    )
    return F.when(unsigned >= 2**31, unsigned - 2**32).otherwise(unsigned).cast("int")


def tokens(tags: Column) -> Column:
    """Lower-cased words of a `|`-separated tag string."""
    words = F.lower(F.translate(tags, "|", " "))
    return F.split(F.regexp_replace(words, r"\s+$", ""), r"\s")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two dense vectors; null when one of them is zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))
