"""Tolerant casts, time arithmetic and hash buckets."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HASH_SPAN = 2**32

# Layout of a double: 52 bits of fraction, exponents from -1022, 2047 for infinity.
_FRACTION = 2**52
_LOWEST = -1022
_INFINITE = 2047 * _FRACTION
# Twice the largest order of a score, and the times that still fit 38 digits with it.
_SPAN = Decimal(2**64)
_LATEST = 5 * 10**18


def column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(value: Column | str) -> Column:
    """Drop white space of every kind from both ends."""
    return F.regexp_replace(column(value), r"^\s+|\s+$", "")


def double_or_zero(value: Column | str) -> Column:
    """Read a number from text; anything else, and null, is 0."""
    return F.coalesce(column(value).try_cast("double"), F.lit(0.0))


def int_or_null(value: Column | str) -> Column:
    return column(value).try_cast("int")


def epoch_seconds(value: Column | str) -> Column:
    """Seconds since 1970 of a zone-free timestamp, whatever the session zone."""
    stamp = column(value)
    days = F.datediff(stamp.cast("date"), F.lit("1970-01-01").cast("date"))
    return (
        days.cast("long") * F.lit(86400)
        + F.hour(stamp) * F.lit(3600)
        + F.minute(stamp) * F.lit(60)
        + F.second(stamp)
    ).cast("long")


def seconds_to_timestamp(value: Column | str) -> Column:
    return F.timestamp_seconds(column(value))


def epoch_date(value: Column | str) -> Column:
    """Calendar day (UTC) of an epoch second, whatever the session zone."""
    days = F.floor(column(value) / F.lit(86400)).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)


def elapsed(first_seen: Column | str, last_seen: Column | str) -> Column:
    """Seconds between first and last sighting; 0 when either is missing or blank."""
    first = column(first_seen).cast("string").try_cast("long")
    last = column(last_seen).cast("string").try_cast("long")
    return F.coalesce(last - first, F.lit(0).cast("long"))


def millis_to_seconds(value: Column | str) -> Column:
    return column(value) / F.lit(1000)


def hash_unit(*keys: Column | str) -> Column:
    """A number in [0, 1) fixed by the keys alone.

    It does not depend on partitioning, row order or session, so two samples
    drawn with it nest and can be drawn again after any repartitioning.
    """
    digest = F.md5(F.concat_ws("|", *[column(k).cast("string") for k in keys]))
    head = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return head / F.lit(float(_HASH_SPAN))


def with_score_order(frame: DataFrame, value: str, name: str) -> DataFrame:
    """Add the long ``name`` that orders the doubles of ``value`` as they order themselves.

    NaN comes last, zeros of both signs are equal, null stays null. The steps
    are columns of their own, so that each is computed once per row.
    """
    x, two = F.col(value).cast("double"), F.lit(2.0)
    size, guess, exponent, half = (F.col(f"_{name}_{step}") for step in ("size", "guess", "exponent", "half"))
    ordinary = F.abs(x).between(5e-324, 1.7976931348623157e308)
    steps = {
        "size": F.when(ordinary, F.abs(x)),
        "guess": F.floor(F.log2(size)),
        # The logarithm may round across a power of two.
        "exponent": F.greatest(
            F.when(F.pow(two, guess) > size, guess - 1).when(F.pow(two, guess + 1) <= size, guess + 1).otherwise(guess),
            F.lit(_LOWEST),
        ),
        "half": F.floor((52 - exponent) / 2),
        # Scaled in two halves, each a power of two, so that nothing overflows or rounds.
        "place": (exponent - _LOWEST) * F.lit(_FRACTION)
        + (size * F.pow(two, half) * F.pow(two, 52 - exponent - half)).cast("long"),
    }
    for step, expression in steps.items():
        frame = frame.withColumn(f"_{name}_{step}", expression)
    place = F.coalesce(f"_{name}_place", F.when(x == 0, F.lit(0)).when(x.isNotNull(), F.lit(_INFINITE)))
    order = F.when(F.isnan(x), F.lit(_INFINITE + 1)).when(x < 0, -place).otherwise(place)
    return frame.withColumn(name, order.cast("long")).drop(*[f"_{name}_{step}" for step in steps])


def packed(high: Column | str, low: Column | str) -> Column:
    """One decimal that orders pairs of longs by ``high``, then by ``low``; null unless both are there.

    Unlike a struct it has a fixed width, so hash aggregates can keep extremes
    of it. ``high`` beyond 5e18 either way is an error, never a wrong order.
    """
    first, second = column(high), column(low)
    fits = first.between(-_LATEST, _LATEST)
    key = first.cast("decimal(19,0)") * F.lit(_SPAN) + second.cast("decimal(19,0)")
    outside = F.raise_error(F.lit("a packed key takes no value beyond 5e18")).cast("decimal(38,0)")
    return F.when(first.isNotNull() & second.isNotNull(), F.when(fits, key.cast("decimal(38,0)")).otherwise(outside))
