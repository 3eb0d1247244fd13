"""Durations, ratios and flags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Texts that are normal already, which is nearly all of them: no more than this test is spent there.
_CLOCK = "^[0-9]{2}:[0-5][0-9]:[0-5][0-9]$"


def _padded(n: Column) -> Column:
    return F.when((n >= 0) & (n < 10), F.concat(F.lit("0"), n.cast("string"))).otherwise(n.cast("string"))


def _sixties(c: Column, kind: str) -> Column:
    """``H:M:S`` text as a number of seconds, NULL where it does not have three numbers."""
    parts = F.split(c, ":", -1)
    total = F.aggregate(
        parts, F.lit(0).cast(kind),
        lambda so_far, part: F.try_add(F.try_multiply(so_far, F.lit(60).cast(kind)), part.try_cast(kind)))
    return F.when(F.size(parts) == 3, total)


def _clock(seconds: Column) -> Column:
    rest = F.pmod(seconds, F.lit(3600))
    # seconds - rest is a multiple of 3600, so the quotient is exact also below zero
    return F.concat_ws(
        ":",
        _padded(((seconds - rest) / 3600).cast("bigint")),
        _padded(F.floor(rest / 60)),
        _padded(rest % 60),
    )


def normalise_duration(c: Column) -> Column:
    """``H:M:S`` with overflowing parts → ``HH:MM:SS``; anything else stays as it is."""
    # an array of the total, empty where there is none, so that it is computed once
    total = F.array_compact(F.array(_sixties(c, "bigint")))
    fixed = F.coalesce(F.get(F.transform(total, _clock), F.lit(0)), c)
    return F.when(c.isNull() | c.rlike(_CLOCK), c).otherwise(fixed)


def duration_seconds(c: Column) -> Column:
    """Time-of-day text ``HH:MM:SS[.f]`` → seconds as double; NULL stays NULL."""
    return _sixties(c, "double")


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def ratio(numerator: Column, denominator: Column, digits: int = 4) -> Column:
    """Rounded quotient, NULL where the denominator is 0 or NULL."""
    return F.round(numerator / F.nullif(denominator, F.lit(0)), digits)


def percent(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    return F.round(numerator * 100.0 / F.nullif(denominator, F.lit(0)), digits)


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (unknown counts as 0)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))
