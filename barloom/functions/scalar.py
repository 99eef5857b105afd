"""Row-level column expressions and the small driver-side argument parsers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def non_negative(c: str | Column) -> Column:
    """The value, or NULL when it is negative."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c >= 0, c)


def traded_volume(high: str, low: str) -> Column:
    """Sum of both sides once at least one of them is a valid volume."""
    h, l = F.col(high), F.col(low)
    return F.when((h >= 0) | (l >= 0), gross_volume(high, low))


def gross_volume(high: str, low: str) -> Column:
    zero = F.lit(0).cast("bigint")
    return F.coalesce(F.col(high), zero) + F.coalesce(F.col(low), zero)


def midpoint(high: str, low: str) -> Column:
    return (F.col(high).cast("double") + F.col(low).cast("double")) / F.lit(2.0)


def relative_spread(high: str, low: str) -> Column:
    """(high - low) / midpoint, NULL unless high + low is positive."""
    h, l = F.col(high).cast("double"), F.col(low).cast("double")
    return F.when(h + l > 0, (h - l) / ((h + l) / F.lit(2.0)))


def label_ladder(c: str, ladder: Iterable[tuple[str, Sequence[str]]], default: str) -> Column:
    """First label whose case-insensitive patterns match."""
    out = None
    for label, patterns in ladder:
        cond = F.col(c).ilike(patterns[0])
        for p in patterns[1:]:
            cond = cond | F.col(c).ilike(p)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return F.lit(default) if out is None else out.otherwise(default)


def band(c: Column, steps: Sequence[tuple[float, str]], default: str) -> Column:
    """Label of the first lower bound reached; NULL gets the default."""
    out = None
    for bound, label in steps:
        out = F.when(c >= bound, label) if out is None else out.when(c >= bound, label)
    return out.otherwise(default)


def trend_signal(price: Column, mean: Column | None = None) -> Column:
    """The price against its 7-day mean; a ratio may be given instead. A NULL or zero mean is neutral.

    The mean is multiplied, not divided by: 301 over the mean of 2150 / 7 is 0.98, but its quotient in doubles is below.
    """
    mean = F.lit(1.0) if mean is None else F.nullif(mean, F.lit(0))
    # fixed values: thresholds of price over its 7-day mean, and their labels
    return (
        F.when(price > F.lit(1.05) * mean, "Strong_Up")
        .when(price > F.lit(1.02) * mean, "Mild_Up")
        .when(price < F.lit(0.95) * mean, "Strong_Down")
        .when(price < F.lit(0.98) * mean, "Mild_Down")
        .otherwise("Neutral")
    )


def weekday_angle(date_col: str) -> Column:
    """Day of week (Sunday = 0) as an angle on a 7-day circle."""
    return F.lit(2.0) * F.pi() * (F.dayofweek(date_col) - 1) / F.lit(7.0)


_SLOT = "10000000000000000000"  # 10^19: wider than any 64-bit value
_HALF = "5000000000000000000"
_MOST = "4999999999999999999"


def time_value_key(ts: str, value: str) -> Column:
    """One ordered number for (zone-free instant, integral value below 5 * 10^18), NULL when the value is.

    The instant is taken from its date and time of day, so the session zone does not matter; larger values raise.

    ``min``/``max`` over it finds the value at the first/last instant, ties going to the
    lower/higher value. A decimal is a fixed-width aggregation buffer, so the daily
    aggregate stays a HashAggregate with map-side combine; ordering by a struct would
    make Spark sort all raw rows twice.
    """
    micros = (
        f"(cast(unix_date(cast({ts} as date)) as bigint) * 86400 + hour({ts}) * 3600 + minute({ts}) * 60) * 1000000"
        f" + cast(extract(second from {ts}) * 1000000 as bigint)"
    )
    fits = f"if({value} between -{_MOST} and {_MOST}, cast({value} as decimal(19,0)), raise_error('price beyond 64-bit key'))"
    return F.expr(
        f"cast({micros} as decimal(18,0)) * cast({_SLOT} as decimal(20,0)) + case when {value} is not null then {fits} end"
    )


def key_value(key: str) -> Column:
    """The value packed by :func:`time_value_key`."""
    half = f"cast({_HALF} as decimal(19,0))"
    return F.expr(f"cast(pmod({key} + {half}, cast({_SLOT} as decimal(20,0))) - {half} as bigint)")


def asc_total(*cols: str) -> list[Column]:
    return [F.asc_nulls_last(c) for c in cols]


def humanise(c: str | Column) -> Column:
    """1234567 -> '1.2M', 4321 -> '4.3K', 12.6 -> '13'."""
    c = F.col(c) if isinstance(c, str) else c
    return (
        F.when(c >= 1_000_000, F.concat(F.format_string("%.1f", c / 1_000_000), F.lit("M")))
        .when(c >= 1_000, F.concat(F.format_string("%.1f", c / 1_000), F.lit("K")))
        .otherwise(F.floor(c + 0.5).cast("string"))
    )


def parse_period(text: str, strict: bool = True, default: int = 30) -> int:
    """'30d' -> 30. Strict mode raises on anything else, lenient mode falls back."""
    days = None
    if text.endswith("d"):
        try:
            days = int(text[:-1])
        except ValueError:
            days = None
    if strict:
        if days is None or days <= 0:
            raise ValueError(f"Invalid time period {text!r}: use a form like '30d'")
        return days
    return default if days is None else days


def parse_item_list(text: str, fallback: Sequence[int]) -> list[int] | str:
    """'1,2' or '7' -> ids, '@path' -> the path itself, anything else -> the fallback."""
    if text.startswith("@"):
        return text[1:]
    try:
        return [int(part) for part in text.split(",")]
    except ValueError:
        return list(fallback)
