"""Safe arithmetic: null instead of an error, half-up decimal rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_dec(c: Column | str, places: int) -> Column:
    """Round through a decimal so that ties behave the same on every engine."""
    return F.round(_col(c).cast("decimal(38,12)"), places)


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division where a zero or null denominator gives null."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def percent(numerator: Column | str, denominator: Column | str, places: int = 2) -> Column:
    return round_dec(ratio(numerator, denominator) * 100, places)


def nan_to_null(c: Column | str) -> Column:
    """NaN compares as larger than everything in Spark, so drop it at ingest."""
    c = _col(c)
    return F.when(~F.isnan(c), c)


def number_or_zero(c: Column | str, to: str = "double") -> Column:
    """Parse a number; anything unparseable counts as zero."""
    parsed = _col(c).try_cast(to)
    if to == "double":
        parsed = nan_to_null(parsed)
    return F.coalesce(parsed, F.lit(0).cast(to))


def normalise_score(c: Column | str, low: Column | float, high: Column | float) -> Column:
    """Map a score from ``[low, high]`` to 0-100."""
    low, high = (x if isinstance(x, Column) else F.lit(float(x)) for x in (low, high))
    return round_dec(ratio(_col(c) - low, high - low) * 100, 2)


def share_of(amount: Column | str, parts: Column | str | int, places: int) -> Column:
    """Exact decimal division of money, half-up; a zero or null divisor gives null."""
    n = F.lit(parts) if isinstance(parts, int) else _col(parts)
    return F.round(F.try_divide(_col(amount).cast(MONEY), n.cast("decimal(10,0)")), places)


def monthly_revenue(amount: Column | str, months: Column | str) -> Column:
    return share_of(amount, months, 2)


def annual_revenue(monthly: Column | str) -> Column:
    return round_dec(_col(monthly) * 12, 2)


def is_reversal(amount: Column | str) -> Column:
    return F.coalesce(_col(amount) < 0, F.lit(False))


def order_value(quantity: Column | str, price: Column | str) -> Column:
    return round_dec(_col(quantity) * _col(price), 2)
