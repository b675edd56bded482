"""Scalar column functions shared by the operators. All of them are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartsight.params import DAY_US, HOUR_US, MINUTE_US, NEVER_HOURS


def guarded_ratio(num: Column, den: Column) -> Column:
    """num / den as double, 0.0 where the denominator is zero or missing."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def minutes_between(start_us: Column, end_us: Column) -> Column:
    return (end_us - start_us) / F.lit(float(MINUTE_US))


def hours_since(then_us: Column, now_us: Column) -> Column:
    """Hours from an earlier instant, or the 'never' sentinel when there was none."""
    return F.coalesce((now_us - then_us) / F.lit(float(HOUR_US)), F.lit(NEVER_HOURS))


def whole_days_since(then_us: Column, now_us: Column) -> Column:
    """Completed 24-hour days between two instants (not calendar days); 0 when unknown."""
    return F.coalesce(F.floor((now_us - then_us) / F.lit(float(DAY_US))), F.lit(0)).cast("long")


def session_name(user: Column, seq: Column, kind: str = "session") -> Column:
    """<user>_<kind>_0001; numbers above 9999 are widened, never cut."""
    return F.format_string(f"%s_{kind}_%04d", user.cast("string"), seq.cast("long"))


def discounted_price(base: Column, discount_pct: Column) -> Column:
    return base * (F.lit(1.0) - discount_pct / F.lit(100.0))


def one_if(cond: Column) -> Column:
    """1/0 integer flag; a null condition counts as 0."""
    return F.when(cond, 1).otherwise(0)


def confidence_band(p: Column) -> Column:
    """Distance from the undecided middle. The outer bounds are strict on both sides."""
    return (
        F.when((p < 0.3) | (p > 0.7), "high")
        .when((p < 0.4) | (p > 0.6), "medium")
        .otherwise("low")
    )


def decide(p: Column, threshold: float) -> Column:
    """Positive when the probability reaches the threshold (inclusive)."""
    return (p >= F.lit(float(threshold))).cast("int")
