"""Ordered computations per key that also hold for keys too large for one task.

Each function takes ``cuts``. Without hot keys it is one plain window. With hot keys it is a
window per (key, piece), plus a carry: one aggregated row per piece, combined over the pieces of
a key and joined back on (key, piece), which is how the rows are already partitioned.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartsight.operators.skew import PIECE, Cuts


def _over(keys: Sequence[str]) -> "Window":
    # A frame without keys only ever orders one row per piece here.
    return Window.partitionBy(*[F.col(k) for k in keys]) if keys else Window.partitionBy(F.lit(0))


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    cuts: Cuts,
    sums: Mapping[str, Column] | None = None,
    maxes: Mapping[str, Column] | None = None,
    include_current: bool = True,
    totals_of: DataFrame | None = None,
) -> DataFrame:
    """Add running sums (0 when empty) and running maxima (null when empty) along ``order``.

    ``totals_of`` may give a cheaper table with the same totals per piece, and every piece of
    ``df``, to take the carry from.
    """
    sums, maxes = dict(sums or {}), dict(maxes or {})
    parts = [*keys, *cuts.columns]
    last = Window.currentRow if include_current else -1
    frame = _over(parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, last)
    local = {n: F.coalesce(F.sum(e).over(frame), F.lit(0)).cast("long") for n, e in sums.items()}
    local |= {n: F.max(e).over(frame) for n, e in maxes.items()}
    out = df.withColumns(local)
    if not cuts.active:
        return out
    totals = (df if totals_of is None else totals_of).groupBy(*parts).agg(
        *[F.sum(e).alias(f"_t_{n}") for n, e in sums.items()],
        *[F.max(e).alias(f"_t_{n}") for n, e in maxes.items()],
    )
    before = _over(keys).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        *parts,
        *[F.sum(f"_t_{n}").over(before).alias(f"_c_{n}") for n in sums],
        *[F.max(f"_t_{n}").over(before).alias(f"_c_{n}") for n in maxes],
    )
    joined = out.join(carry, parts, "left")
    whole = {n: (F.col(n) + F.coalesce(F.col(f"_c_{n}"), F.lit(0))).cast("long") for n in sums}
    whole |= {n: F.greatest(F.col(n), F.col(f"_c_{n}")) for n in maxes}
    return joined.withColumns(whole).select(*out.columns)


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    at: str,
    cuts: Cuts,
    previous: str | None = None,
    following: str | None = None,
) -> DataFrame:
    """Add the value of ``at`` on the previous and/or following row. ``order`` starts with ``at``."""
    parts = [*keys, *cuts.columns]
    frame = _over(parts).orderBy(*order)
    local = {}
    if previous:
        local[previous] = F.lag(at).over(frame)
    if following:
        local[following] = F.lead(at).over(frame)
    out = df.withColumns(local)
    if not cuts.active:
        return out
    ends = df.groupBy(*parts).agg(F.min(at).alias("_first"), F.max(at).alias("_last"))
    by_piece = _over(keys).orderBy(PIECE)
    carry = ends.select(
        *parts,
        F.lag("_last").over(by_piece).alias("_c_previous"),
        F.lead("_first").over(by_piece).alias("_c_following"),
    )
    joined = out.join(carry, parts, "left")
    whole = {}
    if previous:
        whole[previous] = F.coalesce(F.col(previous), F.col("_c_previous"))
    if following:
        whole[following] = F.coalesce(F.col(following), F.col("_c_following"))
    return joined.withColumns(whole).select(*out.columns)
