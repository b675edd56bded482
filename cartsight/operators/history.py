"""Point-in-time look-ups: aggregates of a key's history at given instants.

``history_at`` puts the history (change rows) and the questions (probe rows) on one timeline per key
and takes running aggregates, so the cost is one sort of changes + probes. Nothing is joined row by
row, and a trailing window [T - w, T) is the difference of two cumulative values, whatever its
length. Strictness follows from the order within one instant: probes come before changes, so a
probe at T sees exactly the changes earlier than T.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartsight.functions.columns import one_if
from cartsight.operators.ordered import neighbours, running
from cartsight.operators.skew import PIECE, Cuts
from cartsight.params import DAY_US

_KIND = "_kind"


def history_at(
    changes: DataFrame,
    probes: DataFrame,
    keys: Sequence[str],
    cuts: Cuts,
    sums: Sequence[str] | Mapping[str, Column] = (),
    maxes: Sequence[str] | Mapping[str, Column] = (),
    at: str = "us",
    inclusive: bool = False,
    carried: Sequence[str] | None = None,
) -> DataFrame:
    """Probe rows, all their columns kept, plus sums and maxima of the changes before ``at``.

    With ``inclusive`` the changes at the very instant of the probe count as well. Sums and maxima are of columns of
    the changes, or of expressions over ``carried`` ones (null on probes), so that the shuffled rows are narrow.
    """
    change, probe = (0, 1) if inclusive else (1, 0)
    sums = sums if isinstance(sums, Mapping) else {c: F.col(c) for c in sums}
    maxes = maxes if isinstance(maxes, Mapping) else {c: F.col(c) for c in maxes}
    held = [*sums, *maxes] if carried is None else carried
    timeline = changes.select(*keys, at, *held).withColumn(_KIND, F.lit(change))
    questions = probes.withColumn(_KIND, F.lit(probe))
    rows = cuts.add_piece(timeline.unionByName(questions, allowMissingColumns=True), at)
    if carried is not None:  # dealt and sorted before the expressions widen the rows
        parts = [*keys, *cuts.columns]
        rows = rows.repartition(*parts).sortWithinPartitions(*parts, at, _KIND)
    totals_of = None
    if cuts.active:  # probes add nothing to the totals, but their pieces need a carry
        asked = cuts.add_piece(questions.select(*keys, at), at).select(*keys, PIECE).distinct()
        totals_of = cuts.add_piece(timeline, at).unionByName(asked, allowMissingColumns=True)
    answered = running(
        rows,
        keys,
        [F.col(at), F.col(_KIND)],
        cuts,
        sums=sums,
        maxes=maxes,
        totals_of=totals_of,
    )
    return answered.where(F.col(_KIND) == probe).drop(_KIND, PIECE, *(c for c in held if c not in sums and c not in maxes))


def distinct_changes(
    rows: DataFrame,
    by: Sequence[str],
    value: str,
    windows_days: Sequence[int],
    cuts: Cuts,
    prefix: str,
) -> DataFrame:
    """Changes whose running sum ``<prefix><w>`` is the number of distinct values in [T - w, T).

    A value is in the window from just after one of its rows until w later, unless another of its
    rows comes in between. So a row opens (+1) when the previous row of that value is more than w
    back, and closes (-1) at w later when no row of that value follows within w.
    """
    keyed = rows.where(F.col(value).isNotNull()).select(*by, value, "us")
    seen = neighbours(
        cuts.add_piece(keyed, "us"),
        [*by, value],
        [F.col("us")],
        "us",
        cuts,
        previous="_prev",
        following="_next",
    )
    us, prev, nxt = F.col("us"), F.col("_prev"), F.col("_next")
    names = [f"{prefix}{w}" for w in windows_days]
    opens = [
        one_if(prev.isNull() | (us - prev > w * DAY_US)).alias(n)
        for w, n in zip(windows_days, names)
    ]
    moves = [F.struct(us.alias("us"), *opens)]
    for w, n in zip(windows_days, names):
        close = [F.lit(-1 if other == n else 0).alias(other) for other in names]
        ends = nxt.isNull() | (nxt - us > w * DAY_US)
        moves.append(F.when(ends, F.struct((us + w * DAY_US).alias("us"), *close)))
    return seen.select(*by, F.explode(F.array_compact(F.array(*moves))).alias("m")).select(
        *by, "m.us", *[f"m.{n}" for n in names]
    )


def window_probes(sessions: DataFrame, windows_days: Sequence[int]) -> DataFrame:
    """One probe per session at its end T (``_tag`` 0) and one at T - w for every window w."""
    marks = [F.struct(F.lit(0).alias("_tag"), F.col("session_end_us").alias("us"))]
    marks += [
        F.struct(F.lit(w).alias("_tag"), (F.col("session_end_us") - w * DAY_US).alias("us"))
        for w in windows_days
    ]
    return sessions.select("*", F.explode(F.array(*marks)).alias("_m")).select(
        *sessions.columns, "_m._tag", "_m.us"
    )
