"""Ranking metrics for scored examples under extreme class imbalance.

Scored tables carry ``label`` (0/1) and ``score`` (double). Two shapes of work appear:

* Metrics over distinct scores (average precision, ROC area, curves) first aggregate to one row per
  score, then take running sums. The scores are cut into pieces by a range partitioning, each with a carry of what
  comes before it, so no task orders the whole table.
* The top k percent follows from the running counts per score; rows are ordered only where k falls among ties.
* Exact percentiles narrow a bracket of values by counting; nothing is ordered.
* Metrics over row positions (top k per segment) need global row numbers. Rows are
  range-partitioned and sorted on a total order, numbered inside their partition, and shifted by the
  row counts of the partitions before (one number per partition).

Sums of fractions are taken in fixed point (1e-12), so that results do not depend on row order.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartsight.functions.columns import guarded_ratio, one_if
from cartsight.operators.ordered import running
from cartsight.operators.skew import PIECE, join_lookup
from cartsight.params import ScoreParams
from cartsight.sources.tables import settle

TIE_BREAK = ("user_id", "item_id", "session_seq")
FIXED_POINT = 1_000_000_000_000
SKETCH = 10_000  # accuracy of sketched quantiles
_SEQ = "_row_in_partition"


# --- global order -------------------------------------------------------------------------------


@dataclass(frozen=True)
class ValueCuts:
    """Cut points of one numeric column, shared by all keys. Pieces count upwards in ``order``."""

    at: str
    splits: tuple[float, ...]
    descending: bool = True

    @property
    def active(self) -> bool:
        return bool(self.splits)

    @property
    def columns(self) -> list[str]:
        return [PIECE] if self.active else []

    def add_piece(self, df: DataFrame) -> DataFrame:
        if not self.active:
            return df
        n = len(self.splits)
        below = self._search(0, n)
        return df.withColumn(PIECE, (F.lit(n) - below if self.descending else below).cast("long"))

    def _search(self, lo: int, hi: int) -> Column:
        """Number of split points not above the value, by bisection over literals."""
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        above = F.col(self.at) < F.lit(self.splits[mid])
        return F.when(above, self._search(lo, mid)).otherwise(self._search(mid + 1, hi))


def value_cuts(df: DataFrame, at: str, pieces: int = 128, descending: bool = True) -> ValueCuts:
    probs = [i / pieces for i in range(1, pieces)]
    found = df.agg(F.percentile_approx(at, probs, SKETCH).alias("q")).first()["q"] or []
    return ValueCuts(at, tuple(sorted(set(found))), descending)


class RangePieces:
    """Pieces that a range partitioning has made (``in_range_pieces``), for ``running``."""

    active = True
    columns = (PIECE,)


def in_range_pieces(df: DataFrame, order: Column, rows: int = 1_000_000) -> DataFrame:
    """Rows with the number of the range of ``order`` that they lie in, of about ``rows`` rows each; stored, so that the ranges
    stay as they are. ``df`` is stored as well."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(max(parts, df.count() // rows), order)
    return settle(placed.withColumn(PIECE, F.spark_partition_id().cast("long")))


def with_global_rank(
    df: DataFrame, order: Sequence[Column], name: str = "rank"
) -> DataFrame:
    """Add exact row numbers, from 1, along a total order.

    The numbered rows are stored before the counts are taken, so both come from the same
    partitions.
    """
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
    rows = settle(placed.withColumn(_SEQ, F.monotonically_increasing_id()))
    part = F.shiftright(_SEQ, 33)
    counts = rows.groupBy(part.alias("p")).count().collect()  # one row per partition
    sizes = {r["p"]: r["count"] for r in counts}
    before = [0]
    for p in range(max(sizes, default=0)):
        before.append(before[-1] + sizes.get(p, 0))
    offset = F.get(F.array(*[F.lit(b).cast("long") for b in before]), part.cast("int"))
    within = F.col(_SEQ).bitwiseAND(F.lit((1 << 33) - 1))
    return rows.withColumn(name, within + offset + 1).drop(_SEQ)


def by_score(tie_break: Sequence[str] = TIE_BREAK) -> list[Column]:
    return [F.col("score").desc(), *[F.col(c) for c in tie_break]]


def values_at_ranks(df: DataFrame, value: str, ranks: Sequence[int]) -> dict[int, float]:
    """The values at some places, from 1, of the ascending order, by narrowing; no row is sorted or shuffled.

    Every place keeps a bracket of values that it lies in. A round takes the sketched quantiles around the place among the rows
    inside the bracket, which are values of the table, and then counts the rows at and below them exactly. The
    bracket shrinks to a few thousandths of its rows, or the place is met: ties of any size are one value. ``value`` has
    no nulls, and a place is at most the number of rows.
    """
    x = F.col(value).cast("double")
    rows = df.select(x.alias("x"))
    n = rows.count()
    found: dict[int, float] = {}
    brackets = {r: (None, None, 0, n) for r in set(ranks)}  # above, below, rows not above, rows inside
    while brackets:
        inside = {
            b: reduce(
                Column.__and__,
                [F.lit(True)] + ([F.col("x") > F.lit(b[0])] if b[0] is not None else []) + ([F.col("x") < F.lit(b[1])] if b[1] is not None else []),
            )
            for b in set(brackets.values())
        }
        some = rows.where(reduce(Column.__or__, inside.values()))
        probs = {}
        for b in inside:
            own = [(r - b[2] - 0.5) / b[3] for r, mine in brackets.items() if mine == b]
            probs[b] = sorted({min(1.0, max(0.0, p + d / SKETCH)) for p in own for d in (-2, 0, 2)})
        order = list(inside)
        sketch = some.agg(
            *(F.percentile_approx(F.when(inside[b], F.col("x")), probs[b], SKETCH).alias(f"q_{k}") for k, b in enumerate(order))
        ).first()
        cuts = {b: sorted(set(sketch[f"q_{k}"])) for k, b in enumerate(order)}
        counts = some.agg(
            *(
                F.count_if(inside[b] & test).alias(f"{name}_{k}_{i}")
                for k, b in enumerate(order)
                for i, c in enumerate(cuts[b])
                for name, test in (("below", F.col("x") < F.lit(c)), ("at", F.col("x") == F.lit(c)))
            )
        ).first()
        left = {}
        for r, b in brackets.items():
            k, (low, high, before, _) = order.index(b), b
            upto, end = before, before + b[3]
            for i, c in enumerate(cuts[b]):
                below, at = before + counts[f"below_{k}_{i}"], counts[f"at_{k}_{i}"]
                if r <= below:
                    high, end = c, below
                    break
                if r <= below + at:
                    found[r] = c
                    break
                low, upto = c, below + at
            if r not in found:
                left[r] = (low, high, upto, end - upto)
        brackets = left
    return found


def exact_percentiles(df: DataFrame, value: str, percents: Sequence[float]) -> DataFrame:
    """Percentiles with linear interpolation between the two nearest ranks, one row each; none of an empty table."""
    given = df.where(F.col(value).isNotNull())
    n = given.count()
    rows = []
    if n:
        places = {p: (n - 1) * (p / 100.0) for p in percents}
        lows = {p: math.floor(at) for p, at in places.items()}
        at = values_at_ranks(given, value, [min(n, low + k) for low in lows.values() for k in (1, 2)])
        for p, place in places.items():
            low, high = at[lows[p] + 1], at[min(n, lows[p] + 2)]
            rows.append((float(p), low + (high - low) * (place - lows[p])))
    return df.sparkSession.createDataFrame(rows, "percent double, value double")


# --- distinct scores ----------------------------------------------------------------------------


def score_curve(scored: DataFrame, segment: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score with rows and positives at or above it.

    The rows per score are stored once, so the scoring behind them is not repeated.
    """
    label = F.col("label").cast("long")
    grouped = settle(
        scored.groupBy(*segment, "score").agg(
            F.count(F.lit(1)).alias("n"), F.sum(label).alias("pos")
        )
    )
    return running(
        in_range_pieces(grouped, F.col("score").desc()),
        segment,
        [F.col("score").desc()],
        RangePieces(),
        sums={"n_at": F.col("n"), "pos_at": F.col("pos")},
    ).drop(PIECE)


def precision_recall_curve(scored: DataFrame) -> DataFrame:
    """Precision and recall when everything scoring at least the threshold counts as positive."""
    total = scored.agg(F.sum(F.col("label").cast("long")).alias("t")).first()["t"] or 0
    return score_curve(scored).select(
        F.col("score").alias("threshold"),
        guarded_ratio(F.col("pos_at"), F.col("n_at")).alias("precision"),
        guarded_ratio(F.col("pos_at"), F.lit(total)).alias("recall"),
    )


def area_metrics(scored: DataFrame, segment: Sequence[str] = ()) -> DataFrame:
    """Average precision (step-wise) and ROC area (ties count half), per segment.

    ROC area is null unless both classes are present; average precision is 0 without positives.
    """
    curve = score_curve(scored, segment)
    precision = F.col("pos_at").cast("double") / F.col("n_at").cast("double")
    steps = F.floor(precision * F.lit(float(FIXED_POINT))).cast("decimal(19,0)")
    neg, neg_at = F.col("n") - F.col("pos"), F.col("n_at") - F.col("pos_at")
    # negatives ranked below a score: all negatives minus those at or above it. Doubled, ties half:
    # 2 * (N - neg_at) + neg; the N term is added after the sum.
    pos_dec = F.col("pos").cast("decimal(18,0)")
    sums = curve.groupBy(*segment).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_examples"),
        F.coalesce(F.sum("pos"), F.lit(0)).alias("n_positives"),
        F.sum(steps * pos_dec).alias("_ap"),
        F.sum((neg_at * 2 - neg).cast("decimal(19,0)") * pos_dec).alias("_above"),
    )
    p = F.col("n_positives").cast("decimal(18,0)")
    q = (F.col("n_examples") - F.col("n_positives")).cast("decimal(18,0)")
    twice = (p * q * F.lit(2)).cast("decimal(38,0)") - F.col("_above")
    ap_den = F.col("n_positives").cast("double") * F.lit(float(FIXED_POINT))
    return sums.select(
        *segment,
        "n_examples",
        "n_positives",
        F.coalesce(F.try_divide(F.col("_ap").cast("double"), ap_den), F.lit(0.0)).alias("pr_auc"),
        F.try_divide(twice.cast("double"), (p * q * F.lit(2)).cast("double")).alias("roc_auc"),
    )


# --- top k percent ------------------------------------------------------------------------------


def top_count(n: int, percent: int) -> int:
    """Rows in the top ``percent``: the product is truncated."""
    return int(n * percent / 100)


def precision_at(
    scored: DataFrame,
    percents: Sequence[int] = ScoreParams().top_percents,
    tie_break: Sequence[str] = TIE_BREAK,
) -> DataFrame:
    """Precision, positives found, recall and lift in the top k percent, one row per percent.

    When k rounds down to 0 the whole table is taken instead and ``whole_table`` is set. The counts per score tell at
    which score k is reached; only the rows tied at such a score are ordered.
    """
    curve = settle(score_curve(scored))
    total = curve.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("pos"), F.lit(0)).alias("pos")
    ).first()
    ks = {p: top_count(total["n"], p) for p in percents}
    reached = F.struct("n_at", "pos_at", "n", "pos", "score")
    edges = curve.agg(
        *[F.min(F.when(F.col("n_at") >= (k or total["n"]), reached)).alias(f"e_{p}") for p, k in ks.items()]
    ).first()
    # rows wanted of those at the edge score; all of them need no order
    wanted = {p: (ks[p] or total["n"]) - (e["n_at"] - e["n"]) for p in percents if (e := edges[f"e_{p}"])}
    tied = {p: edges[f"e_{p}"]["score"] for p, n in wanted.items() if n < edges[f"e_{p}"]["n"]}
    parts = dict.fromkeys(percents, 0)
    if tied:
        at_edge = [F.col("score").eqNullSafe(F.lit(v)) for v in set(tied.values())]
        some = reduce(Column.__or__, at_edge)
        rows = scored.where(some).select("score", "label", *tie_break)
        ranked = with_global_rank(rows, by_score(tie_break))
        first = {r["score"]: r["r"] for r in ranked.groupBy("score").agg(F.min("rank").alias("r")).collect()}
        found = ranked.agg(
            *[
                F.coalesce(
                    F.sum(F.when(F.col("score").eqNullSafe(F.lit(v)) & (F.col("rank") - first[v] < wanted[p]), F.col("label"))),
                    F.lit(0),
                ).alias(f"t_{p}")
                for p, v in tied.items()
            ]
        ).first()
        parts |= {p: found[f"t_{p}"] for p in tied}
    tops = {}
    for p in percents:
        e = edges[f"e_{p}"]
        tops[p] = 0 if e is None else e["pos_at"] - e["pos"] + parts[p] if p in tied else e["pos_at"]
    one = scored.sparkSession.range(1)
    hits = one.select(*[F.lit(int(n)).cast("long").alias(f"top_{p}") for p, n in tops.items()])
    rows = [
        F.struct(
            F.lit(p).alias("percent"),
            F.lit(k).cast("long").alias("k"),
            F.lit(k == 0).alias("whole_table"),
            F.col(f"top_{p}").alias("positives_found"),
            F.lit(int(total["pos"])).cast("long").alias("total_positives"),
            guarded_ratio(F.col(f"top_{p}"), F.lit(k or total["n"])).alias("precision"),
            guarded_ratio(F.col(f"top_{p}"), F.lit(int(total["pos"]))).alias("recall"),
            F.coalesce(
                F.try_divide(
                    guarded_ratio(F.col(f"top_{p}"), F.lit(k or total["n"])),
                    guarded_ratio(F.lit(int(total["pos"])), F.lit(total["n"])),
                ),
                F.lit(0.0),
            ).alias("lift"),
        )
        for p, k in ks.items()
    ]
    return hits.select(F.inline(F.array(*rows)))


def precision_at_per_segment(
    scored: DataFrame,
    segment: str,
    percents: Sequence[int] = ScoreParams().top_percents,
    tie_break: Sequence[str] = TIE_BREAK,
) -> DataFrame:
    """``precision_at`` inside every segment.

    One global order with the segment first; a row's place in its segment is its global rank minus
    the first rank of the segment.
    """
    order = [F.col(segment), *by_score(tie_break)]
    ranked = with_global_rank(scored.select(segment, "score", "label", *tie_break), order)
    bounds = ranked.groupBy(segment).agg(
        (F.min("rank") - 1).alias("_before"),
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.col("label").cast("long")).alias("total_positives"),
    )
    ks = {p: F.floor(F.col("_n") * F.lit(p) / F.lit(100.0)).cast("long") for p in percents}
    taken = {p: F.when(k > 0, k).otherwise(F.col("_n")) for p, k in ks.items()}
    placed = join_lookup(ranked, bounds, segment, "inner", computed=True).withColumn(
        "_place", F.col("rank") - F.col("_before")
    )
    hits = placed.groupBy(segment, "_n", "total_positives").agg(
        *[
            F.sum(F.when(F.col("_place") <= taken[p], F.col("label")).otherwise(0))
            .cast("long")
            .alias(f"top_{p}")
            for p in percents
        ]
    )
    rows = [
        F.struct(
            F.lit(p).alias("percent"),
            ks[p].alias("k"),
            (ks[p] == 0).alias("whole_table"),
            F.col(f"top_{p}").alias("positives_found"),
            F.col("total_positives"),
            guarded_ratio(F.col(f"top_{p}"), taken[p]).alias("precision"),
        )
        for p in percents
    ]
    return hits.select(segment, F.inline(F.array(*rows)))


# --- thresholds ---------------------------------------------------------------------------------


def threshold_grid(params: ScoreParams = ScoreParams()) -> list[float]:
    step = (params.search_high - params.search_low) / (params.search_steps - 1)
    return [params.search_low + i * step for i in range(params.search_steps)]


def threshold_table(scored: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """Confusion counts at every threshold (score >= threshold is positive).

    Each row is counted once, in the highest threshold it reaches; sums from the top over the grid
    then give the counts at every threshold.
    """
    grid = sorted(thresholds)
    cuts = ValueCuts("score", tuple(grid), descending=False)
    spark = scored.sparkSession
    placed = cuts.add_piece(scored).groupBy(F.col(PIECE).alias("step")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("label").cast("long")).alias("pos")
    )
    steps = spark.createDataFrame(
        [(0, None), *[(i + 1, t) for i, t in enumerate(grid)]], "step long, threshold double"
    )
    # the grid bounds both sides
    filled = steps.join(F.broadcast(placed), "step", "left").na.fill(0, ["n", "pos"])
    from_top = running(
        filled,
        [],
        [F.col("step").desc()],
        ValueCuts("step", ()),
        sums={"predicted": F.col("n"), "true_positives": F.col("pos")},
    )
    total = F.max(F.struct("predicted", "true_positives")).over(Window.partitionBy(F.lit(0)))
    counted = from_top.withColumns(
        {"_n": total["predicted"], "_pos": total["true_positives"]}
    ).where(F.col("threshold").isNotNull())
    tp, pred = F.col("true_positives"), F.col("predicted")
    return counted.select(
        "threshold",
        tp,
        (pred - tp).alias("false_positives"),
        (F.col("_pos") - tp).alias("false_negatives"),
        (F.col("_n") - pred - F.col("_pos") + tp).alias("true_negatives"),
        guarded_ratio(tp, pred).alias("precision"),
        guarded_ratio(tp, F.col("_pos")).alias("recall"),
    )


def best_threshold(scored: DataFrame, params: ScoreParams = ScoreParams()) -> DataFrame:
    """The threshold of highest recall among those that reach the target precision (one row).

    Equal recall prefers the higher precision, then the higher threshold. No row when none
    qualifies.
    """
    table = threshold_table(scored, threshold_grid(params))
    enough = table.where(F.col("precision") >= F.lit(params.target_precision))
    return enough.orderBy(
        F.col("recall").desc(), F.col("precision").desc(), F.col("threshold").desc()
    ).limit(1)


def confusion_matrix(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    predicted = one_if(F.col("score") >= F.lit(threshold)).alias("prediction")
    return scored.groupBy("label", predicted).agg(F.count(F.lit(1)).alias("n"))


def classification_report(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Precision, recall, F1 and support of both classes."""
    yes = F.col("score") >= F.lit(threshold)
    truth = F.col("label") == 1
    counts = scored.agg(
        F.count_if(yes & truth).alias("tp"),
        F.count_if(yes & ~truth).alias("fp"),
        F.count_if(~yes & truth).alias("fn"),
        F.count_if(~yes & ~truth).alias("tn"),
    )

    def row(cls: int, hit: str, false: str, missed: str):
        h, f, m = F.col(hit), F.col(false), F.col(missed)
        return F.struct(
            F.lit(cls).alias("label"),
            guarded_ratio(h, h + f).alias("precision"),
            guarded_ratio(h, h + m).alias("recall"),
            guarded_ratio(h * 2, h * 2 + f + m).alias("f1"),
            (h + m).alias("support"),
        )

    return counts.select(
        F.inline(F.array(row(0, "tn", "fn", "fp"), row(1, "tp", "fp", "fn")))
    )


def score_histogram(scored: DataFrame, buckets: int = 10) -> DataFrame:
    """Rows per score bucket of equal width; a score of 1 goes into the last bucket."""
    b = F.least(F.floor(F.col("score") * buckets), F.lit(buckets - 1)).cast("long")
    return scored.groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def top_predictions(scored: DataFrame, n: int = 20, tie_break: Sequence[str] = TIE_BREAK) -> DataFrame:
    return scored.orderBy(*by_score(tie_break)).limit(n)


def compare_models(metrics: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per model from (model, metric, value) rows."""
    return metrics.where(F.col("metric").isin(*names)).groupBy("model").pivot(
        "metric", list(names)
    ).agg(F.max("value"))
