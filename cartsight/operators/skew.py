"""Finding hot keys and cutting them along their order column.

An ordered computation per key (running sums, gaps to the previous row) normally puts a whole
key in one task. When a key holds a large share of the table it is cut into pieces along its
order column; the pieces are computed apart and joined up by a carry of one row per piece
(see ``ordered``). Detection is one mergeable sketch (no shuffle by key) and, only when a hot key
exists, one quantile sketch over that key's rows. The cut points come back to the driver, so they
are constants of the later plan: a task that is run again after a lost executor sees the same
pieces.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartsight.params import SkewParams
from cartsight.sources.tables import settle

PIECE = "_piece"
_CUTS = "_cuts"
_COARSE = "_coarse"


@dataclass(frozen=True)
class Cuts:
    """Cut points per hot key; ``frame`` is None when no key is hot."""

    key: str
    frame: DataFrame | None
    fine: int

    @property
    def active(self) -> bool:
        return self.frame is not None

    @property
    def columns(self) -> list[str]:
        return [PIECE] if self.active else []

    def add_piece(self, df: DataFrame, at: str) -> DataFrame:
        """Add the piece number. It never decreases along ``at`` within a key."""
        if not self.active:
            return df
        if PIECE in df.columns:
            df = df.drop(PIECE)
        # frame holds at most 1/share keys with `coarse` numbers each
        held = df.join(F.broadcast(self.frame), self.key, "left")
        # The interval search is a column of its own, so that it runs once per row.
        coarse = F.size(F.filter(F.col(_CUTS), lambda c: c <= F.col(at)))
        placed = held.withColumn(_COARSE, F.when(F.col(_CUTS).isNotNull(), coarse))
        number = _piece_number(F.col(_CUTS), F.col(_COARSE), F.col(at), self.fine)
        return placed.withColumn(PIECE, number).drop(_CUTS, _COARSE)


def _piece_number(cuts: Column, coarse: Column, at: Column, fine: int) -> Column:
    """Equal-count coarse interval, divided into ``fine`` intervals of equal width."""
    low, high = F.get(cuts, coarse - 1), F.get(cuts, coarse)
    within = F.floor((at - low) * fine / F.greatest(high - low, F.lit(1)))
    inside = F.coalesce(within, F.lit(0))  # before the first cut and after the last one
    return F.when(coarse.isNull(), F.lit(0)).otherwise(coarse * fine + inside).cast("long")


def hot_keys(df: DataFrame, key: str, skew: SkewParams) -> list:
    """Keys above the row share, from one frequency sketch merged map side."""
    k = min(int(2 / skew.share), skew.tracked)
    row = df.where(F.col(key).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"approx_top_k(`{key}`, {k}, {skew.tracked})").alias("top"),
    ).first()
    floor = max(skew.min_rows, skew.share * row["n"])
    return [t["item"] for t in (row["top"] or []) if t["count"] > floor]


def time_cuts(df: DataFrame, key: str, at: str, skew: SkewParams) -> Cuts:
    """Cut points along the integer column ``at`` for every hot value of ``key``."""
    hot = hot_keys(df, key, skew)
    if not hot:
        return Cuts(key, None, skew.fine)
    probs = [i / skew.coarse for i in range(skew.coarse + 1)]
    rows = (
        df.where(F.col(key).isin(hot))
        .groupBy(key)
        .agg(F.array_distinct(F.percentile_approx(F.col(at), probs, 10_000)).alias(_CUTS))
        .collect()
    )
    schema = df.select(key).schema.add(_CUTS, T.ArrayType(df.schema[at].dataType))
    return Cuts(key, df.sparkSession.createDataFrame(rows, schema), skew.fine)


NO_CUTS = Cuts("", None, 1)


BROADCAST_BYTES = 32 << 20
_WIDTHS = {"string": 64, "binary": 64, "array": 256, "map": 256, "struct": 256}


def broadcast_rows(lookup: DataFrame, most: int) -> int:
    """Rows that may be broadcast: at most ``most``, and no more than ``BROADCAST_BYTES`` by the width of the columns."""
    width = sum(_WIDTHS.get(f.dataType.typeName(), 16) for f in lookup.schema)
    return min(most, BROADCAST_BYTES // max(width, 1))


def join_lookup(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "left",
    max_broadcast_rows: int = 200_000,
    skew: SkewParams = SkewParams(),
    computed: bool = False,
) -> DataFrame:
    """Join to a table that is unique on ``key``, whatever its size and however hot a key is.

    A lookup within the bound of rows and bytes (counted, reading no further) is broadcast. Beyond
    that the rows of hot keys meet a broadcast of just those keys' lookup rows, and all other rows
    are shuffled on the key. Rows with a null key have no match: they are added without a shuffle for
    ``left`` and left out for ``inner``. A ``computed`` lookup is stored first, so that counting it
    does not compute it twice.
    """
    if computed:
        lookup = settle(lookup)
    bound = broadcast_rows(lookup, max_broadcast_rows)
    if lookup.select(key).limit(bound + 1).count() <= bound:
        return df.join(F.broadcast(lookup), key, how)
    known = df.where(F.col(key).isNotNull())
    hot = hot_keys(known, key, skew)
    if hot:
        is_hot = F.col(key).isin(hot)
        joined = known.where(is_hot).join(F.broadcast(lookup.where(is_hot)), key, how)
        joined = joined.unionByName(known.where(~is_hot).join(lookup, key, how))
    else:
        joined = known.join(lookup, key, how)
    if how != "left":
        return joined
    return joined.unionByName(df.where(F.col(key).isNull()), allowMissingColumns=True)
