"""Mixing sources to target weights.

Sizes are summed per source. Sources in code point order, null last, weigh 5, 2, 1, repeating. A target is
the source's share by weight of all sizes, at most ``limit`` times its own size; what is above is
shared again by weight among the rest, until none is above. Each document is then taken floor(rate)
times and once more with the rate's fraction as probability, by a hash of its id and a seed.

Only the table of sources (one row each) is iterated over, and only three numbers per round come to the
driver. Sources are numbered by range partitions and offsets, not in one task.

Cases: null or empty text has size 0 and takes nothing; a null source is a source of its own; a source
of size 0 has target 0; equal rows share their fate; a null id is hashed like the empty string. Input columns
named like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartsight.llm.registry import query, table
from cartsight.llm.rows import packed, unpacked, without
from cartsight.sources.tables import settle

WEIGHTS = (5, 2, 1)
LIMIT = 3
SEED = "mix-1"
RESULT = ("size", "source_size", "target", "taken", "copies")
WORD = r"[^\x20\x09-\x0D]+"


def numbered(sources: DataFrame, key: str) -> DataFrame:
    """Add ``rank`` from 0 in order of the non-null string ``key``; null keys come last. Keys are unique."""
    # Spark compares strings by their UTF-8 bytes, which is code point order
    piece = settle(
        sources.where(F.col(key).isNotNull()).repartitionByRange(key).withColumn("_piece", F.spark_partition_id())
    )
    counts = piece.groupBy("_piece").agg(F.count(F.lit(1)).alias("_n"))  # one row per partition
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_piece").orderBy(key)
    ranked = piece.withColumn("_at", F.row_number().over(inside) - 1).join(offsets, "_piece")
    named = ranked.withColumn("rank", F.col("_at") + F.col("_offset")).select(*sources.columns, "rank")
    last = sources.where(F.col(key).isNull()).withColumn("rank", F.lit(piece.count()).cast("long"))
    return named.unionByName(last)


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """(source, source_size) rows with their ``target``."""
    cycle = F.array(*(F.lit(w) for w in weights))
    weight = F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")).cast("long")
    ranked = settle(numbered(sizes, "source").withColumn("weight", weight))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    left, shared = total, ranked.agg(F.sum("weight")).first()[0] or 1

    def above(left: int, shared: int) -> Column:
        """limit * size <= weight * left / shared, in whole numbers."""
        wide = "decimal(38,0)"
        return (F.col("source_size") * limit).cast(wide) * F.lit(shared) <= F.col("weight").cast(wide) * F.lit(left).cast(wide)

    while True:
        row = ranked.where(above(left, shared)).agg(F.sum("source_size").alias("s"), F.sum("weight").alias("w")).first()
        rest = ranked.where(~above(left, shared)).agg(F.sum("weight")).first()[0]
        if not rest:
            break
        now = total - limit * (row["s"] or 0), rest
        if now == (left, shared):
            break
        left, shared = now
    level = (F.col("weight") * F.lit(left).cast("long")).cast("double") / F.lit(shared).cast("double")
    full = F.col("source_size") * limit
    return ranked.select("source", "source_size", F.when(above(left, shared), full.cast("double")).otherwise(level).alias("target"))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    limit: int = LIMIT,
    seed: str = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """The carried columns (all, if not named) with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``."""
    names = [c for c in (docs.columns if carry is None else carry) if c in without(docs, RESULT).columns]
    words = F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(
        packed(names),
        F.col(f"`{doc_id}`").cast("string").alias("_id"),
        F.coalesce(F.col(f"`{source}`"), F.lit("")).alias("_source"),
        F.col(f"`{source}`").isNull().alias("_none"),
        words.alias("_size"),
    )
    sums = rows.groupBy("_source", "_none").agg(F.sum("_size").alias("source_size"))
    found = targets(sums.select(F.when(~F.col("_none"), F.col("_source")).alias("source"), "source_size"), weights, limit)
    by_source = found.select(
        F.coalesce("source", F.lit("")).alias("_source"), F.col("source").isNull().alias("_none"), "source_size", "target"
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("_id", F.lit("")))), 1, 12)
    chance = F.conv(digits, 16, 10).cast("long").cast("double") / F.lit(float(1 << 48))
    copies = F.floor(rate) + (chance < rate - F.floor(rate)).cast("long")
    return rows.join(by_source, ["_source", "_none"]).select(
        *unpacked(names),
        F.col("_size").alias("size"),
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("_size")).alias("taken"),
    )


# Sources ordered by size per weight: those up to a place are held at the limit; the place is the first after
# which the next is not above its share.
SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    (CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::BIGINT AS weight
  FROM d GROUP BY source),
t AS (SELECT sum(source_size)::HUGEINT AS total, sum(weight)::HUGEINT AS weights FROM s),
o AS (
  SELECT *, row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS place,
    coalesce(sum(source_size) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS held,
    coalesce(sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS gone
  FROM s),
cut AS (
  SELECT held, gone, place FROM o, t
  WHERE 3 * source_size::HUGEINT * (weights - gone) > weight * (total - 3 * held)
  ORDER BY place LIMIT 1),
g AS (
  SELECT o.source, o.source_size,
    CASE WHEN cut.place IS NULL OR o.place < cut.place THEN (3 * o.source_size)::DOUBLE
      ELSE (o.weight * (total - 3 * cut.held))::DOUBLE / (weights - cut.gone)::DOUBLE END AS target
  FROM o CROSS JOIN t LEFT JOIN cut ON true),
r AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE / 281474976710656.0 AS chance
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
  (floor(rate)::BIGINT + (chance < rate - floor(rate))::BIGINT) AS copies,
  (floor(rate)::BIGINT + (chance < rate - floor(rate))::BIGINT) * size AS taken
FROM r
"""


@query("op6_mixing", SQL)
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that the mix takes of it."""
    return mix(table(spark, sf_dir, "documents"), carry=["doc_id"])
