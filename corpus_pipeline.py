"""Corpus pipeline: filter, deduplicate, mix and tokenize ``documents``.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a frame. All but
the last return the columns of ``docs``, so a stage's result can be stored as Parquet and read as the
next one's input.

Cases: null and empty texts are rejected by the first stage; repeated rows are left once by the second;
a null source is a source of its own; empty input gives empty output; extra columns pass through all stages
but the last, and result columns of an operator that are named like them do not replace them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartsight.llm import bpe, linecrf, mixing, simhash, trie
from cartsight.llm.registry import table
from cartsight.llm.ship import ship
from cartsight.sources.tables import settle

MARK = "_pipeline_"


def _aside(docs: DataFrame) -> DataFrame:
    """Columns under names that no operator uses, but for those that the operators read."""
    read = {"doc_id", "text", "source"}
    return docs.select(*(F.col(f"`{c}`").alias(c if c in read else f"{MARK}{c}") for c in docs.columns))


def _back(kept: DataFrame, columns: list[str]) -> DataFrame:
    read = {"doc_id", "text", "source"}
    return kept.select(*(F.col(f"`{c if c in read else MARK + c}`").alias(c) for c in columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the plain rules and the labelling of their lines."""
    ship(spark)
    field = linecrf.train(docs, table(spark, sf_dir, "labels"))
    return _back(linecrf.judge(_aside(docs), field).where("kept"), docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of those that are equal without white space."""
    ship(spark)
    return _back(trie.exact_groups(_aside(docs)).where("kept"), docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near fingerprints."""
    ship(spark)
    return _back(simhash.near_groups(_aside(docs), shingle=3, bits=2).where("kept"), docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    ship(spark)
    mixed = mixing.mix(_aside(docs)).where("copies > 0")
    return _back(mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))), docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and digests of the ids and of the text decoded from them."""
    ship(spark)
    return bpe.round_trip(docs.select("doc_id", "source", "text")).select(
        "doc_id",
        "source",
        "n_tokens",
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("mix_sources", mix_sources),
    ("tokenize", tokenize),
]

#: SQL cannot decode a trained field or apply merges; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each result but the last is stored in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
