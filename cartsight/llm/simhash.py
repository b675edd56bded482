"""SimHash near duplicates with Golay-code keys.

A 64-bit fingerprint is cut into three segments, each padded to the 23 bits of the perfect binary Golay
code. Two fingerprints with at most two differing bits have, among the pairs of neighbouring segments
(1,2), (2,3), (3,1), one whose first segment is equal and whose second differs in one bit at most.
The first goes into a key as it is. The second is decoded: its nearest codeword, and if that
is three bits away also the five codewords at four bits, give one or six 12-bit indices. Two words that
differ in one bit always share an index. So every close pair meets in a bucket, and is verified there.

Buckets of up to ``crowd`` fingerprints are compared inside; each gives a spanning forest of its
links, not all pairs. The fingerprints of larger buckets are linked exactly by another road: each is
listed under itself and its 64 one-bit changes; two are close if and only if they share such a middle,
and a middle has at most 65 fingerprints, all close to each other, which are linked to the smallest one.

Equal fingerprints are one node, so copies cost nothing beyond the first.

Cases: null text has no words; no words give fingerprint zero, linked like any other; fewer words than
a shingle give one shingle of all of them; repeated shingles count as often as they occur. Null ids come
after all others: a group has component null only if all its ids are null. One row of each group is kept, the
first read of those with the smallest id. Input columns named like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartsight.llm.components import connected_components
from cartsight.llm.registry import query, table
from cartsight.llm.rows import add_columns, packed, unpacked, without
from cartsight.sources.tables import settle

SEED = 42
CROWD = 256
PIECE = 1 << 16  # shingles hashed at a time
RESULT = ("fingerprint", "component_id", "kept")
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, bits
GOLAY = 0xC75  # generator polynomial of the (23,12) code (fixed value)


# --- fingerprints ---------------------------------------------------------------------------------


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Bit i is set if it is set in more than half of the shingles' XXH64 values."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    stops = np.cumsum(lengths + 1) - 1
    starts = (stops - lengths)[: len(words) - size + 1].tolist()
    stops = stops[size - 1 :].tolist()
    digest = partial(xxhash.xxh64_intdigest, seed=SEED)
    total = np.zeros(64, np.int64)
    for at in range(0, len(starts), PIECE):
        part = [line[i:j] for i, j in zip(starts[at : at + PIECE], stops[at : at + PIECE])]
        h = np.fromiter(map(digest, part), np.uint64, len(part))
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = 2 * total > len(starts)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little", signed=True)


def add_fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text") -> DataFrame:
    """All columns and ``_print``, the fingerprint as a long."""
    fields = T.StructType([T.StructField("_print", T.LongType())])
    return add_columns(docs, fields, lambda texts: [pa.array([fingerprint(t, shingle) for t in texts], pa.int64())], text)


# --- Golay keys -----------------------------------------------------------------------------------


def _remainder(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GOLAY << (bit - 11)
    return word


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and the high 11 bits; error patterns of each syndrome and their number."""
    low = np.array([_remainder(w) for w in range(1 << 12)], np.int64)
    high = np.array([_remainder(w << 12) for w in range(1 << 11)], np.int64)
    bit = [_remainder(1 << i) for i in range(23)]
    errors: list[list[int]] = [[] for _ in range(1 << 11)]

    def walk(weight: int, first: int, word: int, syndrome: int, most: int) -> None:
        if weight == most:
            found = errors[syndrome]
            # four errors count only beside a nearest codeword that is three away
            if most < 4 or (found and bin(found[0]).count("1") == 3):
                found.append(word)
            return
        for i in range(first, 23):
            walk(weight + 1, i + 1, word | 1 << i, syndrome ^ bit[i], most)

    for most in range(5):
        walk(0, 0, 0, 0, most)
    number = np.array([len(e) for e in errors])
    grid = np.array([e + [e[0]] * (6 - len(e)) for e in errors], np.int64)
    return low, high, grid, number


_LOW, _HIGH, _ERRORS, _NUMBER = _tables()


def golay_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Six 12-bit indices per 23-bit word, and how many of them (one or six) count."""
    syndrome = _LOW[words & 0xFFF] ^ _HIGH[words >> 12]
    return (words[:, None] ^ _ERRORS[syndrome]) >> 11, _NUMBER[syndrome]


def segment_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all keys of all fingerprints."""
    u = prints.view(np.uint64)
    parts = [((u >> np.uint64(s)) & np.uint64((1 << n) - 1)).astype(np.int64) for s, n in SEGMENTS]
    rows, keys = [], []
    for i in range(3):
        index, number = golay_indices(parts[(i + 1) % 3])
        key = (i << 40) | (parts[i][:, None] << 12) | index
        use = np.arange(6) < number[:, None]
        rows.append(np.nonzero(use)[0])
        keys.append(key[use])
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(prints: DataFrame) -> DataFrame:
    """(key, print) rows of distinct fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.asarray(batch.column(0)).astype(np.int64)
            if len(values):
                rows, keys = segment_keys(values)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(values[rows])], names=["key", "print"])

    return prints.select("print").mapInArrow(run, "key long, print long")


def forest(values: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the close pairs among some fingerprints."""
    u = values.view(np.uint64)
    first, second = np.nonzero(np.triu(np.bitwise_count(u[:, None] ^ u[None]) <= bits, 1))
    top = list(range(len(u)))
    links = []
    for i, j in zip(first.tolist(), second.tolist()):
        a, b = i, j
        while top[a] != a:
            top[a] = top[top[a]]
            a = top[a]
        while top[b] != b:
            top[b] = top[top[b]]
            b = top[b]
        if a != b:
            top[b] = a
            links.append((int(values[i]), int(values[j])))
    return links


def _bucket_links(buckets: DataFrame, bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            offsets, flat = lists.offsets.to_pylist(), np.asarray(lists.values)
            links = [x for i, j in zip(offsets, offsets[1:]) for x in forest(np.unique(flat[i:j]), bits)]
            a, b = zip(*links) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return buckets.select("prints").mapInArrow(run, "a long, b long")


def links(prints: DataFrame, bits: int = 2, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints of ``print`` within ``bits`` differing bits, at most 2."""
    if not 0 <= bits <= 2:
        raise ValueError("the keys guarantee close pairs up to 2 bits")
    keyed = settle(_keyed(prints))
    counts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    few = keyed.join(counts.where(F.col("n").between(2, crowd)), "key", "left_semi")
    # the join may be split at a crowded key; the buckets are then dealt anew, each with at most `crowd` rows
    buckets = few.repartition("key").groupBy("key").agg(F.collect_list("print").alias("prints"))
    crowded = keyed.join(counts.where(F.col("n") > crowd), "key", "left_semi").select("print").distinct()
    return _bucket_links(buckets, bits).unionByName(middle_links(crowded, bits))


def middle_links(prints: DataFrame, bits: int) -> DataFrame:
    """Links over shared one-bit changes: no bucket has more than 65 distinct fingerprints.

    Fingerprints with a common middle differ in two bits at most; for smaller ``bits`` only the fingerprint
    itself as the middle (1 bit) or nothing (0 bits) counts.
    """
    if bits == 0:
        return prints.select(F.col("print").alias("a"), F.col("print").alias("b")).where("false")
    changes = F.array(F.lit(0).cast("long"), *(F.expr(f"shiftleft(1L, {i})") for i in range(64)))
    spread = prints.select("print", F.explode(F.transform(changes, lambda c: F.col("print").bitwiseXOR(c))).alias("middle"))
    if bits == 1:
        near = prints.select(F.col("print").alias("middle"))
        return spread.join(near, "middle").where("print != middle").select(F.col("print").alias("a"), F.col("middle").alias("b"))
    least = spread.groupBy("middle").agg(F.min("print").alias("a"), F.collect_set("print").alias("all")).where("size(all) > 1")
    return least.select("a", F.explode("all").alias("b")).where("a != b").distinct()


# --- the operator ---------------------------------------------------------------------------------


def near_groups(
    docs: DataFrame,
    shingle: int = 3,
    bits: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: Sequence[str] | None = None,
    crowd: int = CROWD,
) -> DataFrame:
    """The carried columns (all, if not named) with ``fingerprint``, ``component_id``, the smallest id reachable, and ``kept``."""
    names = [c for c in (docs.columns if carry is None else carry) if c in without(docs, RESULT).columns]
    marked = docs.select(
        packed(names),
        F.col(f"`{doc_id}`").cast("long").alias("_id"),
        F.col(f"`{text}`").alias("_text"),
        F.monotonically_increasing_id().alias("_row"),
    )
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_row").alias("row")))
    rows = settle(add_fingerprints(marked, shingle, "_text").drop("_text"))
    prints = settle(rows.groupBy(F.col("_print").alias("print")).agg(first.alias("least")))
    roots = settle(connected_components(links(prints, bits, crowd)))
    linked = prints.join(roots, prints.print == roots.node).select("print", "root", "least")
    smallest = linked.groupBy("root").agg(F.min("least").alias("_component"))
    found = linked.select("print", "root").join(smallest, "root").select(F.col("print").alias("_node"), "_component")
    single = prints.select(F.col("print").alias("_print"), "least")
    # stored, so that the last join reads two shuffles and Spark can split a frequent fingerprint on the left
    ids = settle(
        single.join(found, single._print == found._node, "left").select(
            "_print", F.when(F.col("_node").isNull(), F.col("least")).otherwise(F.col("_component")).alias("_owner")
        )
    )
    return rows.join(ids, "_print").select(
        *unpacked(names),
        F.lpad(F.lower(F.hex("_print")), 16, "0").alias("fingerprint"),
        F.col("_owner.id").alias("component_id"),
        (F.col("_row") == F.col("_owner.row")).alias("kept"),
    )


@query("op3_simhash")
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and its component at two bits."""
    return near_groups(table(spark, sf_dir, "documents"), shingle=3, bits=2, carry=["doc_id"])
