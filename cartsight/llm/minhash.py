"""MinHash near duplicates by fast similarity sketching, banding and exact verification.

A document's set holds its distinct shingles as 64-bit hashes. The sketch has T coordinates, filled in rounds: in each of the
first T rounds every element is thrown into one hashed bin with a hashed value behind the round's number, and the smallest
stays; in round T + i all elements are thrown into bin i. It ends when all bins are full, so every coordinate is filled,
agrees with probability J, and a set of k elements takes about T ln T / k rounds.

Bands of R coordinates are keys. Equal sets are one node. Buckets link nodes in two steps, neither of which emits all pairs:

1. Every member of a bucket is paired with the bucket's first (in some bands by id, in others by hash), pairs are verified on
   whole sets, and components found. Most groups are one component then.
2. What is left is buckets of three and more whose members lie in different components; of buckets with the same
   members one stays. Their sets meet in one task each, where every member outside the most frequent component is held
   against all members of other components, over an index of their elements. Buckets of more than ``chunk`` members are
   dealt into chunks, and those members visit each chunk. So no two documents that share a bucket stay unverified
   unless they are connected already.

A pair of similarity s shares no band with probability (1 - s**R)**B: 8e-5 at 0.85, with the parameters below.

Cases: null text has no words; no words give the empty set, which is linked with nothing; fewer words than a shingle
give one shingle of them all; repeated shingles count once. Null ids come after all others: a group has component null only
if all its ids are null. One row of each group is kept, the first read of those with the smallest id. Input columns
named like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cartsight.llm.components import connected_components
from cartsight.llm.registry import query, table
from cartsight.llm.rows import packed, slices, unpacked, without
from cartsight.llm.words import hashed_words
from cartsight.sources.tables import settle

SHINGLE = 3
PERCENT = 85
BANDS = 16
ROWS = 5
CHUNK = 512  # members of a bucket that are indexed together
BY_HASH = 4  # bands whose first member is chosen by hash
RESULT = ("n_shingles", "component_id", "kept")
FEW = 1_000_000  # ids that are broadcast: 8 bytes each
FOLD = np.uint64(0x9E3779B97F4A7C15)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


# --- sets and sketches ----------------------------------------------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: Sequence[str | None], shingle: int) -> list[np.ndarray]:
    """For each text the distinct shingles' hashes, in order."""
    words, sizes = hashed_words(texts)
    out, at = [], 0
    for n in sizes.tolist():
        own, at = words[at : at + n], at + n
        size = min(shingle, n)
        joined = np.full(max(0, n - size + 1) if n else 0, size, np.uint64)
        for k in range(size):
            joined = mixed(joined * FOLD + own[k : k + len(joined)])
        out.append(np.unique(joined))
    return out


def sketches(sets: Sequence[np.ndarray], size: int) -> np.ndarray:
    """A row of ``size`` coordinates per set; every coordinate of a set that is not empty is filled."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full((len(sets), size), empty)
    flat = out.reshape(-1)
    live = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
    if not len(live):
        return out
    elements = np.concatenate([sets[i] for i in live])
    owner = np.repeat(live, [len(sets[i]) for i in live])
    for turn in range(2 * size):
        thrown = mixed(elements ^ mixed(np.full(1, turn + 1, np.uint64) * FOLD))
        if turn < size:
            bins = ((thrown >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        else:
            bins = np.full(len(thrown), turn - size, np.int64)
        # the low half has not chosen the bin; one more scramble makes it a value of 52 bits behind the round's number
        value = (np.uint64(turn) << np.uint64(52)) | (mixed(thrown ^ FOLD) >> np.uint64(12))
        np.minimum.at(flat, owner * size + bins, value)
        open_ = (out[live] == empty).any(axis=1)
        if not open_.all():
            live = live[open_]
            if not len(live):
                break
            stay = np.zeros(len(sets), bool)
            stay[live] = True
            stays = stay[owner]
            elements, owner = elements[stays], owner[stays]
    return out


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per sketch and band."""
    keys = np.zeros((len(sketch), bands), np.uint64)
    for r in range(rows):
        keys = mixed(keys * FOLD + sketch[:, r::rows][:, :bands])
    return keys


def add_sketches(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """All columns but ``_text``, with ``_n`` (set size), ``_digest`` (of the set) and ``_keys``."""
    fields = T.StructType.fromDDL("_n long, _digest binary, _keys array<long>")
    kept = docs.drop("_text")
    names = kept.columns
    schema = T.StructType([*kept.schema.fields, *fields.fields])
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("_text"))
            for at, n in slices(texts):
                sets = shingle_sets(texts.slice(at, n).to_pylist(), shingle)
                keys = band_keys(sketches(sets, bands * rows), bands, rows).astype(np.int64)
                offsets = pa.array(np.arange(n + 1) * bands, pa.int32())
                made = [
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(offsets, pa.array(keys.reshape(-1))).cast(arrow.types[2]),
                ]
                own = [batch.column(batch.schema.get_field_index(c)).slice(at, n) for c in names]
                yield pa.RecordBatch.from_arrays([*own, *made], names=[*names, *arrow.names])

    return docs.select(*names, "_text").mapInArrow(run, schema)


def whole_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(node, set): the sets, as bytes, of some nodes. ``docs`` has _id and _text; ``wanted`` is stored: node, id, digest.

    Texts are read again for these nodes alone, found by their ids; rows that repeat an id are told apart by the digest.
    """
    ids = wanted.select(F.col("id").alias("_wanted")).distinct()
    if wanted.count() <= FEW:
        ids = F.broadcast(ids)
    again = docs.select("_id", "_text").join(ids, F.col("_id").eqNullSafe(F.col("_wanted")), "left_semi").select("_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n in slices(batch.column(0)):
                data = [s.tobytes() for s in shingle_sets(batch.column(0).slice(at, n).to_pylist(), shingle)]
                made = [pa.array([xxhash.xxh3_128_digest(d) for d in data], pa.binary()), pa.array(data, pa.binary())]
                yield pa.RecordBatch.from_arrays(made, names=["of", "set"])

    found = again.mapInArrow(run, "of binary, set binary").join(wanted, F.col("of") == F.col("digest"))
    return found.select("node", "set").dropDuplicates(["node"])


# --- verification ---------------------------------------------------------------------------------


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets of distinct elements have 100 * intersection >= percent * union."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _near_size(a: Column | str, b: Column | str, percent: int) -> Column:
    """Without this the sets cannot be similar."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) whose sets are similar. ``sets`` has node and set."""
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("of_a")), "a")
    full = left.join(sets.select(F.col("node").alias("b"), F.col("set").alias("of_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [
                similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                for x, y in zip(map(pa.BinaryScalar.as_py, batch.column(2)), map(pa.BinaryScalar.as_py, batch.column(3)))
            ]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return full.select("a", "b", "of_a", "of_b").mapInArrow(run, "a long, b long")


def first_pairs(keyed: DataFrame, percent: int, by_hash: int = BY_HASH) -> DataFrame:
    """Distinct (a, b) of every member of a bucket with the bucket's first. ``keyed`` has band, key, node and n."""
    order = F.when(F.col("band") < by_hash, F.xxhash64("node", "band")).otherwise(F.col("node"))
    first = (
        keyed.groupBy("band", "key")
        .agg(F.min(F.struct(order.alias("o"), F.col("node"), F.col("n"))).alias("first"), F.count(F.lit(1)).alias("many"))
        .where("many > 1")
        .select("band", "key", F.col("first.node").alias("head"), F.col("first.n").alias("head_n"))
    )
    met = keyed.join(first, ["band", "key"]).where((F.col("node") != F.col("head")) & _near_size("n", "head_n", percent))
    return met.select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct()


def open_buckets(keyed: DataFrame, roots: DataFrame) -> DataFrame:
    """(band, key, node, n, root, main, many): members of buckets of three and more whose components differ.

    Of buckets with the same members one is left. ``main`` is the bucket's most frequent component.
    """
    found = roots.select(F.col("node").alias("of"), "root")
    rooted = keyed.join(found, keyed.node == found.of, "left").select(
        "band", "key", "node", "n", F.coalesce("root", "node").alias("root")
    )
    one = F.xxhash64("node").cast("decimal(38,0)")
    per_root = rooted.groupBy("band", "key", "root").agg(
        F.count(F.lit(1)).alias("c"), F.sum(one).alias("s"), F.bit_xor(F.xxhash64(F.col("node"), F.lit("x"))).alias("x")
    )
    per_bucket = (
        per_root.groupBy("band", "key")
        .agg(
            F.sum("c").alias("many"),
            F.sum("s").alias("s"),
            F.bit_xor("x").alias("x"),
            F.count(F.lit(1)).alias("roots"),
            F.max(F.struct("c", "root")).alias("main"),
        )
        .where("many > 2 AND roots > 1")
    )
    one_each = per_bucket.groupBy("many", "s", "x").agg(F.min(F.struct("band", "key", "main")).alias("least"))
    chosen = one_each.select("least.band", "least.key", F.col("least.main.root").alias("main"), "many")
    return rooted.join(chosen, ["band", "key"])


def bucket_links(members: DataFrame, sets: DataFrame, percent: int, chunk: int = CHUNK) -> DataFrame:
    """Links (a, b) that join the components which have similar members in a bucket."""
    chunks = F.ceil(F.col("many") / chunk).cast("int")
    own = F.pmod(F.xxhash64("node"), chunks).cast("int")
    # members outside the main component visit every chunk; all belong to one
    visits = F.when(F.col("root") != F.col("main"), F.sequence(F.lit(0), chunks - 1)).otherwise(F.array(own))
    dealt = members.withColumn("own", own).withColumn("chunk", F.explode(visits)).withColumn("guest", F.col("own") != F.col("chunk"))
    full = dealt.join(sets.select(F.col("node").alias("of"), "set"), F.col("node") == F.col("of")).select(
        "band", "key", "chunk", "guest", "node", "root", (F.col("root") == F.col("main")).alias("main"), "set"
    )

    def links_of(base: list[tuple], guests: Iterator[tuple]) -> Iterator[tuple[int, int]]:
        """Links that join components: of members outside the main one, and of guests, with the members."""
        values = [np.frombuffer(b[3], np.uint64) for b in base]
        sizes = np.array([len(v) for v in values])
        elements = np.concatenate(values)
        order = np.argsort(elements, kind="stable")
        elements, owner = elements[order], np.repeat(np.arange(len(base)), sizes)[order]
        top: dict[int, int] = {}

        def root_of(r: int) -> int:
            while r in top:
                r = top[r]
            return r

        for node, root, _, data in chain((b for b in base if not b[2]), guests):
            mine = np.frombuffer(data, np.uint64)
            low, high = np.searchsorted(elements, mine, "left"), np.searchsorted(elements, mine, "right")
            held = high - low
            places = np.repeat(low - np.cumsum(held) + held, held) + np.arange(held.sum())
            both = np.bincount(owner[places], minlength=len(base))
            for j in np.nonzero(100 * both >= percent * (sizes + len(mine) - both))[0].tolist():
                x, y = root_of(root), root_of(base[j][1])
                if x != y:
                    top[max(x, y)] = min(x, y)
                    yield node, base[j][0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for r in zip(*(c.to_pylist() for c in batch.columns)):
                    yield r[:3], r[3], r[4:]

        stream = rows()
        row = next(stream, None)
        while row is not None:
            key, base, made = row[0], [], []
            while row is not None and row[0] == key and not row[1]:
                base.append(row[2])
                row = next(stream, None)

            def guests() -> Iterator[tuple]:
                nonlocal row
                while row is not None and row[0] == key:
                    yield row[2]
                    row = next(stream, None)

            if base:
                made = list(links_of(base, guests()))
            for _ in guests():  # of a chunk without members
                pass
            if made:
                a, b = zip(*made)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return (
        full.repartition("band", "key", "chunk")
        .sortWithinPartitions("band", "key", "chunk", "guest")
        .mapInArrow(run, "a long, b long")
    )


# --- the operator ---------------------------------------------------------------------------------


def similar_groups(
    nodes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int = PERCENT, chunk: int = CHUNK
) -> DataFrame:
    """(node, root) of every node with a link to another.

    ``nodes`` has node, n and keys (one per band); ``sets_of`` gives (node, set) of a stored table of some nodes.
    """
    every = settle(nodes.select("node", "n", F.posexplode("keys").alias("band", "key")))
    shared = every.groupBy("band", "key").agg(F.count(F.lit(1)).alias("many")).where("many > 1").select("band", "key")
    keyed = settle(every.join(shared, ["band", "key"]))
    # only nodes that share a bucket need their sets
    sets = settle(sets_of(settle(keyed.select("node").distinct())))
    links = verified(first_pairs(keyed, percent), sets, percent)
    roots = settle(connected_components(links))
    more = settle(bucket_links(settle(open_buckets(keyed, roots)), sets, percent, chunk))
    if more.isEmpty():
        return roots
    # the components so far are the nodes of what has been found since
    root = roots.select(F.col("node").alias("of"), "root")
    ends = more.join(root.withColumnsRenamed({"of": "a", "root": "ra"}), "a", "left").join(
        root.withColumnsRenamed({"of": "b", "root": "rb"}), "b", "left"
    )
    joined = settle(connected_components(ends.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))))
    last = joined.select(F.col("node").alias("from"), F.col("root").alias("to"))
    known = roots.unionByName(last.select(F.col("from").alias("node"), F.col("from").alias("root")).join(roots.select("node"), "node", "left_anti"))
    return known.join(last, F.col("root") == F.col("from"), "left").select("node", F.coalesce("to", "root").alias("root"))


def near_groups(
    docs: DataFrame,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: Sequence[str] | None = None,
    chunk: int = CHUNK,
) -> DataFrame:
    """The carried columns (all, if not named) with ``n_shingles``, ``component_id``, the smallest id reachable, and ``kept``."""
    names = [c for c in (docs.columns if carry is None else carry) if c in without(docs, RESULT).columns]
    marked = docs.select(
        packed(names),
        F.col(f"`{doc_id}`").cast("long").alias("_id"),
        F.col(f"`{text}`").alias("_text"),
        F.monotonically_increasing_id().alias("_row"),
    )
    made = settle(add_sketches(marked, shingle, bands, rows))
    least = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_row").alias("row")))
    # a node is the row that its set's group would keep
    groups = settle(made.where("_n > 0").groupBy("_digest").agg(least.alias("least")).withColumn("node", F.col("least.row")))
    nodes = made.select(F.col("_row").alias("node"), F.col("_n").alias("n"), F.col("_keys").alias("keys"))
    own = groups.select("node", F.col("least.id").alias("id"), F.col("_digest").alias("digest"))

    def sets_of(some: DataFrame) -> DataFrame:
        return whole_sets(marked, settle(own.join(some, "node", "left_semi")), shingle)

    roots = settle(similar_groups(nodes.join(groups.select("node"), "node", "left_semi"), sets_of, percent, chunk))
    roots = roots.withColumnRenamed("node", "of")
    linked = groups.join(roots, F.col("node") == F.col("of")).select("node", "root", "least")
    smallest = linked.groupBy("root").agg(F.min("least").alias("owner"))
    found = linked.select(F.col("node").alias("of"), "root").join(smallest, "root").select("of", "owner")
    owners = settle(
        groups.join(found, F.col("node") == F.col("of"), "left").select(
            F.col("_digest").alias("_of"), F.coalesce("owner", "least").alias("_owner")
        )
    )
    out = made.select("_carried", "_id", "_row", "_n", "_digest").join(owners, (F.col("_digest") == F.col("_of")) & (F.col("_n") > 0), "left")
    alone = F.col("_owner").isNull()  # the empty set
    return out.select(
        *unpacked(names),
        F.col("_n").alias("n_shingles"),
        F.when(alone, F.col("_id")).otherwise(F.col("_owner.id")).alias("component_id"),
        (alone | (F.col("_row") == F.col("_owner.row"))).alias("kept"),
    )


@query("op11_minhash")
def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its set's size and its component at 85 % of the union."""
    found = near_groups(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
