"""Merkle manifest of a data set, by a butterfly exchange of subtree roots.

Each row is a leaf. The leaves of a source, in order of their ids, form a tree of fixed fanout; the roots of the sources, in
order of the sources, form a tree on top. H is the hex digest of concatenated inputs.

1. Leaves are numbered inside their source: range partitions in order, places inside each, one offset per partition.
2. An aligned block of fanout**height leaves hashes its own subtree. A source of any size is many blocks, dealt to all tasks.
3. Butterfly: in round r the blocks whose numbers differ only in digit r (to the base of the fanout) swap the roots of what
   they have covered so far. Each hashes the common ancestor for itself and adds the others to its proof. After the last
   round every block holds the root and all upper proofs: nothing has to come down the tree again. Where the last group
   of a round is short, its blocks answer for the missing ones in turn, so no block waits and none sends to all.
4. The roots of the sources go through 2 and 3 as leaves of the tree on top.
5. Every block meets its leaves once more and gives each its proof: siblings inside the block, then those of the block,
   then those of the source.

A round moves one row per block; leaves (two digests, not texts) are dealt twice.

Cases: null values are hashed as ``-``, so they differ from empty ones; a null source is a source of its own and comes first;
null ids come first; rows that repeat an id are ordered by their leaves, equal ones as read; texts of any length are hashed
whole; empty input gives no rows. Input columns named like a result column are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cartsight.llm.registry import query, table
from cartsight.llm.rows import packed, unpacked, without
from cartsight.sources.tables import settle

FANOUT = 3
HEIGHT = 6  # levels inside a block: 729 leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RESULT = ("leaf", "subroot", "root", "proof", "proof_sha256", "folded_root", "verified")


def leaf_hash(values: Sequence[Column]) -> Column:
    """H of the values in order, each ``-`` if null, else its UTF-8 byte count, ``:`` and the value."""
    parts = []
    for value in values:
        s = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


# --- one block ------------------------------------------------------------------------------------


def H(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def widths(n: int, fanout: int = FANOUT) -> list[int]:
    """Nodes on each level of a tree over ``n`` leaves, up to the one that remains."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // fanout))
    return out


def levels(nodes: list[str], n: int, height: int, fanout: int = FANOUT) -> list[list[str]]:
    """The levels of a block's subtree: ``height`` steps up, fewer where the tree over ``n`` leaves ends before."""
    out = [nodes]
    for _ in range(min(height, len(widths(n, fanout)) - 1)):
        last = out[-1]
        out.append([H(last[i : i + fanout]) for i in range(0, len(last), fanout)])
    return out


def fold(node: str, at: int, n: int, siblings: Sequence[str], fanout: int = FANOUT) -> str:
    """The root over a node at place ``at`` of ``n``, from its siblings level by level."""
    used = 0
    for width in widths(n, fanout)[:-1]:
        mine = at % fanout
        others = min(fanout, width - (at - mine)) - 1
        run = siblings[used : used + others]
        node = H([*run[:mine], node, *run[mine:]])
        used += others
        at //= fanout
    return node


def _siblings(tree: list[list[str]], at: int, fanout: int) -> list[str]:
    """Siblings of the node at place ``at`` of the lowest level, up to the block's root."""
    out: list[str] = []
    for nodes in tree[:-1]:
        first = at - at % fanout
        out += nodes[first:at]
        out += nodes[at + 1 : first + fanout]
        at //= fanout
    return out


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of one block at a time, from rows sorted by tree and block."""
    held: list[dict] = []
    key = None
    for batch in batches:
        for row in batch.to_pylist():
            if (row["tree"], row["block"]) != key:
                if held:
                    yield held
                held, key = [], (row["tree"], row["block"])
            held.append(row)
    if held:
        yield held


# --- numbering ------------------------------------------------------------------------------------


def numbered(rows: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add ``at``, the place from 0 inside the group, and ``n``, the group's rows. Nulls come first; keys are unique.

    Rows are dealt by ranges of (group, order): a group of any size lies in neighbouring partitions. The places
    inside a partition come from the order of its rows, the rest from one count per group and partition.
    """
    keys = [F.col(c).asc_nulls_first() for c in (*group, *order)]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = settle(
        dealt.withColumn("_piece", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    counts = placed.groupBy(*group, "_piece").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy(*group)  # of one row per partition that the group reaches
    before = whole.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *group,
        "_piece",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_offset"),
        F.sum("_rows").over(whole).alias("n"),
    )
    names = {c: f"_of_{c}" for c in (*group, "_piece")}
    offsets = offsets.withColumnsRenamed(names)
    same = [F.col(c).eqNullSafe(F.col(o)) for c, o in names.items()]
    return (
        placed.join(offsets, same)
        .withColumn("at", (F.col("_at") + F.col("_offset")).cast("long"))
        .select(*rows.columns, "at", F.col("n").cast("long").alias("n"))
    )


# --- blocks and the exchange between them ---------------------------------------------------------


def block_roots(leaves: DataFrame, height: int = HEIGHT, fanout: int = FANOUT) -> DataFrame:
    """(tree, block, n, node): the root of every block of (tree, at, n, leaf) rows."""
    schema = T.StructType.fromDDL("tree long, block long, n long, node string")
    arrow = to_arrow_schema(schema)
    size = fanout**height
    rows = leaves.select("tree", F.floor(F.col("at") / size).cast("long").alias("block"), "at", "n", "leaf")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks_of(batches):
            n = block[0]["n"]
            top = levels([r["leaf"] for r in block], n, height, fanout)[-1][0]
            row = {"tree": block[0]["tree"], "block": block[0]["block"], "n": n, "node": top}
            yield pa.RecordBatch.from_pylist([row], schema=arrow)

    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "at").mapInArrow(run, schema)


def butterfly(blocks: DataFrame, height: int = HEIGHT, fanout: int = FANOUT) -> DataFrame:
    """(tree, block, n, node, path): the tree's root and the siblings on the way to it, known to every block.

    ``blocks`` is a stored table of block roots.
    """
    many = F.ceil(F.col("n") / fanout**height).cast("long")
    most = blocks.agg(F.max(many)).first()[0] or 0
    state = blocks.withColumn("many", many).withColumn("path", F.array().cast("array<string>"))
    for r in range(len(widths(most, fanout)) - 1 if most else 0):
        step = fanout**r
        width = F.ceil(F.col("many") / step).cast("long")  # nodes of the tree on this level
        group = F.floor(F.col("block") / step).cast("long")
        short = F.col("many") - (width - 1) * step  # blocks in the last group
        offset = F.col("block") % step
        # the places a block answers for: its own, and in a short last group those of missing blocks
        answers = F.when(group == width - 1, F.sequence(offset, F.lit(step - 1).cast("long"), short)).otherwise(F.array(offset))
        state = state.withColumns({"width": width, "group": group, "mine": offset, "place": F.explode(answers)})
        meet = Window.partitionBy("tree", F.floor(F.col("group") / fanout), "place")
        run = F.array_sort(F.collect_list(F.struct("group", "node")).over(meet))
        state = state.withColumn("run", run).where("place = mine")
        joint = F.sha2(F.concat_ws("", F.col("run.node")), 256)
        others = F.transform(F.filter("run", lambda x: x["group"] != F.col("group")), lambda x: x["node"])
        going = F.col("width") > 1  # trees that have ended keep what they have
        state = state.select(
            "tree",
            "block",
            "n",
            "many",
            F.when(going, joint).otherwise(F.col("node")).alias("node"),
            F.when(going, F.concat("path", others)).otherwise(F.col("path")).alias("path"),
        )
    return state.drop("many")


def block_proofs(leaves: DataFrame, blocks: DataFrame, carry: Sequence[str], height: int = HEIGHT, fanout: int = FANOUT) -> DataFrame:
    """For every leaf its proof: siblings inside the block, the block's path, and the block's ``above``.

    ``leaves`` has tree, at, n, leaf, claim and the columns ``carry``; ``blocks`` tree, block, node, path, and of the tree on
    top: above (siblings), above_at, above_n and root. The claim is folded with the siblings as they are.
    """
    size = fanout**height
    own = [f.name for f in blocks.schema if f.name not in ("tree", "block", "n")]
    marked = leaves.withColumn("block", F.floor(F.col("at") / size).cast("long"))
    both = marked.unionByName(blocks.drop("n").withColumn("at", F.lit(-1).cast("long")), allowMissingColumns=True)
    kinds = {f.name: f for f in both.schema}
    schema = T.StructType(
        [
            *(kinds[c] for c in carry),
            *(T.StructField(c, T.StringType()) for c in ("leaf", "subroot", "root", "folded_root")),
            T.StructField("proof", T.ArrayType(T.StringType())),
            T.StructField("at", T.LongType()),
            T.StructField("tree", T.LongType()),
        ]
    )
    arrow = to_arrow_schema(schema)
    many = 4096  # leaves sent on at a time

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks_of(batches):
            head, rows = block[0], block[1:]
            n = rows[0]["n"]
            tree = levels([r["leaf"] for r in rows], n, height, fanout)
            for i in range(0, len(rows), many):
                made = []
                for place, r in enumerate(rows[i : i + many], i):
                    inside = _siblings(tree, place, fanout) + head["path"]
                    below = fold(r["claim"], r["at"], n, inside, fanout)
                    made.append(
                        {c: r[c] for c in carry}
                        | {
                            "leaf": r["leaf"],
                            "subroot": head["node"],
                            "root": head["root"],
                            "folded_root": fold(below, head["above_at"], head["above_n"], head["above"], fanout),
                            "proof": inside + head["above"],
                            "at": r["at"],
                            "tree": r["tree"],
                        }
                    )
                yield pa.RecordBatch.from_pylist(made, schema=arrow)

    wanted = list(dict.fromkeys(["tree", "block", "at", "n", "leaf", "claim", *carry, *own]))
    return both.select(*wanted).repartition("tree", "block").sortWithinPartitions("tree", "block", "at").mapInArrow(run, schema)


# --- the operator ---------------------------------------------------------------------------------


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    source: str = "source",
    doc_id: str = "doc_id",
    claim: Column | None = None,
    carry: Sequence[str] | None = None,
    height: int = HEIGHT,
    fanout: int = FANOUT,
) -> DataFrame:
    """The carried columns (all, if not named) with ``leaf``, ``subroot``, ``root``, ``proof`` (siblings from the leaf to the
    root), ``folded_root`` (the root that ``claim``, the leaf itself if not given, folds to) and ``verified``."""
    names = [c for c in (docs.columns if carry is None else carry) if c in without(docs, RESULT).columns]
    leaf = leaf_hash([F.col(f"`{c}`") for c in fields])
    rows = settle(
        docs.select(
            packed(names),
            F.col(f"`{source}`").cast("string").alias("_source"),
            F.col(f"`{doc_id}`").cast("long").alias("_id"),
            leaf.alias("leaf"),
            (leaf if claim is None else claim).alias("claim"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    placed = settle(numbered(rows, ["_source"], ["_id", "leaf", "_row"]))
    sources = placed.where("at = 0").select("_source", F.lit(0).alias("_all"))
    ranks = settle(numbered(sources, ["_all"], ["_source"]).select(F.col("_source").alias("_named"), F.col("at").alias("tree")))
    leaves = settle(
        placed.join(ranks, F.col("_source").eqNullSafe(F.col("_named"))).select("tree", "at", "n", "leaf", "claim", "_carried")
    )
    blocks = settle(butterfly(settle(block_roots(leaves, height, fanout)), height, fanout))
    # the tree on top: its leaves are the roots of the sources
    count = F.lit(ranks.count()).cast("long")
    subroots = settle(
        blocks.where("block = 0").select(
            F.lit(0).cast("long").alias("tree"),
            F.col("tree").alias("at"),
            count.alias("n"),
            F.col("node").alias("leaf"),
            F.col("node").alias("claim"),
        )
    )
    tops = settle(butterfly(settle(block_roots(subroots, height, fanout)), height, fanout))
    nothing = {"above": F.array().cast("array<string>"), "above_at": F.lit(0).cast("long"), "above_n": F.lit(1).cast("long")}
    above = block_proofs(subroots, tops.withColumns(nothing | {"root": F.col("node")}), [], height, fanout).select(
        F.col("at").alias("tree"), F.col("proof").alias("above"), F.col("at").alias("above_at"), "root"
    )
    full = settle(blocks.join(above, "tree").withColumn("above_n", count))
    found = block_proofs(leaves, full, ["_carried"], height, fanout)
    return found.select(
        *unpacked(names),
        "leaf",
        "subroot",
        "root",
        "proof",
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


# Levels by recursion; a claim is folded by recursion over the levels, with the siblings joined in their order. The sum
# of the bytes' checksum is computed bit by bit, as there is no such function.
SQL = r"""
WITH RECURSIVE b AS (
  SELECT doc_id, source, lang, n_chars, text, replace(text, chr(10), '') AS cut,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda s, c: list_reduce(list_prepend(xor(s, c), [0,0,0,0,0,0,0,0]::BIGINT[]),
        lambda x, i: xor(x >> 1, (x & 1) * 3988292384::BIGINT))), 4294967295::BIGINT) % 2 AS odd
  FROM documents),
l AS (
  SELECT doc_id, source,
    concat(coalesce(strlen(doc_id::VARCHAR)::VARCHAR || ':' || doc_id::VARCHAR, '-'), coalesce(strlen(source)::VARCHAR || ':' || source, '-'),
      coalesce(strlen(lang)::VARCHAR || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars::VARCHAR, '-')) AS head,
    coalesce(strlen(text)::VARCHAR || ':' || text, '-') AS tail, coalesce(strlen(cut)::VARCHAR || ':' || cut, '-') AS cut_tail, odd
  FROM b),
leaves AS (
  SELECT doc_id, source, sha256(head || tail) AS leaf, sha256(head || CASE WHEN odd = 0 THEN cut_tail ELSE tail END) AS claim,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
  FROM l),
up AS (
  SELECT source, 0 AS level, pos, n, leaf AS node FROM leaves
  UNION ALL
  SELECT source, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY pos)) FROM up WHERE n > 1
  GROUP BY source, level, pos // 3, n),
subs AS (
  SELECT source, node AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (
  SELECT 0 AS level, pos, n, subroot AS node FROM subs
  UNION ALL
  SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY level, pos // 3, n),
low AS (
  SELECT doc_id, source, leaf, pos, n, 0 AS level, claim AS node, '' AS proof FROM leaves
  UNION ALL
  SELECT k.doc_id, k.source, k.leaf, k.pos // 3, (k.n + 2) // 3, k.level + 1,
    sha256(string_agg(CASE WHEN u.pos = k.pos THEN k.node ELSE u.node END, '' ORDER BY u.pos)),
    k.proof || coalesce(string_agg(u.node, '' ORDER BY u.pos) FILTER (WHERE u.pos <> k.pos), '')
  FROM low k JOIN up u ON u.source IS NOT DISTINCT FROM k.source AND u.level = k.level AND u.pos // 3 = k.pos // 3
  WHERE k.n > 1 GROUP BY k.doc_id, k.source, k.leaf, k.pos, k.n, k.level, k.node, k.proof),
high AS (
  SELECT w.doc_id, w.source, w.leaf, s.subroot, s.pos, s.n, 0 AS level, w.node, w.proof
  FROM low w JOIN subs s ON s.source IS NOT DISTINCT FROM w.source WHERE w.n = 1
  UNION ALL
  SELECT k.doc_id, k.source, k.leaf, k.subroot, k.pos // 3, (k.n + 2) // 3, k.level + 1,
    sha256(string_agg(CASE WHEN u.pos = k.pos THEN k.node ELSE u.node END, '' ORDER BY u.pos)),
    k.proof || coalesce(string_agg(u.node, '' ORDER BY u.pos) FILTER (WHERE u.pos <> k.pos), '')
  FROM high k JOIN top u ON u.level = k.level AND u.pos // 3 = k.pos // 3
  WHERE k.n > 1 GROUP BY k.doc_id, k.source, k.leaf, k.subroot, k.pos, k.n, k.level, k.node, k.proof)
SELECT h.doc_id, h.leaf, h.subroot, t.node AS root, sha256(h.proof) AS proof_sha256, h.node AS folded_root, h.node = t.node AS verified
FROM high h JOIN top t ON t.n = 1 WHERE h.n = 1
"""


@query("op13_merkle", SQL)
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its leaf, the roots above it, and whether the document, cut in one half of them, folds to the root."""
    docs = table(spark, sf_dir, "documents")
    cut = [F.replace(F.col(c), F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in FIELDS]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    claim = F.when(tampered, leaf_hash(cut)).otherwise(leaf_hash([F.col(c) for c in FIELDS]))
    found = manifest(docs, claim=claim, carry=["doc_id"])
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.concat_ws("", "proof"), 256).alias("proof_sha256"),
        "folded_root",
        "verified",
    )
