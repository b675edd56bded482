"""Exact duplicates by Patricia tries over whole byte strings.

1. Every input partition inserts its normalised texts into a compressed radix trie. A terminal node
   holds the best row so far (most code points, then smallest id) and the number of rows. When the
   trie holds more than a bound, its largest subtree leaves it as partial rows.
2. The partial rows, one per text and input partition at most (and subtree spilled), are dealt by length and
   content hash and sorted by them, so that a trie is needed for one (length, hash) at a time and leaves
   memory as the next begins. Copies of a text meet there as partial rows, never as documents.
3. Owners of texts with more than one row go back to the documents by length and digest.

Step 1 is stored once in the shared folder: the branches see the same rows, and a lost executor costs
no second pass.

Cases: null text counts as empty; all empty texts are one group; of rows that are equal in
code points and id, the first read stays; a null id sorts after all others; texts of any length are
compared whole. Input columns named like a result column are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cartsight.llm.registry import query, table
from cartsight.llm.rows import packed, slices, unpacked, without
from cartsight.sources.tables import settle

WHITE = b" \t\n\r\x0b\x0c"
TRIE_BYTES = 48 << 20  # held by a trie before a subtree leaves it
ROW_BYTES = 4 << 20  # of partial rows sent on at a time


class Node:
    """A trie node: the bytes that lead to it, its children by first byte, and the payload of a text that ends here."""

    __slots__ = ("label", "children", "best", "count")

    def __init__(self, label: bytes) -> None:
        self.label = label
        self.children: dict[int, Node] = {}
        self.best: tuple | None = None
        self.count = 0


def _shared_length(label: bytes, key: bytes, at: int) -> int:
    """Length of the common start of ``label`` and ``key[at:]``, by halving."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if key[at + low : at + mid] == label[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


class Trie:
    """Compressed radix trie of byte strings; ``held`` counts the bytes of its labels."""

    def __init__(self) -> None:
        self.root = Node(b"")
        self.held = 0

    def insert(self, key: bytes, best: tuple, count: int) -> None:
        """Add ``count`` rows of the text ``key``; the smaller ``best`` stays."""
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = Node(key[at:])
                self.held += len(child.label) + 200
                at = len(key)
            elif key.startswith(child.label, at):
                at += len(child.label)
            else:
                k = _shared_length(child.label, key, at)
                fork = node.children[key[at]] = Node(child.label[:k])
                child.label = child.label[k:]
                fork.children[child.label[0]] = child
                self.held += 200
                child = fork
                at += k
            node = child
        node.best = best if node.best is None else min(node.best, best)
        node.count += count

    def terminals(self, node: Node | None = None, before: bytes = b"") -> Iterator[tuple[bytes, tuple, int]]:
        """(text, best, count) of every text below a node."""
        stack = [(node or self.root, before)]
        while stack:
            node, before = stack.pop()
            key = before + node.label
            if node.best is not None:
                yield key, node.best, node.count
            stack.extend((c, key) for c in node.children.values())

    def spill(self) -> Iterator[tuple[bytes, tuple, int]]:
        """Cut off the largest subtree at the root and give its texts."""
        sizes = {}
        for first, child in self.root.children.items():
            total, stack = 0, [child]
            while stack:
                n = stack.pop()
                total += len(n.label) + 200
                stack.extend(n.children.values())
            sizes[first] = total
        first = max(sizes, key=sizes.get)
        self.held -= sizes[first]
        return self.terminals(self.root.children.pop(first))


KEYS = T.StructType(
    [
        T.StructField("_length", T.LongType()),
        T.StructField("_hash", T.LongType()),
        T.StructField("_sha", T.BinaryType()),
        T.StructField("_chars", T.LongType()),
        T.StructField("_id", T.LongType()),
        T.StructField("_row", T.LongType()),
        T.StructField("_count", T.LongType()),
        T.StructField("_bytes", T.BinaryType()),
    ]
)
RESULT = ("keep_id", "group_size", "kept", "text_sha256")


def _key_arrays(rows: list[tuple]) -> list[pa.Array]:
    types = to_arrow_schema(KEYS).types
    return [pa.array(list(c), t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types]


def _keys_of(data: bytes) -> tuple[int, int, bytes]:
    digest = hashlib.sha256(data).digest()
    return len(data), int.from_bytes(digest[:8], "big", signed=True), digest


def _partial(key: bytes, best: tuple, count: int) -> tuple:
    chars, no_id, doc_id, row = best
    return (*_keys_of(key), -chars, None if no_id else doc_id, row, count, key)


def _in_bounds(rows: Iterator[tuple], size: int = ROW_BYTES) -> Iterator[list[tuple]]:
    held, total = [], 0
    for r in rows:
        held.append(r)
        total += len(r[-1] or b"") + 200
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


def local_tries(docs: DataFrame, carry: Sequence[str], doc_id: str, text: str, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """A row per document (carried columns and keys) and a partial row per text of each partition (keys and bytes)."""
    source = docs.select(
        packed(carry),
        F.col(f"`{doc_id}`").cast("long").alias("_id"),
        F.col(f"`{text}`").alias("_text"),
        F.monotonically_increasing_id().alias("_row"),
    )
    schema = T.StructType([T.StructField("_carried", source.schema[0].dataType, True), *KEYS.fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie()

        def sent(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
            for part in _in_bounds(rows):
                empty = pa.nulls(len(part), arrow.field(0).type)
                yield pa.RecordBatch.from_arrays([empty, *_key_arrays(part)], schema=arrow)

        for batch in batches:
            names = batch.schema.names
            texts = batch.column(names.index("_text"))
            for at, n in slices(texts):
                ids = batch.column(names.index("_id")).slice(at, n).to_pylist()
                marks = batch.column(names.index("_row")).slice(at, n).to_pylist()
                made = []
                for i, row, value in zip(ids, marks, texts.slice(at, n).to_pylist()):
                    value = value or ""
                    data = value.encode().translate(None, WHITE)
                    trie.insert(data, (-len(value), i is None, i or 0, row), 1)
                    made.append((*_keys_of(data), len(value), i, row, None, None))
                own = batch.column(0).slice(at, n)
                yield pa.RecordBatch.from_arrays([own, *_key_arrays(made)], schema=arrow)
                while trie.held > trie_bytes and trie.root.children:
                    yield from sent(_partial(*x) for x in trie.spill())
        yield from sent(_partial(*x) for x in trie.terminals())

    return source.mapInArrow(run, schema)


def owners(partials: DataFrame) -> DataFrame:
    """One row per text that more than one row has: its length, digest, owner and number of rows."""
    schema = T.StructType(
        [
            T.StructField("_length", T.LongType()),
            T.StructField("_sha", T.BinaryType()),
            T.StructField("_keep", T.LongType()),
            T.StructField("_keep_row", T.LongType()),
            T.StructField("_size", T.LongType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, at = Trie(), None

        def finished() -> list[tuple]:
            return [
                (len(key), hashlib.sha256(key).digest(), None if best[1] else best[2], best[3], n)
                for key, best, n in trie.terminals()
                if n > 1
            ]

        for batch in batches:
            done = []
            # one row at a time: a batch of long texts is not copied as a whole
            for k in range(batch.num_rows):
                length, content, chars, i, row, count, data = (c[k].as_py() for c in batch.columns)
                if (length, content) != at:
                    done += finished()
                    trie, at = Trie(), (length, content)
                trie.insert(data, (-chars, i is None, i or 0, row), count)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*done), arrow.types)], schema=arrow)
        if done := finished():
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*done), arrow.types)], schema=arrow)

    dealt = partials.select("_length", "_hash", "_chars", "_id", "_row", "_count", "_bytes").repartition("_length", "_hash")
    return dealt.sortWithinPartitions("_length", "_hash").mapInArrow(run, schema)


def exact_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: Sequence[str] | None = None, trie_bytes: int = TRIE_BYTES
) -> DataFrame:
    """The carried columns (all, if not named) with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``."""
    wanted = [c for c in (docs.columns if carry is None else carry) if c in without(docs, RESULT).columns]
    stored = settle(local_tries(docs, wanted, doc_id, text, trie_bytes))
    shared = owners(stored.where("_bytes IS NOT NULL"))
    rows = stored.where("_bytes IS NULL").select("_carried", "_length", "_sha", "_id", "_row")
    joined = rows.join(shared, ["_length", "_sha"], "left")
    alone = F.col("_size").isNull()
    return joined.select(
        *unpacked(wanted),
        F.when(alone, F.col("_id")).otherwise(F.col("_keep")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("_row") == F.col("_keep_row"))).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


SQL = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
    regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS t
  FROM documents),
r AS (
  SELECT doc_id, sha256(t) AS text_sha256,
    first_value(doc_id) OVER (PARTITION BY t ORDER BY chars DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY t) AS group_size
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r
"""


@query("op5_exact_dedup", SQL)
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the owner of its text."""
    return exact_groups(table(spark, sf_dir, "documents"), carry=["doc_id"])
