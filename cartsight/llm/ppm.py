"""Language-model scores by prediction by partial matching over bytes, beside a word-frequency base.

Tokens of a text are its lower-cased words and one end. A word is spelled as its bytes and a space, the end as
a line feed. The context of a byte are the last ``order`` bytes of the text as spelled, with spaces before its beginning.
The trie of contexts is kept as tables of (context, byte) counts, one level per context length; a level
is got from the next longer one by dropping the oldest byte. From the longest context that was met in training:

* a byte met c times among n there, with q different bytes, has probability (2c - 1) / 2n, an escape q / 2n;
* after an escape the bytes of the longer context are excluded from n, q and the choice in the shorter one;
* a context without other bytes is passed at no cost; below the empty context all bytes left are equal.

``trie_score`` is the trie's code length alone. In ``score`` the code adapts to the document: the trie's probability p of a
token is the prior of an estimate, worth ``prior`` tokens; after t tokens of the text, r of them equal, the next has
(r + prior * p) / (t + prior). Optionally a column of the documents, such as their language, is one more symbol of every
context, which is never dropped.

A gram is a context of full length and its byte, eight bytes in all. Each distinct gram of a block of documents goes out
once, not each byte:

1. Every block (of bounded text) keeps its spelled texts, compressed, and lists its distinct grams and words (by hash) with
   their counts in training, sorted and delta-coded: about a byte for a gram.
2. Grams are dealt by the end of their context, two bytes or, where many grams share them, more, so that a sub-trie is
   whole in one task and none is large; counts of the contexts that are split go along to all (256 for each at most).
   Words are dealt by hash. Tasks add up the counts and answer every block with a log probability or a count per key.
3. Blocks meet their answers and add them up over their texts.

Nothing that grows with the corpus goes to the driver or into a broadcast, but the contexts that are split: one at most per
``heavy`` grams of all blocks. Steps are stored in the shared folder.

Cases: null text is empty, an empty text is its end alone; a null id is not learned from and held out; repeated rows are
scored, and learned from, each; very long texts are taken whole (a block holds at least one); without training
documents every token is new, and its bytes are equally likely; a missing or null context column is a class of its own, and
its values share 48 classes.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cartsight.llm.registry import query, table
from cartsight.llm.rows import slices
from cartsight.llm.words import span_hashes
from cartsight.sources.tables import settle

ORDER = 6
PRIOR = 5000.0
CLASSES = 48
BLOCK_BYTES = 24 << 20  # text of a block
RUN_BYTES = 4 << 20  # text in a row
PART_KEYS = 1 << 20  # keys, of all blocks together, in a part
MOST_PARTS = 20_000  # rows of a block's keys; beyond, parts grow with the corpus, but their distinct keys hardly do
HEAVY = 1 << 22  # grams of all blocks that may share the end of their context
MERGED = 1 << 22  # keys unpacked before equal ones are added up
END = b"\n"
FOLDS, HELD_OUT = 10, 0
TEXTS, GRAMS, WORDS = 2, 0, 1  # kinds of a block's rows; answers come before texts
Counts = tuple[np.ndarray, np.ndarray]  # sorted distinct keys, and a number for each


def held_out(doc_id: int | None) -> bool:
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT


# --- numbers in few bytes -------------------------------------------------------------------------


def pack(values: np.ndarray) -> bytes:
    """Numbers, with bytes of one place standing together."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, kind: type = np.int64) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys by their differences."""
    return pack(np.diff(keys, prepend=np.int64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data))


def _firsts(keys: np.ndarray) -> np.ndarray:
    """The first place of each value of sorted keys."""
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    return np.flatnonzero(new)


def counted(keys: np.ndarray) -> Counts:
    keys = np.sort(keys)
    first = _firsts(keys)
    return keys[first], np.diff(first, append=len(keys))


def merged(parts: Sequence[Counts]) -> Counts:
    """Distinct keys of all parts with their sums."""
    keys = np.concatenate([np.zeros(0, np.int64), *(k for k, _ in parts)])
    counts = np.concatenate([np.zeros(0, np.int64), *(c for _, c in parts)])
    order = np.argsort(keys, kind="stable")  # merges runs that are sorted already
    keys = keys[order]
    first = _firsts(keys)
    return keys[first], np.add.reduceat(counts[order], first) if len(keys) else counts


class Places:
    """Places of keys, by hashing: searching many keys in no order in a long sorted list is slower."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.table = np.full(1 << self.bits, -1, np.int32)
        slot, todo = self._slots(keys), np.arange(len(keys), dtype=np.int32)
        while len(todo):
            at = slot[todo]
            free = self.table[at] < 0
            self.table[at[free]] = todo[free]  # of several for one slot the last stays
            todo = todo[self.table[at] != todo]
            slot[todo] = (slot[todo] + 1) & (len(self.table) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Places of keys that are all there."""
        slot = self._slots(wanted)
        out = self.table[slot]
        wrong = np.flatnonzero(self.keys[out] != wanted)
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & (len(self.table) - 1)
            out[wrong] = self.table[slot[wrong]]
            wrong = wrong[self.keys[out[wrong]] != wanted[wrong]]
        return out


# --- texts as grams and tokens --------------------------------------------------------------------


def spelled(text: str | None) -> bytes:
    words = (text or "").encode().lower().split()
    return b" ".join([*words, END])


def token_starts(raw: bytes, begins: np.ndarray) -> np.ndarray:
    """Where the words and ends begin in spelled texts that follow each other."""
    first = np.zeros(len(raw), bool)
    first[1:] = np.frombuffer(raw, np.uint8)[:-1] == ord(" ")
    first[begins] = True
    return np.flatnonzero(first)


def token_hashes(raw: bytes, starts: np.ndarray) -> np.ndarray:
    """A hash of each token, not negative, so that keys sort alike everywhere."""
    hashes = span_hashes(np.frombuffer(raw, np.uint8), starts, np.append(starts[1:], len(raw)))
    return (hashes >> np.uint64(1)).astype(np.int64)


_KIND_BITS = 0x7F << 56  # of the class in a gram


def level_mask(k: int) -> int:
    """Bits of the class, ``k`` bytes of context and the byte."""
    return _KIND_BITS | ((1 << 8 * (k + 1)) - 1)


def text_grams(texts: list[bytes], kinds: Sequence[int], order: int) -> np.ndarray:
    """One gram per byte: the class, ``order`` bytes of context, and the byte."""
    pad = b" " * order
    data = np.frombuffer(b"".join(x for t in texts for x in (pad, t)), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    out = np.empty(int(sizes.sum()), np.int64)
    shift = np.repeat(order * (1 + np.arange(len(texts))), sizes)  # of a byte's place in data
    for a in range(0, len(out), 1 << 18):
        at = np.arange(a, min(len(out), a + (1 << 18)))
        at += shift[a : a + len(at)]
        gram = np.zeros(len(at), np.int64)
        for k in range(order, -1, -1):
            gram <<= 8
            gram |= data[at - k]
        out[a : a + len(at)] = gram
    if any(kinds):
        out |= np.repeat(np.asarray(kinds, np.int64) << 56, sizes)
    return out


# --- 1. blocks ------------------------------------------------------------------------------------

BLOCKS = T.StructType(
    [
        T.StructField("block", T.LongType()),
        T.StructField("kind", T.IntegerType()),
        T.StructField("keys", T.BinaryType()),  # or texts
        T.StructField("counts", T.BinaryType()),
        T.StructField("n", T.LongType()),
    ]
)


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def pack_texts(docs: list[int | None], kinds: list[int], texts: list[bytes]) -> bytes:
    """Ids, which of them are null, classes, lengths and bytes of some texts."""
    head = np.array([[i or 0 for i in docs], [i is None for i in docs], kinds, [len(t) for t in texts]], "<i8")
    size = np.array([len(docs)], "<i8")
    return zstandard.ZstdCompressor(level=1).compress(b"".join((size.tobytes(), head.tobytes(), *texts)))


def unpack_texts(packed: bytes) -> tuple[list[int | None], list[int], list[bytes]]:
    """(ids, classes, texts)"""
    raw = zstandard.ZstdDecompressor().decompress(packed)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    ids, none, kinds, sizes = np.frombuffer(raw, "<i8", 4 * n, 8).reshape(4, n)
    stops = (8 + 32 * n + np.cumsum(sizes)).tolist()
    texts = [raw[b - s : b] for b, s in zip(stops, sizes.tolist())]
    return [None if x else i for i, x in zip(ids.tolist(), none)], kinds.tolist(), texts


class Block:
    """The texts of some documents not sent on yet, and the grams and words of all of them."""

    def __init__(self, number: int, order: int) -> None:
        self.number, self.order = number, order
        self.bytes = self.held = 0
        self.docs: list[tuple[int | None, int, bytes]] = []
        self.lists: dict[int, list[Counts]] = {GRAMS: [], WORDS: []}

    def add(self, doc_id: int | None, kind: int, text: str | None) -> None:
        data = spelled(text)
        self.docs.append((doc_id, kind, data))
        self.held += len(data)
        self.bytes += len(data)

    def take_texts(self) -> tuple:
        """A row of the texts, whose grams and words are listed."""
        for learned in (True, False):
            own = [(k, t) for i, k, t in self.docs if held_out(i) != learned]
            texts = [t for _, t in own]
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            raw = b"".join(texts)
            words = token_hashes(raw, token_starts(raw, np.cumsum(sizes) - sizes))
            for what, keys in ((GRAMS, text_grams(texts, [k for k, _ in own], self.order)), (WORDS, words)):
                values, n = counted(keys)
                self.lists[what].append((values, n if learned else np.zeros_like(n)))
        ids, kinds, texts = (list(x) for x in zip(*self.docs))
        self.docs, self.held = [], 0
        return self.number, TEXTS, pack_texts(ids, kinds, texts), None, len(texts)

    def take_lists(self) -> Iterator[tuple]:
        for what, parts in self.lists.items():
            keys, counts = merged(parts)
            yield self.number, what, pack_keys(keys), pack(counts), len(keys)


def blocks(
    docs: DataFrame, order: int, doc_id: str = "doc_id", text: str = "text", context: str | None = None, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Rows of texts, of grams and of words of every block."""
    kind = F.lit(0)
    if context in docs.columns:
        kind = F.coalesce(F.crc32(F.col(f"`{context}`").cast("string").cast("binary")) % CLASSES + 1, F.lit(0))
    source = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("id"), kind.cast("int").alias("kind"), F.col(f"`{text}`").alias("text")
    )
    arrow = to_arrow_schema(BLOCKS)
    run_bytes = min(RUN_BYTES, block_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        block = Block(number, order)
        for batch in batches:
            for at, n in slices(batch.column(2)):
                for row in zip(*(c.slice(at, n).to_pylist() for c in batch.columns)):
                    block.add(*row)
                    if block.held >= run_bytes:
                        yield _batch(arrow, [block.take_texts()])
                    if block.bytes >= block_bytes:
                        yield _batch(arrow, [*([block.take_texts()] if block.docs else []), *block.take_lists()])
                        number += 1
                        block = Block(number, order)
        if block.bytes:
            yield _batch(arrow, [*([block.take_texts()] if block.docs else []), *block.take_lists()])

    return source.mapInArrow(run, BLOCKS)


# --- 2. sub-tries ---------------------------------------------------------------------------------


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, whether it is there) in sorted keys."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _ends(grams: np.ndarray, length: int) -> np.ndarray:
    """The class and the last ``length`` bytes of each gram's context."""
    return (grams & level_mask(length)) >> 8


class Split:
    """Ends of contexts that too many grams share, by length, and the counts of the contexts that are split: all of length 0
    and 1, and these."""

    def __init__(self) -> None:
        self.heavy: dict[int, np.ndarray] = {}
        self.low: dict[int, Counts] = {}

    def parts(self, grams: np.ndarray, many: int) -> np.ndarray:
        """The part of each gram: by the shortest end of two bytes or more that is not heavy."""
        end, length = _ends(grams, 2), np.full(len(grams), 2)
        for k, heavy in sorted(self.heavy.items()):
            longer = np.flatnonzero((length == k) & _find(heavy, end)[1])
            end[longer], length[longer] = _ends(grams[longer], k + 1), k + 1
        mixed = (end.view(np.uint64) * np.uint64(8) + length.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed >> np.uint64(32)) % np.uint64(many)).astype(np.int64)


def split_ends(grams: DataFrame, order: int, heavy: int = HEAVY) -> Split:
    """Lengthens the ends that are dealt by until none is shared by too many grams, or they are whole contexts."""
    out = Split()
    for length in range(2, order + 1):
        above = out.heavy.get(length - 1)

        def run(batches: Iterator[pa.RecordBatch], length: int = length, above: np.ndarray | None = above) -> Iterator[pa.RecordBatch]:
            low: list[Counts] = []
            ends: list[Counts] = []
            for batch in batches:
                for keys, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    grams, n = unpack_keys(keys), unpack(counts)
                    if above is not None:
                        here = _find(above, _ends(grams, length - 1))[1]
                        grams, n = grams[here], n[here]
                    if length < order:
                        ends = [merged([*ends, counted(_ends(grams, length))])]
                    met = n > 0
                    low = [merged([*low, (grams[met] & level_mask(length - 1), n[met])])]
            for what, parts in (("low", low), ("end", ends)):
                for keys, sums in parts:
                    made = [pa.array([what] * len(keys), pa.string()), pa.array(keys, pa.int64()), pa.array(sums, pa.int64())]
                    yield pa.RecordBatch.from_arrays(made, names=["what", "key", "n"])

        sums = grams.select("keys", "counts").mapInArrow(run, "what string, key long, n long").groupBy("what", "key").agg(F.sum("n").alias("n"))
        # counts after split contexts, and the ends that are heavy
        found = sums.where((F.col("what") == "low") | (F.col("n") > heavy)).toArrow().to_pandas().sort_values("key")
        lows, ends = found[found.what == "low"], found[found.what == "end"]
        out.low[length - 1] = lows.key.to_numpy(np.int64), lows.n.to_numpy(np.int64)
        if not len(ends):
            break
        out.heavy[length] = ends.key.to_numpy(np.int64)
    return out


def gram_scores(wanted: np.ndarray, grams: np.ndarray, n: np.ndarray, low: dict[int, Counts], order: int) -> np.ndarray:
    """log10 probability of the last byte of each wanted gram.

    ``grams`` and ``n`` are the training grams of whole sub-tries; ``low`` has the counts of the contexts above them, those of
    length 1 (and with them 0) all.
    """
    levels: dict[int, Counts] = {}
    for k in range(order, 1, -1):
        levels[k] = merged([(grams & level_mask(k), n)])
        if k in low:
            keys, counts = levels[k]
            own = ~_find(np.unique(low[k][0] >> 8), keys >> 8)[1]
            levels[k] = merged([(keys[own], counts[own]), low[k]])
    levels[1] = low[1]
    levels[0] = merged([(low[1][0] & level_mask(0), low[1][1])])
    score = np.zeros(len(wanted))
    todo = np.ones(len(wanted), bool)
    taken = np.zeros(len(wanted))  # of this level's count, by bytes of the longer context
    used = np.zeros(len(wanted))  # number of those bytes
    for k in range(order, -1, -1):
        keys, counts = levels[k]
        heads, place = np.unique(keys >> 8, return_inverse=True)
        total, kinds = np.bincount(place, counts, len(heads)), np.bincount(place, minlength=len(heads))
        mine = wanted & level_mask(k)
        head, known = _find(heads, mine >> 8)
        node, there = _find(keys, mine)
        act = todo & known
        if act.any():
            m = total[head[act]] - taken[act]
            q = kinds[head[act]] - used[act]
            hit, open_ = there[act], q > 0
            with np.errstate(divide="ignore", invalid="ignore"):
                found = np.log10((2 * counts[node[act]] - 1) / (2 * m))
                missed = np.where(open_, np.log10(q / (2 * m)), 0.0)
            score[act] += np.where(hit, found, missed)
            todo[act] = ~hit
        if k:
            # what the bytes of each context of this level count in the next shorter one
            below, counts_below = levels[k - 1]
            node, there = _find(below, keys & level_mask(k - 1))
            share = np.bincount(place, np.where(there, counts_below[node] if len(below) else 0, 0), len(heads))
            if len(heads):
                taken = np.where(known, share[head], 0)
                used = np.where(known, kinds[head], 0)
            else:
                taken, used = np.zeros(len(wanted)), np.zeros(len(wanted))
        else:
            left = 256 - (np.where(known, kinds[head], 0) if len(heads) else np.zeros(len(wanted)))
            score[todo] -= np.log10(np.maximum(left[todo], 1))
    return score


def dealt(stored: DataFrame, what: int, many: int, split: Split) -> DataFrame:
    """The grams or words of every block by part."""
    schema = T.StructType([T.StructField("part", T.LongType()), *BLOCKS.fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, kind, keys, counts, _ in zip(*(c.to_pylist() for c in batch.columns)):
                keys, counts = unpack_keys(keys), unpack(counts)
                part = split.parts(keys, many) if kind == GRAMS else keys % many
                order = np.argsort(part, kind="stable")
                keys, counts, part = keys[order], counts[order], part[order]
                cuts = [*np.flatnonzero(np.diff(part, prepend=-1)).tolist(), len(part)]
                rows = [(int(part[a]), block, kind, pack_keys(keys[a:b]), pack(counts[a:b]), b - a) for a, b in zip(cuts, cuts[1:])]
                for at in range(0, len(rows), 64):
                    yield _batch(arrow, rows[at : at + 64])

    return stored.where(F.col("kind") == what).select(*(f.name for f in BLOCKS)).mapInArrow(run, schema)


ANSWERS = T.StructType([*BLOCKS.fields, T.StructField("total", T.LongType()), T.StructField("distinct", T.LongType())])


def answers(parts: DataFrame, split: Split, order: int) -> DataFrame:
    """For every block's keys of a part, in ``counts``, the log probabilities of grams (24 bits) or the training counts of words.

    A row without a block has the sum and number of the part's words that were met in training.
    """
    arrow = to_arrow_schema(ANSWERS)

    def answered(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        kind = rows[0][2]
        held: list[Counts] = []
        for _, _, _, keys, counts, _ in rows:
            held.append((unpack_keys(keys), unpack(counts)))
            if sum(len(k) for k, _ in held) >= MERGED and len(held) > 1:
                held = [merged(held)]
        every, n = merged(held)
        del held
        if kind == GRAMS:
            met = n > 0
            value = gram_scores(every, every[met], n[met], split.low, order).astype(np.float32)
        else:
            value = n
            yield _batch(arrow, [(None, kind, None, None, 0, int(n.sum()), int((n > 0).sum()))])
        for _, block, _, keys, _, size in rows:
            yield _batch(arrow, [(block, kind, keys, pack(value[np.searchsorted(every, unpack_keys(keys))]), size, None, None)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # packed rows of one part
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][0] != row[0]:
                    yield from answered(held)
                    held = []
                held.append(row)
        if held:
            yield from answered(held)

    return parts.repartition("part").sortWithinPartitions("part", "block").mapInArrow(run, ANSWERS)


# --- 3. documents ---------------------------------------------------------------------------------


def earlier(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of texts that follow each other: equal tokens before it in its text; tokens before it."""
    n = len(ids)
    text = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((ids, text))  # stable: equal tokens of a text stay in order
    i, t = ids[order], text[order]
    new = np.ones(n, bool)
    new[1:] = (i[1:] != i[:-1]) | (t[1:] != t[:-1])
    rank = np.arange(n) - np.maximum.accumulate(np.where(new, np.arange(n), 0))
    equal = np.empty(n)
    equal[order] = rank
    return equal, (np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(float)


RESULT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("held_out", T.BooleanType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()),
        T.StructField("train_tokens", T.LongType()),
        T.StructField("base_score", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("trie_score", T.DoubleType()),
    ]
)


def scored_texts(
    texts: list[bytes], kinds: list[int], order: int, prior: float, lp_of: Callable, count_of: Callable, below: float
) -> list[np.ndarray]:
    """Tokens, known tokens, base score, score and trie score of some texts."""
    raw = b"".join(texts)
    lp = lp_of(text_grams(texts, kinds, order)).astype(np.float64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.cumsum(sizes) - sizes
    starts = token_starts(raw, begins)
    word = token_hashes(raw, starts)
    count = count_of(word)
    cut = np.searchsorted(starts, begins)
    many = np.diff(cut, append=len(starts))
    p = np.add.reduceat(lp, starts)
    equal, before = earlier(word, many)
    # a token too unlikely for a double keeps its exact logarithm where it is new
    with np.errstate(divide="ignore"):
        ahead = np.where(equal > 0, np.log10(equal + prior * 10.0**p), p + np.log10(prior))
    return [
        many,
        np.add.reduceat((count > 0).astype(np.int64), cut),
        np.add.reduceat(np.log10(count + 0.1) - below, cut),
        np.add.reduceat(ahead - np.log10(before + prior), cut),
        np.add.reduceat(p, cut),
    ]


def document_scores(stored: DataFrame, told: DataFrame, order: int, prior: float, total: int, distinct: int) -> DataFrame:
    """Sums over the texts of every block from the answers to its keys."""
    arrow = to_arrow_schema(RESULT)
    names = [f.name for f in BLOCKS]
    both = told.select(*names).unionByName(stored.where(F.col("kind") == TEXTS).select(*names))
    below = np.log10(total + 0.1 * (distinct + 1))

    def looked_up(parts: list[tuple[bytes, bytes]], kind: type) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([np.zeros(0, np.int64), *(unpack_keys(k) for k, _ in parts)])
        values = np.concatenate([np.zeros(0, kind), *(unpack(v, kind) for _, v in parts)])
        by_key = np.argsort(keys, kind="stable")
        return keys[by_key], values[by_key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        held: dict[int, list] = {}
        lp_of = count_of = None
        for batch in batches:
            for block, kind, data, counts, _ in zip(*(c.to_pylist() for c in batch.columns)):
                if block != now:
                    now, held, lp_of = block, {GRAMS: [], WORDS: []}, None
                if kind != TEXTS:
                    held[kind].append((data, counts))
                    continue
                if lp_of is None:
                    grams, lp = looked_up(held[GRAMS], np.float32)
                    words, count = looked_up(held[WORDS], np.int64)
                    gram_places, word_places, held = Places(grams), Places(words), {}
                    lp_of = lambda x, lp=lp, at=gram_places: lp[at.find(x)]
                    count_of = lambda x, n=count, at=word_places: n[at.find(x)]
                ids, kinds, texts = unpack_texts(data)
                made = scored_texts(texts, kinds, order, prior, lp_of, count_of, below)
                fixed = [ids, [held_out(i) for i in ids], made[0], made[1], np.full(len(ids), total)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip([*fixed, *made[2:]], arrow)], schema=arrow)

    return both.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(run, RESULT)


def score_documents(
    docs: DataFrame,
    order: int = ORDER,
    prior: float = PRIOR,
    block_bytes: int = BLOCK_BYTES,
    doc_id: str = "doc_id",
    text: str = "text",
    context: str | None = None,
    heavy: int = HEAVY,
    part_keys: int = PART_KEYS,
) -> DataFrame:
    """doc_id, held_out, token counts, base score, model score and the trie's own score of every document."""
    if not 2 <= order <= 6:
        raise ValueError("a gram has room for 2 to 6 bytes of context")
    stored = settle(blocks(docs, order, doc_id, text, context, block_bytes))
    sizes = {r["kind"]: r["n"] for r in stored.where(F.col("kind") != TEXTS).groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    many = {k: min(MOST_PARTS, max(1, -(-sizes.get(k, 0) // part_keys))) for k in (GRAMS, WORDS)}
    split = split_ends(stored.where(F.col("kind") == GRAMS), order, heavy)
    words = settle(answers(dealt(stored, WORDS, many[WORDS], split), split, order))
    sums = words.where("block IS NULL").agg(F.sum("total").alias("total"), F.sum("distinct").alias("distinct")).first()
    grams = answers(dealt(stored, GRAMS, many[GRAMS], split), split, order)
    told = words.where("block IS NOT NULL").unionByName(grams)
    return document_scores(stored, told, order, prior, sums["total"] or 0, sums["distinct"] or 0)


@query("op4_ppm")
def op4_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a model that has learned from nine tenths of them."""
    return score_documents(table(spark, sf_dir, "documents"))
