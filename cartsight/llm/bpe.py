"""Byte-level BPE with a pair occurrence index.

The distinct pre-tokens of a chunk of texts that were not met before are laid out as one array of
byte symbols. An index maps every pair with a merge rank to the list of its positions. Active ranks
are taken in ascending order (a merge only makes pairs of higher rank); all positions of the rank are
merged at once, and the lists of the pairs to the left and right are extended. Stale positions are
recognised when their list is taken up.

Cases: null text is empty text; empty text has no ids; the special string is one token and splits
the text, as in the tokenizers library; any length of text and of pre-token is encoded whole; rows
that repeat are encoded like any others. Input columns named like a result column are replaced.
"""

from __future__ import annotations

import heapq
import json
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartsight.llm.registry import query, table
from cartsight.llm.rows import add_columns

VOCABULARY = "byte_bpe_50k.json"  # of the public tokenizers
# The published split pattern of this vocabulary (fixed value); \s spelled out as Unicode White_Space.
_WS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"
)
CACHE_ENTRIES = 200_000
CACHED_BYTES = 64  # longer pre-tokens are encoded each time


def byte_letters() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Bpe:
    """Vocabulary in the form that encoding uses, and the cache of one Python worker."""

    byte_ids: np.ndarray  # id of each byte
    keys: np.ndarray  # sorted pair keys (left << 32 | right)
    ranks: np.ndarray  # their ranks
    made: np.ndarray  # rank -> id of the merged symbol
    left: np.ndarray
    right: np.ndarray
    pieces: list[bytes]  # id -> bytes
    specials: dict[str, int]
    cache: dict[str, bytes] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.split = regex.compile(PATTERN).findall
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or -1."""
        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], -1)


def read_vocabulary(raw: str) -> Bpe:
    """From the text of a tokenizers JSON file of a byte-level BPE model."""
    spec = json.loads(raw)
    vocab, letters = spec["model"]["vocab"], byte_letters()
    size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
    pieces = [b""] * size
    for word, i in vocab.items():
        pieces[i] = bytes(letters[c] for c in word) if all(c in letters for c in word) else word.encode()
    specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
    for word, i in specials.items():
        pieces[i] = word.encode()
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    left = np.array([vocab[a] for a, _ in merges], np.int64)
    right = np.array([vocab[b] for _, b in merges], np.int64)
    made = np.array([vocab[a + b] for a, b in merges], np.int64)
    keys = (left << 32) | right
    order = np.argsort(keys, kind="stable")
    names = {b: c for c, b in letters.items()}
    byte_ids = np.array([vocab[names[b]] for b in range(256)], np.int64)
    return Bpe(byte_ids, keys[order], order.astype(np.int64), made, left, right, pieces, specials)


def _leftmost(pos: np.ndarray, follower: np.ndarray) -> np.ndarray:
    """Of overlapping occurrences of a pair of equal symbols, every second of a run stays."""
    chained = np.zeros(len(pos), bool)
    chained[1:] = follower[:-1] == pos[1:]
    first = np.flatnonzero(~chained)
    run = np.repeat(first, np.diff(np.append(first, len(pos))))
    return pos[(np.arange(len(pos)) - run) % 2 == 0]


def encode_words(words: list[bytes], bpe: Bpe) -> list[bytes]:
    """The ids of every word as little-endian unsigned 32-bit integers."""
    if not words:
        return []
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    raw = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
    ends = np.cumsum(lengths + 1) - 1
    sym = bpe.byte_ids[raw]
    sym[ends] = -1  # between words; also closes the last one
    n = len(sym)
    after = np.arange(1, n + 1)
    before = np.arange(-1, n - 1)
    before[0] = n - 1
    after[n - 1] = n - 1
    lists: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def index(pos: np.ndarray, rank: np.ndarray) -> None:
        have = rank >= 0
        pos, rank = pos[have], rank[have]
        if not len(pos):
            return
        order = np.argsort(rank, kind="stable")
        pos, rank = pos[order], rank[order]
        cuts = np.flatnonzero(np.diff(rank)) + 1
        for r, part in zip(rank[np.concatenate(([0], cuts))].tolist(), np.split(pos, cuts)):
            if r in lists:
                lists[r].append(part)
            else:
                lists[r] = [part]
                heapq.heappush(active, r)

    index(np.arange(n - 1), bpe.rank_of(sym[:-1], sym[1:]))
    while active:
        r = heapq.heappop(active)
        parts = lists.pop(r)
        pos = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
        a, b, new = bpe.left[r], bpe.right[r], bpe.made[r]
        pos = pos[(sym[pos] == a) & (sym[after[pos]] == b)]
        if not len(pos):
            continue
        if a == b:
            pos = _leftmost(pos, after[pos])
        gone = after[pos]
        follow = after[gone]
        sym[pos] = new
        sym[gone] = -2
        after[pos] = follow
        before[follow] = pos
        lead = before[pos]
        index(
            np.concatenate((lead, pos)),
            np.concatenate((bpe.rank_of(sym[lead], sym[pos]), bpe.rank_of(sym[pos], sym[follow]))),
        )
    left = np.flatnonzero(sym >= 0)
    out = sym[left].astype("<u4").tobytes()
    stops = (4 * np.searchsorted(left, ends)).tolist()
    starts = [0, *stops[:-1]]
    return [out[i:j] for i, j in zip(starts, stops)]


def encode_texts(texts: list[str | None], bpe: Bpe) -> list[bytes]:
    """Ids of whole texts as bytes; new pre-tokens of all the texts are merged together."""
    split_up: list[list] = []
    new: dict[str, bytes] = {}
    cache = bpe.cache
    for text in texts:
        tokens: list = []
        for i, part in enumerate(bpe.special.split(text or "") if bpe.special else [text or ""]):
            if i % 2:
                tokens.append(part)
            elif part:
                tokens += bpe.split(part)
        split_up.append(tokens)
        new.update(dict.fromkeys(set(tokens).difference(cache)))
    for special, i in bpe.specials.items():
        new[special] = i.to_bytes(4, "little")
    fresh = [w for w in new if w not in bpe.specials]
    new.update(zip(fresh, encode_words([w.encode() for w in fresh], bpe)))
    known = {**cache, **new} if len(cache) < len(new) else None
    if known is None:
        cache.update(new)
        known = cache
    out = [b"".join(map(known.__getitem__, tokens)) for tokens in split_up]
    if known is not cache:
        cache.update((w, new[w]) for w in fresh if len(w) <= CACHED_BYTES)
    else:
        for w in fresh:
            if len(w) > CACHED_BYTES:
                del cache[w]
    if len(cache) > CACHE_ENTRIES:
        cache.clear()
    return out


_WORKER: dict[int, Bpe] = {}  # one vocabulary per Python worker and broadcast


def _model(shared) -> Bpe:
    if id(shared.value) not in _WORKER:
        _WORKER.clear()
        _WORKER[id(shared.value)] = read_vocabulary(shared.value)
    return _WORKER[id(shared.value)]


def vocabulary_path() -> str:
    """Where the vocabulary lies on the driver; executors do not need the package."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def load(spark: SparkSession, path: str | None = None):
    """The vocabulary file (bounded by its 50,257 entries), read once and sent to the executors."""
    with open(path or vocabulary_path(), encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, vocabulary=None, text: str = "text") -> DataFrame:
    """All columns and ``ids`` (little-endian unsigned 32-bit integers) and ``n_tokens``."""
    shared = vocabulary or load(docs.sparkSession)
    fields = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())])

    def compute(texts: list) -> list[pa.Array]:
        ids = encode_texts(texts, _model(shared))
        return [pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())]

    return add_columns(docs, fields, compute, text)


def decode_ids(ids: list[bytes | None], bpe: Bpe) -> list[str]:
    """Texts of the ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
    piece = bpe.pieces.__getitem__
    return [
        b"".join(map(piece, np.frombuffer(x or b"", "<u4").tolist())).decode("utf-8", errors="replace") for x in ids
    ]


def decode(encoded: DataFrame, vocabulary=None, ids: str = "ids") -> DataFrame:
    """All columns and ``decoded``, the text of ``ids``; null ids give the empty text."""
    shared = vocabulary or load(encoded.sparkSession)
    fields = T.StructType([T.StructField("decoded", T.StringType())])
    return add_columns(encoded, fields, lambda x: [pa.array(decode_ids(x, _model(shared)), pa.string())], ids)


def round_trip(docs: DataFrame, vocabulary=None, text: str = "text") -> DataFrame:
    """``encode`` and ``decode`` in one pass, so that a task needs one Python worker: ids, n_tokens, decoded."""
    shared = vocabulary or load(docs.sparkSession)
    fields = T.StructType(
        [
            T.StructField("ids", T.BinaryType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("decoded", T.StringType()),
        ]
    )

    def compute(texts: list) -> list[pa.Array]:
        ids = encode_texts(texts, _model(shared))
        made = decode_ids(ids, _model(shared))
        return [
            pa.array(ids, pa.binary()),
            pa.array([len(x) // 4 for x in ids], pa.int64()),
            pa.array(made, pa.string()),
        ]

    return add_columns(docs, fields, compute, text)


def digests(docs: DataFrame, *others: str | Column) -> DataFrame:
    """Per document the number of tokens and the digests of its ids and of the text decoded from them."""
    return round_trip(docs.select("doc_id", "text")).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        *others,
    )


@query("op9_bpe")
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, decoded, and both results as digests."""
    return digests(table(spark, sf_dir, "documents"))
