"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(b + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j). The pair term is taken in time linear in the
non-zero features, as half the sum over factors of (sum v x)^2 - sum (v x)^2. Words go to hash buckets with square-root
counts, scaled to length 1 per text; statistics of the whole text (and its length, the metadata) go to bins.

The machine is fitted by stochastic gradients on at most ``train_documents`` labelled documents, picked
by hash of the id. Scoring reads every text whole.

Cases: null text is empty text; a text without words is scored by its statistics alone; equal texts get equal
scores; a null id counts as held out from training, with remainder null; labels that are null or not 0/1 and labels of unknown documents
are unused; an id with several labels has the smallest; without labels of both kinds every score is the share of
label 1 in what was found, or 0.5. Input columns named like a result column are replaced.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartsight.llm.registry import query, table
from cartsight.llm.rows import add_columns
from cartsight.sources.tables import settle

UPPER, DIGITS, SYMBOLS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>{}[]=+~^@\\/_"
BINS = {
    "chars": (0, 30, 100, 300, 1000, 3000, 10000, 30000),
    "words": (0, 5, 20, 50, 150, 500, 1500, 5000),
    "word_length": (2, 3.5, 4.5, 5.5, 7, 9, 12),
    "symbols": (0, 0.005, 0.02, 0.05, 0.1, 0.2),
    "capitals": (0, 0.02, 0.05, 0.1, 0.3, 0.6),
    "digits": (0, 0.01, 0.05, 0.2),
    "marks": (0, 0.02, 0.1, 0.3, 0.6),  # ! and ? per word
    "stops": (0, 0.02, 0.05, 0.1, 0.2),  # . and , per word
    "distinct": (0.1, 0.25, 0.4, 0.6, 0.8, 0.95),
    "top": (0.02, 0.05, 0.1, 0.2, 0.4),  # share of the most frequent word
    "lines": (0.005, 0.02, 0.05, 0.1, 0.3),  # per word
    "again": (0, 0.05, 0.2, 0.5),  # share of lines equal to an earlier one
}
STARTS = np.cumsum([0, *(len(b) + 1 for b in BINS.values())])
N_STATS = int(STARTS[-1])
CACHE = 300_000


@dataclass(frozen=True)
class MachineParams:
    buckets: int = 1 << 16
    factors: int = 8
    train_documents: int = 6000
    train_entries: int = 20_000_000  # of all training documents together: 160 MB on the driver
    epochs: int = 6
    batch: int = 128
    step: float = 0.1
    ridge: float = 1e-5
    seed: int = 7


PARAMS = MachineParams()


@dataclass(frozen=True)
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    buckets: int


def remainder(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary") if isinstance(doc_id, str) else doc_id) % n


_BUCKET: dict[bytes, int] = {}


def features(texts: list[str | None], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features per text, indices, values): word buckets first, then one bin of each statistic."""
    sizes, index, value, stats = [], [], [], []
    if len(_BUCKET) > CACHE:
        _BUCKET.clear()
    for text in texts:
        raw = (text or "").encode()
        words = raw.lower().split()
        counts = Counter(words)
        n = len(words)
        for w in counts:
            if w not in _BUCKET:
                _BUCKET[w] = zlib.crc32(w)
        index.append(np.fromiter(map(_BUCKET.__getitem__, counts), np.int64, len(counts)) % buckets)
        tf = np.sqrt(np.fromiter(counts.values(), np.float32, len(counts)))
        value.append(tf / max(1e-9, float(np.sqrt((tf * tf).sum()))) if n else tf)
        lines = raw.split(b"\n")
        solid = sum(map(len, words))

        def share(of: bytes, total: int, raw: bytes = raw) -> float:
            return (len(raw) - len(raw.translate(None, of))) / max(total, 1)

        stats.append(
            (
                len(text or ""),
                n,
                solid / max(n, 1),
                share(SYMBOLS, solid),
                share(UPPER, solid),
                share(DIGITS, solid),
                share(b"!?", n),
                share(b".,", n),
                len(counts) / max(n, 1),
                max(counts.values(), default=0) / max(n, 1),
                len(lines) / max(n, 1),
                1 - len(set(lines)) / len(lines),
            )
        )
        sizes.append(len(counts) + len(BINS))
    if not texts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
    grid = np.array(stats, float)
    codes = np.stack(
        [buckets + s + np.searchsorted(np.array(b), grid[:, k]) for k, (s, b) in enumerate(zip(STARTS, BINS.values()))], axis=1
    )
    ones = np.full(len(BINS), 1 / np.sqrt(len(BINS)), np.float32)
    idx = [x for pair in zip(index, codes) for x in pair]
    val = [x for v in value for x in (v, ones)]
    return np.array(sizes, np.int64), np.concatenate(idx), np.concatenate(val).astype(np.float32)


def _sums(sizes: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Sum of the rows of each text; every text has at least the statistics."""
    return np.add.reduceat(x, np.cumsum(sizes) - sizes, axis=0) if len(sizes) else x[:0]


def raw_scores(m: Machine, sizes: np.ndarray, idx: np.ndarray, val: np.ndarray) -> np.ndarray:
    linear = _sums(sizes, m.weights[idx] * val)
    vx = m.factors[idx] * val[:, None]
    whole, squares = _sums(sizes, vx), _sums(sizes, vx * vx)
    return m.bias + linear + 0.5 * (whole * whole - squares).sum(axis=1)


def fit(sizes: np.ndarray, idx: np.ndarray, val: np.ndarray, y: np.ndarray, p: MachineParams = PARAMS) -> Machine:
    """Logistic loss, minibatches, steps scaled by past gradients of each weight."""
    draw = np.random.default_rng(p.seed)
    n = p.buckets + N_STATS
    w, v = np.zeros(n, np.float32), draw.normal(0, 0.05, (n, p.factors)).astype(np.float32)
    share = float(y.mean()) if len(y) else 0.5
    if len(set(y.tolist())) < 2:
        return Machine(30.0 * (2 * share - 1), w, 0 * v, p.buckets)
    bias = float(np.log(share / (1 - share)))
    past_w, past_v = np.full(n, 1e-6, np.float32), np.full((n, p.factors), 1e-6, np.float32)
    starts = np.cumsum(sizes) - sizes
    for _ in range(p.epochs):
        order = draw.permutation(len(sizes))
        for at in range(0, len(order), p.batch):
            part = order[at : at + p.batch]
            size = sizes[part]
            where = np.concatenate([np.arange(starts[i], starts[i] + sizes[i]) for i in part])
            i, x = idx[where], val[where]
            vx = v[i] * x[:, None]
            whole = _sums(size, vx)
            s = bias + _sums(size, w[i] * x) + 0.5 * (whole * whole - _sums(size, vx * vx)).sum(axis=1)
            slope = (1 / (1 + np.exp(-np.clip(s, -30, 30))) - y[part]) / len(part)
            bias -= p.step * float(slope.sum())
            each = np.repeat(slope, size)
            g = each * x
            gv = (g[:, None] * (np.repeat(whole, size, axis=0) - vx)).astype(np.float32)
            used, place = np.unique(i, return_inverse=True)
            gw = np.bincount(place, g, len(used)) + p.ridge * w[used]
            gf = np.stack([np.bincount(place, gv[:, f], len(used)) for f in range(p.factors)], axis=1) + p.ridge * v[used]
            past_w[used] += gw**2
            past_v[used] += gf**2
            w[used] -= p.step * gw / np.sqrt(past_w[used])
            v[used] -= 0.5 * p.step * gf / np.sqrt(past_v[used])
    return Machine(bias, w, v, p.buckets)


def train(docs: DataFrame, labels: DataFrame, p: MachineParams = PARAMS, held_out: int = 1, folds: int = 3) -> Machine:
    """Fit on labelled documents outside the held-out fold."""
    chosen = (
        labels.where(F.col("quality").isin(0, 1) & (remainder("doc_id", folds) != held_out))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("_good"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(p.train_documents)
    )
    fields = T.StructType([T.StructField("_idx", T.BinaryType()), T.StructField("_val", T.BinaryType())])

    def compute(texts: list) -> list[pa.Array]:
        sizes, idx, val = features(texts, p.buckets)
        cut = np.cumsum(sizes)
        i4, v4 = idx.astype("<i4"), val.astype("<f4")
        pieces = [(i4[b - n : b].tobytes(), v4[b - n : b].tobytes()) for b, n in zip(cut, sizes)]
        return [pa.array([a for a, _ in pieces], pa.binary()), pa.array([b for _, b in pieces], pa.binary())]

    # at most train_documents rows are broadcast and come back (one per id, of rows that repeat it the smallest text), and of
    # them those that have at most train_entries entries together, in the order of their hashes
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "_good").agg(F.min("text").alias("text"))
    made = settle(add_columns(picked, fields, compute).select("doc_id", "_good", "_idx", "_val"))
    sizes = made.select("doc_id", (F.octet_length("_idx") / 4).cast("long").alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    fits = np.cumsum([r["n"] for r in sizes]) <= p.train_entries
    if not fits.all():
        made = made.where(F.col("doc_id").isin([r["doc_id"] for r, ok in zip(sizes, fits) if ok]))
    rows = made.collect()
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["_idx"])))
    idx = [np.frombuffer(r["_idx"], "<i4") for r in rows]
    sizes = np.array([len(i) for i in idx], np.int64)
    y = np.array([r["_good"] for r in rows], np.float32)
    if not rows:
        return fit(sizes, np.zeros(0, np.int64), np.zeros(0, np.float32), y, p)
    val = np.concatenate([np.frombuffer(r["_val"], "<f4") for r in rows])
    return fit(sizes, np.concatenate(idx).astype(np.int64), val, y, p)


def score(docs: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """All columns and ``score``, ``predicted``."""
    # buckets x factors numbers, a fixed size
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    fields = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def compute(texts: list) -> list[pa.Array]:
        s = raw_scores(shared.value, *features(texts, shared.value.buckets)).astype(float)
        chance = 1 / (1 + np.exp(-np.clip(s, -30, 30)))
        return [pa.array(chance, pa.float64()), pa.array((chance >= 0.5).astype(np.int32), pa.int32())]

    return add_columns(docs, fields, compute, text)


@query("op8_factorisation")
def op8_factorisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its score; the fold of remainder 1 takes no part in the fit."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, machine).select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", "predicted"
    )
