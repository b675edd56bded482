"""Quality rules by labelling lines: a linear-chain conditional random field marks content and boilerplate.

Every line of a text gets a few binned observations (symbols, capitals, bars, repeated windows, ...).
The field is trained by maximum likelihood (forward and backward sums over whole documents) on a
bounded number of labelled documents; the best labelling of every document comes from Viterbi
decoding, all documents of a batch in step. The share of words in content lines decides.

Training labels are those of documents: lines of good documents are content; lines of poor ones are
boilerplate, but for lines that a first fit without transitions finds to look like content.

Cases: null text has no words; a text without words has content share 0; equal rows get equal
results; labels that are null or belong to no document are unused; without labels of both kinds every
line is content, so that the plain rules alone decide. Very long texts are read whole, the decoding is
linear in their lines. Input columns named like a result column are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartsight.llm.registry import query, table
from cartsight.llm.rows import add_columns

SYMBOLS = b"#*$%&|<>"
WORD_MARKS = b" \t\n\r\x0b\x0c"  # what separates words


@dataclass(frozen=True)
class RuleParams:
    min_words: int = 50
    max_repeat_percent: int = 50
    min_content_share: float = 0.5
    train_documents: int = 3000  # bound of the labelled sample, by hash of the id
    train_lines: int = 400  # documents with more lines are not used for training
    rounds: int = 120
    step: float = 0.3
    ridge: float = 1e-3


RULES = RuleParams()

# Upper ends of the bins of each observation.
BINS = {
    "symbols": (0.0, 0.02, 0.05, 0.1, 0.2),  # per byte outside white space
    "capitals": (0.0, 0.1, 0.3, 0.6, 0.9),  # of letters
    "bangs": (0.0, 0.1, 0.5),  # per word
    "bars": (0.0, 0.1, 0.3),  # per word
    "digits": (0.0, 0.05, 0.2),
    "words": (0.0, 2.0, 5.0, 15.0, 40.0),
    "repeats": (0.0, 0.2, 0.5, 0.9),  # words in windows found twice
    "echoes": (0.0, 0.1, 0.5),  # words equal to the one before
    "length": (2.0, 4.0, 7.0, 10.0),  # bytes per word
    "closed": (0.0,),  # ends in a full stop or the like
    "again": (0.0,),  # equal to an earlier line
}
OFFSETS = np.cumsum([0, *(len(b) + 1 for b in BINS.values())])
N_WEIGHTS = int(OFFSETS[-1])


def _classes() -> np.ndarray:
    """Per byte a bit set: symbol, capital, letter, bang, bar, digit, no white space."""
    t = np.zeros(256, np.uint8)
    t[list(SYMBOLS)] |= 1
    for b in range(256):
        c = chr(b) if b < 128 else ""
        t[b] |= 2 * c.isupper() | 4 * (c.isalpha() or b >= 128) | 32 * c.isdigit() | 64 * (b not in WORD_MARKS)
    t[ord("!")] |= 8
    t[ord("|")] |= 16
    return t


_CLASS = _classes()


def repeated_words(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each word: whether it lies in a 3-word window found twice or more; whether it equals the one before."""
    n = len(words)
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    echo = np.zeros(n, bool)
    echo[1:] = ids[1:] == ids[:-1]
    flag = np.zeros(n, bool)
    if n < 4 or len(seen) == n:
        return flag, echo
    pair = ids[:-1] * len(seen) + ids[1:]
    if len(seen) >= 1 << 21:  # keep the next product below 2^63
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * len(seen) + ids[2:]
    order = np.argsort(window, kind="stable")
    ranked = window[order]
    same = ranked[1:] == ranked[:-1]
    hit = np.zeros(n - 2, bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    flag[:-2] = hit
    flag[1:-1] |= hit
    flag[2:] |= hit
    return flag, echo


@dataclass
class Lines:
    """Observations of the lines of some documents, in order, and the documents' plain counts."""

    n_lines: np.ndarray
    codes: np.ndarray  # lines x observations, indices into the weights
    words: np.ndarray  # words per line
    base: dict[str, np.ndarray]


def observe(texts: list[str | None]) -> Lines:
    raws = [(t or "").encode() for t in texts]
    flags, echoes, again = [], [], []
    base = {k: np.zeros(len(raws), np.int64) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    n_lines = np.zeros(len(raws), np.int64)
    for i, raw in enumerate(raws):
        words = raw.split()
        flag, echo = repeated_words(words)
        flags.append(flag)
        echoes.append(echo)
        lines = raw.split(b"\n")
        seen: set[bytes] = set()
        dup = [False] * len(lines)
        for k, line in enumerate(lines):
            if line in seen:
                dup[k] = bool(line.strip())
            else:
                seen.add(line)
        again += dup
        n_lines[i] = len(lines)
        base["n_words"][i] = len(words)
        text = texts[i] or ""
        base["word_chars"][i] = len(text) - sum(text.count(chr(c)) for c in WORD_MARKS)
        base["n_symbols"][i] = len(raw) - len(raw.translate(None, SYMBOLS))
        base["n_dup_lines"][i] = sum(dup)
        base["n_repeat_words"][i] = flag.sum()
    if not raws:
        return Lines(n_lines, np.zeros((0, len(BINS)), np.int64), np.zeros(0, np.int64), base)
    data = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)
    kind = _CLASS[data]
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))

    def count(bit: int) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum((kind & bit) != 0, dtype=np.int64)))
        return total[ends] - total[starts]

    full = (kind & 64) != 0
    begins = full.copy()
    begins[1:] &= ~full[:-1]
    total = np.concatenate(([0], np.cumsum(begins, dtype=np.int64)))
    words = total[ends] - total[starts]

    def per_word(marks: list[np.ndarray]) -> np.ndarray:
        run = np.concatenate(([0], np.cumsum(np.concatenate(marks), dtype=np.int64)))
        stop = np.cumsum(words)
        return (run[stop] - run[stop - words]) / np.maximum(words, 1)

    solid = count(64)
    # the last byte outside white space of each line
    at = np.maximum.accumulate(np.where(full, np.arange(len(data)), -1))[ends]
    closed = np.isin(data[np.maximum(at, 0)], np.frombuffer(b".!?:;\"')", np.uint8)) & (at >= starts)
    values = {
        "symbols": count(1) / np.maximum(solid, 1),
        "capitals": count(2) / np.maximum(count(4), 1),
        "bangs": count(8) / np.maximum(words, 1),
        "bars": count(16) / np.maximum(words, 1),
        "digits": count(32) / np.maximum(solid, 1),
        "words": words,
        "repeats": per_word(flags),
        "echoes": per_word(echoes),
        "length": solid / np.maximum(words, 1),
        "closed": closed,
        "again": np.array(again, np.int64),
    }
    codes = np.stack(
        [o + np.searchsorted(np.array(b), values[k], side="left") for o, (k, b) in zip(OFFSETS, BINS.items())], axis=1
    )
    return Lines(n_lines, codes, words, base)


@dataclass(frozen=True)
class Field:
    """Weights: of the observations for label 1 (label 0 has 0), of label pairs, and of the first label."""

    emit: np.ndarray
    move: np.ndarray
    first: np.ndarray


def _steps(n_lines: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Documents by falling length, and for each step the rows of the documents that reach it."""
    order = np.argsort(-n_lines, kind="stable")
    begin = (np.cumsum(n_lines) - n_lines)[order]
    length = n_lines[order]
    most = int(length[0]) if len(length) else 0
    reach = np.searchsorted(-length, -np.arange(most), side="left")
    return order, [begin[:k] + t for t, k in enumerate(reach)]


def viterbi(field: Field, n_lines: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The most likely label of every line."""
    labels = np.zeros(len(codes), np.int64)
    _, steps = _steps(n_lines)
    if not steps:
        return labels
    emit = field.emit[codes].sum(axis=1)
    back: list[np.ndarray] = []
    score = np.stack([np.full(len(steps[0]), field.first[0]), field.first[1] + emit[steps[0]]], axis=1)
    last = np.empty((len(steps[0]), 2))
    last[:] = score
    for rows in steps[1:]:
        k = len(rows)
        ways = score[:k, :, None] + field.move[None]
        back.append(ways.argmax(axis=1))
        score = ways.max(axis=1)
        score[:, 1] += emit[rows]
        last[:k] = score
    state = last.argmax(axis=1)
    for t in range(len(steps) - 1, -1, -1):
        rows = steps[t]
        k = len(rows)
        labels[rows] = state[:k]
        if t:
            state[:k] = back[t - 1][np.arange(k), state[:k]]
    return labels


def fit(n_lines: np.ndarray, codes: np.ndarray, labels: np.ndarray, p: RuleParams, chain: bool = True) -> Field:
    """Maximum likelihood by Adam over forward and backward sums; ``chain=False`` leaves the transitions at 0."""
    _, steps = _steps(n_lines)
    emit, move, first = np.zeros(N_WEIGHTS), np.zeros((2, 2)), np.zeros(2)
    seen_emit = np.bincount(codes[labels == 1].ravel(), minlength=N_WEIGHTS).astype(float)
    seen_move, seen_first = np.zeros((2, 2)), np.zeros(2)
    for a, b in zip(steps, steps[1:]):
        np.add.at(seen_move, (labels[a[: len(b)]], labels[b]), 1)
    if steps:
        seen_first += np.bincount(labels[steps[0]], minlength=2)
    params = np.concatenate((emit, move.ravel(), first))
    seen = np.concatenate((seen_emit, seen_move.ravel(), seen_first))
    m1, m2 = np.zeros_like(params), np.zeros_like(params)
    for turn in range(1, p.rounds + 1):
        emit, move, first = params[:N_WEIGHTS], params[N_WEIGHTS:-2].reshape(2, 2), params[-2:]
        e = np.zeros((len(codes), 2))
        e[:, 1] = emit[codes].sum(axis=1)
        alpha = np.zeros((len(codes), 2))
        alpha[steps[0]] = first + e[steps[0]]
        for a, b in zip(steps, steps[1:]):
            alpha[b] = np.logaddexp(alpha[a[: len(b)], 0, None] + move[0], alpha[a[: len(b)], 1, None] + move[1]) + e[b]
        beta = np.zeros((len(codes), 2))
        want_move = np.zeros((2, 2))
        for t in range(len(steps) - 2, -1, -1):
            a, b = steps[t][: len(steps[t + 1])], steps[t + 1]
            ahead = beta[b] + e[b]
            beta[a] = np.logaddexp(move[:, 0] + ahead[:, :1], move[:, 1] + ahead[:, 1:])
            both = alpha[a][:, :, None] + move + ahead[:, None, :]
            total = np.logaddexp(*np.logaddexp(alpha[b] + beta[b], -np.inf).T)
            want_move += np.exp(both - total[:, None, None]).sum(axis=0)
        mass = alpha + beta
        share = np.exp(mass - np.logaddexp(mass[:, :1], mass[:, 1:]))
        want_emit = np.zeros(N_WEIGHTS)
        for c in range(codes.shape[1]):
            want_emit += np.bincount(codes[:, c], share[:, 1], N_WEIGHTS)
        want = np.concatenate((want_emit, want_move.ravel(), share[steps[0]].sum(axis=0)))
        slope = (seen - want) / len(codes) - p.ridge * params
        if not chain:
            slope[N_WEIGHTS:] = 0
        m1, m2 = 0.9 * m1 + 0.1 * slope, 0.99 * m2 + 0.01 * slope**2
        params = params + p.step * (m1 / (1 - 0.9**turn)) / (np.sqrt(m2 / (1 - 0.99**turn)) + 1e-8)
    return Field(params[:N_WEIGHTS], params[N_WEIGHTS:-2].reshape(2, 2), params[-2:])


ALL_CONTENT = Field(np.zeros(N_WEIGHTS), np.array([[-1.0, -1.0], [0.0, 0.0]]), np.array([-1.0, 0.0]))


def train(docs: DataFrame, labels: DataFrame, p: RuleParams = RULES) -> Field:
    """Fit the field on at most ``p.train_documents`` labelled documents."""
    chosen = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("_good"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(p.train_documents)
    )
    fields = T.StructType([T.StructField("_codes", T.BinaryType()), T.StructField("_lines", T.LongType())])

    def compute(texts: list) -> list[pa.Array]:
        seen = observe(texts)
        stop = np.cumsum(seen.n_lines)
        small = seen.codes.astype(np.uint8)
        few = seen.n_lines <= p.train_lines
        parts = [small[b - n : b].tobytes() if ok else b"" for b, n, ok in zip(stop, seen.n_lines, few)]
        return [pa.array(parts, pa.binary()), pa.array(np.where(few, seen.n_lines, 0), pa.int64())]

    # at most train_documents rows are broadcast and come back, train_lines lines each
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = add_columns(picked, fields, compute).where("_lines > 0").select("doc_id", "_good", "_codes", "_lines").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["_lines"], r["_codes"]))
    good = np.array([r["_good"] for r in rows], np.int64)
    if len(set(good.tolist())) < 2:
        return ALL_CONTENT
    n_lines = np.array([r["_lines"] for r in rows], np.int64)
    codes = np.concatenate([np.frombuffer(r["_codes"], np.uint8).reshape(-1, len(BINS)) for r in rows]).astype(np.int64)
    weak = np.repeat(good, n_lines)
    plain = fit(n_lines, codes, weak, p, chain=False)
    alike = plain.emit[codes].sum(axis=1) > 2.0
    return fit(n_lines, codes, np.where(alike, 1, weak), p)


RESULT = T.StructType(
    [
        *(T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("content_share", T.DoubleType()),
        T.StructField("line_labels", T.StringType()),
        T.StructField("kept", T.BooleanType()),
    ]
)


def judge(docs: DataFrame, field: Field, p: RuleParams = RULES, text: str = "text") -> DataFrame:
    """All columns, the plain counts, a letter per line (C or B), the content share and the verdict."""

    def compute(texts: list) -> list[pa.Array]:
        seen = observe(texts)
        marks = viterbi(field, seen.n_lines, seen.codes)
        stop = np.cumsum(seen.n_lines)
        letters = np.where(marks == 1, ord("C"), ord("B")).astype(np.uint8).tobytes().decode()
        run = np.concatenate(([0], np.cumsum(seen.words * marks)))
        n = seen.base["n_words"]
        share = (run[stop] - run[stop - seen.n_lines]) / np.maximum(n, 1)
        failed = (n < p.min_words) | (100 * seen.base["n_repeat_words"] > p.max_repeat_percent * n)
        kept = ~failed & (share >= p.min_content_share)
        labels = [letters[b - k : b] for b, k in zip(stop.tolist(), seen.n_lines.tolist())]
        return [
            *(pa.array(seen.base[f.name], pa.int64()) for f in RESULT.fields[:5]),
            pa.array(failed, pa.bool_()),
            pa.array(share, pa.float64()),
            pa.array(labels, pa.string()),
            pa.array(kept, pa.bool_()),
        ]

    return add_columns(docs, RESULT, compute, text)


@query("op7_line_crf")
def op7_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its plain counts, content share and verdict."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    field = train(docs, table(spark, sf_dir, "labels"))
    return judge(docs, field).drop("text")
