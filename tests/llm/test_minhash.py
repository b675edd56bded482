"""MinHash groups against all pairs on small tables; sketches against their definition."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartsight.llm import minhash
from cartsight.sources.tables import settle

SCHEMA = "doc_id long, text string"


def plain_set(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    size = min(shingle, len(words))
    return frozenset(b" ".join(words[i : i + size]) for i in range(len(words) - size + 1))


def plain_components(sets, percent):
    """{id: smallest id reachable} by all pairs."""
    top = {i: i for i in sets}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                top[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def corpus(seed=0, groups=60, size=12):
    """Groups of edited copies of a text around the threshold, of different lengths."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(5000)]
    texts = []
    for _ in range(groups):
        base = rng.choices(vocabulary, k=rng.choice([4, 12, 40, 150, 400]))
        for _ in range(rng.randint(1, size)):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(words) // 25))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(w.upper() if rng.random() < 0.1 else w for w in words))
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_equals_all_pairs(spark):
    rows = corpus()
    found = {r.doc_id: r for r in minhash.near_groups(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    sets = {i: plain_set(t) for i, t in rows}
    expected = plain_components(sets, 85)
    assert {i: r.n_shingles for i, r in found.items()} == {i: len(s) for i, s in sets.items()}
    assert {i: r.component_id for i, r in found.items()} == expected
    assert {i for i, r in found.items() if r.kept} == set(expected.values())
    assert 40 < len(set(expected.values())) < len(rows)


def star(n, length=200, edits=8, seed=0):
    """Edited copies of one text, most of them linked to it and few to one another."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(length)]
    rows = [(10_000, " ".join(base))]
    for k in range(n):
        words = list(base)
        for e in rng.sample(range(length), edits):
            words[e] = f"x{k}.{e}"
        rows.append((k, " ".join(words)))
    return rows


@pytest.mark.parametrize("chunk", [4, 512])
def test_buckets_whose_first_is_linked_with_few(spark, chunk):
    rows = star(60)
    sets = {i: plain_set(t) for i, t in rows}
    expected = plain_components(sets, 79)
    found = minhash.near_groups(spark.createDataFrame(rows, SCHEMA), percent=79, rows=2, chunk=chunk).collect()
    assert {r.doc_id: r.component_id for r in found} == expected


@pytest.mark.parametrize("chunk", [3, 512])
def test_second_step_finds_what_the_first_leaves(spark, chunk):
    """One bucket with known components; all links between them must come from the bucket's task."""
    rows = corpus(seed=4, groups=6, size=9)
    hashed = list(zip([i for i, _ in rows], minhash.shingle_sets([t for _, t in rows], 3)))
    sets = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in hashed], "node long, set binary")
    members = settle(
        spark.createDataFrame([(0, 1, i, len(s), i, rows[0][0], len(rows)) for i, s in hashed], "band int, key long, node long, n long, root long, main long, many long")
    )
    links = [(r.a, r.b) for r in minhash.bucket_links(members, sets, 85, chunk).collect()]
    expected = plain_components({i: plain_set(t) for i, t in rows}, 85)
    top = {i: i for i, _ in rows}
    for _ in rows:
        for a, b in links:
            top[a] = top[b] = min(top[a], top[b])
    assert top == expected
    plain = {i: plain_set(t) for i, t in rows}
    assert all(100 * len(plain[a] & plain[b]) >= 85 * len(plain[a] | plain[b]) for a, b in links)


def test_every_coordinate_is_filled_and_agrees_by_similarity():
    rng = np.random.default_rng(0)
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    for n in (1, 2, 7, 100, 3000):
        sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for _ in range(3)] + [np.zeros(0, np.uint64)]
        s = minhash.sketches(sets, 80)
        assert (s[:3] != empty).all() and (s[3] == empty).all()
        assert (s[0] == minhash.sketches(sets[:1], 80)[0]).all()
    agree = []
    for _ in range(60):
        both = rng.integers(0, 1 << 63, 80, dtype=np.uint64)
        a, b = (np.unique(np.concatenate([both, rng.integers(0, 1 << 63, 10, dtype=np.uint64)])) for _ in range(2))
        x, y = minhash.sketches([a, b], 80)
        agree.append((x == y).mean())
    assert abs(np.mean(agree) - 0.8) < 0.02 and np.std(agree) < 0.07


def test_large_group_of_near_copies_and_words(spark):
    rows = star(700, length=80, edits=1) + [(20_000 + i, "the same text again and again") for i in range(300)]
    found = {r.doc_id: r.component_id for r in minhash.near_groups(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == plain_components({i: plain_set(t) for i, t in rows}, 85)


def test_defined_cases(spark):
    long = " ".join(f"word{i % 9000}" for i in range(60_000))
    rows = [(1, "Same words here now"), (1, "same WORDS here\tnow"), (2, None), (3, ""), (4, " \n"), (5, "one"), (6, "ONE"), (7, "one two"), (None, "no id"), (8, long), (9, long + " end"), (None, "Same words here now")]
    clash = {c: F.lit(f"own {c}") for c in ("_n", "_set", "_keys", "_row", "_id", "_text", "_carried", "node", "root", "n_shingles", "KEPT")}
    out = minhash.near_groups(spark.createDataFrame(rows, SCHEMA).withColumns(clash).repartition(3)).collect()
    assert {r["_row"] for r in out} == {"own _row"} and len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert sorted(by[1]) == [(2, 1, False), (2, 1, True)]
    assert [by[i] for i in (2, 3, 4)] == [[(0, i, True)] for i in (2, 3, 4)]
    assert by[5] == [(1, 5, True)] and by[6] == [(1, 5, False)] and by[7] == [(1, 7, True)]
    assert sorted(by[None], key=repr) == sorted([(1, None, True), (2, 1, False)], key=repr)
    assert by[8] == [(9000, 8, True)] and by[9] == [(9001, 8, False)]
    assert minhash.near_groups(spark.createDataFrame([], SCHEMA)).collect() == []


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    sets = {r.doc_id: plain_set(r.text) for r in docs}
    expected = plain_components(sets, 85)
    found = minhash.op11_minhash(spark, folder).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == {i: (len(s), expected[i], expected[i] == i) for i, s in sets.items()}
