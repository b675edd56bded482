"""The operators against plain versions of what they compute."""

import collections
import glob
import hashlib
import itertools
import math
import os
import random
import re
import tempfile

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from cartsight.llm import bpe, chat, licences, linecrf, machine, mixing, passages, ppm, simhash, trie
from cartsight.llm.components import connected_components
from cartsight.llm.registry import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}


# --- BPE ------------------------------------------------------------------------------------------


def test_bpe_equals_the_library(spark, documents, texts):
    library = Tokenizer.from_file(bpe.vocabulary_path())
    got = {r.doc_id: r for r in bpe.decode(bpe.encode(documents)).collect()}
    for i, text in texts.items():
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(got[i].ids, "<u4").tolist() == want
        assert got[i].decoded == library.decode(want, skip_special_tokens=False) == text
        assert got[i].n_tokens == len(want)


def test_bpe_odd_texts():
    draw = random.Random(1)
    letters = "ab 'sdé\x1c\x85\xa0\n\t ​\U0001f600中1²_-$<|endoftext|>"
    odd = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 60))) for _ in range(500)]
    odd += ["<|endoftext|>", "a<|endoftext|> b", "aaaaaaa" * 300, "=-" * 4000, "\n" * 500, None]
    model, library = bpe.read_vocabulary(open(bpe.vocabulary_path()).read()), Tokenizer.from_file(bpe.vocabulary_path())
    got = bpe.encode_texts(odd, model)
    for g, text in zip(got, odd):
        assert np.frombuffer(g, "<u4").tolist() == library.encode(text or "", add_special_tokens=False).ids
    assert bpe.decode_ids(got, model) == [t or "" for t in odd]


# --- quality rules ---------------------------------------------------------------------------------


def plain_counts(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = collections.Counter(windows)
    marked = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    lines = text.split("\n")
    dup = sum(bool(WORD.search(x)) and x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(marked)


def test_line_counts(texts):
    some = [*texts.values()][:120] + ["a b a b a b", "x\nx\n\n\n x", "", "a a a a", "é | 中"]
    seen = linecrf.observe(some).base
    for k, text in enumerate(some):
        assert tuple(int(v[k]) for v in seen.values()) == plain_counts(text)


def test_viterbi_is_the_best_labelling():
    draw = np.random.default_rng(3)
    field = linecrf.Field(draw.normal(size=linecrf.N_WEIGHTS), draw.normal(size=(2, 2)), draw.normal(size=2))
    n_lines = np.array([3, 1, 7, 5])
    codes = draw.integers(0, linecrf.N_WEIGHTS, (n_lines.sum(), 4))
    got, at = linecrf.viterbi(field, n_lines, codes), 0
    for n in n_lines:
        emit = field.emit[codes[at : at + n]].sum(axis=1)

        def value(path):
            return field.first[path[0]] + sum(e * y for e, y in zip(emit, path)) + sum(field.move[a, b] for a, b in zip(path, path[1:]))

        best = max(itertools.product((0, 1), repeat=int(n)), key=value)
        assert tuple(got[at : at + n]) == best
        at += n


def test_fit_follows_the_likelihood():
    draw = np.random.default_rng(5)
    n_lines = np.full(60, 6)
    labels = (draw.random(360) < 0.5).astype(int)
    codes = np.stack([labels * 2 + (draw.random(360) < 0.2), draw.integers(4, 8, 360)], axis=1)
    field = linecrf.fit(n_lines, codes, labels, linecrf.RULES)
    assert (linecrf.viterbi(field, n_lines, codes) == labels).mean() > 0.99


def test_rules_keep_good_and_drop_poor(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = labels.where("doc_id % 3 = 0")
    rows = linecrf.judge(docs.join(held, "doc_id"), linecrf.train(docs, labels.where("doc_id % 3 != 0"))).where("NOT base_failed").collect()
    good, poor = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(poor) < 0.3 and len(poor) > 3


# --- exact duplicates ------------------------------------------------------------------------------


def plain_groups(texts):
    groups = collections.defaultdict(list)
    for i, t in texts.items():
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append(i)
    return {i: (min(g, key=lambda k: (-len(texts[k] or ""), k)), len(g)) for g in groups.values() for i in g}


@pytest.mark.parametrize("trie_bytes", [trie.TRIE_BYTES, 20_000])
def test_exact_groups(spark, documents, texts, trie_bytes):
    got = {r.doc_id: r for r in trie.exact_groups(documents.repartition(5), carry=["doc_id"], trie_bytes=trie_bytes).collect()}
    assert {i: (r.keep_id, r.group_size) for i, r in got.items()} == plain_groups(texts)
    assert all(r.kept == (r.keep_id == i) for i, r in got.items())


def test_trie_keeps_prefixes_apart():
    made, draw = trie.Trie(), random.Random(2)
    keys = [bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 9))) for _ in range(400)]
    for n, k in enumerate(keys):
        made.insert(k, (0, False, n, n), 1)
    want = {k: (keys.index(k), keys.count(k)) for k in keys}
    assert {k: (best[2], n) for k, best, n in made.terminals()} == want
    parts = [*made.spill(), *made.terminals()]
    assert {k: (best[2], n) for k, best, n in parts} == want and made.held >= 0


# --- SimHash ---------------------------------------------------------------------------------------


def plain_print(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints, bits=2):
    top = {i: i for i in prints}

    def find(a):
        while top[a] != a:
            a = top[a]
        return a

    for a, b in itertools.combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= bits:
            x, y = sorted((find(a), find(b)))
            top[y] = x
    return {i: find(i) for i in prints}


@pytest.mark.parametrize("crowd", [256, 2])
def test_near_groups(spark, documents, texts, crowd):
    rows = simhash.near_groups(documents, carry=["doc_id"], crowd=crowd).collect()
    prints = {i: plain_print(t) for i, t in texts.items()}
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r.doc_id: r.component_id for r in rows} == plain_components(prints)


@pytest.mark.parametrize("crowd", [256, 3])
def test_links_of_planted_prints(spark, crowd):
    draw = random.Random(4)
    seeds = [draw.getrandbits(64) for _ in range(30)]
    values = set(seeds)
    for s in seeds:
        for _ in range(20):
            s ^= 1 << draw.randrange(64) | 1 << draw.randrange(64)
            values.add(s)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "print long")
    roots = {r.node: r.root for r in connected_components(simhash.links(frame, 2, crowd)).collect()}
    want = plain_components(dict(zip(signed, values)))
    assert {v: roots.get(v, v) for v in signed} == want


def test_components_of_chains(spark):
    draw, n = random.Random(6), 300
    names = draw.sample(range(10_000), n)
    links = [(names[i], names[i + 1]) for i in range(n - 1) if i % 50 != 49] + [(5, 5), (None, 1)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    for at in range(0, n, 50):
        part = names[at : at + 50]
        assert {got[x] for x in part} == {min(part)}


# --- mixing ----------------------------------------------------------------------------------------


def test_targets_are_filled_and_limited(spark):
    sizes = [("a", 10), ("b", 1000), ("c", 5), (None, 400), ("d", 0), ("e", 90)]
    rows = mixing.targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()
    got = {r.source: r.target for r in rows}
    names, total = sorted(s for s, _ in sizes if s) + [None], sum(n for _, n in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    size, full = dict(sizes), set()
    while True:
        left, share = total - sum(3 * size[s] for s in full), sum(w for s, w in weight.items() if s not in full)
        over = {s for s in names if s not in full and weight[s] * left / share >= 3 * size[s]}
        if not over:
            break
        full |= over
    for s in names:
        assert got[s] == pytest.approx(3 * size[s] if s in full else weight[s] * left / share)
    assert sum(got.values()) == pytest.approx(total)


def test_taken_words_come_near(spark):
    rows = [(i, "word " * (1 + i % 9), "abc"[i % 3]) for i in range(6000)]
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    first, again = (sorted((r.doc_id, r.taken) for r in mixed.repartition(n).collect()) for n in (3, 5))
    assert first == again
    for r in mixed.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("target")).collect():
        assert r.t == pytest.approx(r.target, rel=0.05)
    assert mixed.where("taken > 3 * size").count() == 0


# --- language model --------------------------------------------------------------------------------


def plain_tokens(text):
    return (text or "").encode().lower().split() + [ppm.END]


def plain_spelled(text, order):
    """The context of full length and the bytes of each token."""
    before = b" " * order
    for w in plain_tokens(text):
        yield before[-order:] + (w if w == ppm.END else w + b" ")
        before += w + b" "


def plain_scores(rows, order, prior, classes=False):
    """{id: (tokens, known, total, base, score, trie)} by a dictionary of contexts."""
    met, words = collections.defaultdict(collections.Counter), collections.Counter()
    for i, text, lang in rows:
        if not ppm.held_out(i):
            words.update(plain_tokens(text))
            for x in plain_spelled(text, order):
                for at in range(order, len(x)):
                    for k in range(order + 1):
                        met[classes and lang, x[at - k : at]][x[at]] += 1

    def chance(lang, x):
        out = 0.0
        for at in range(order, len(x)):
            gone = set()
            for k in range(order, -1, -1):
                here = {y: c for y, c in met.get((lang, x[at - k : at]), {}).items() if y not in gone}
                if not here:
                    continue
                n = sum(here.values())
                if x[at] in here:
                    out += math.log10((2 * here[x[at]] - 1) / (2 * n))
                    break
                out += math.log10(len(here) / (2 * n))
                gone |= set(here)
            else:
                out -= math.log10(256 - len(gone))
        return out

    total, distinct, result = sum(words.values()), len(words), {}
    for i, text, lang in rows:
        t, score, trie, seen = plain_tokens(text), 0.0, 0.0, collections.Counter()
        for j, (w, x) in enumerate(zip(t, plain_spelled(text, order))):
            p = chance(classes and lang, x)
            score += math.log10((seen[w] + prior * 10**p) / (j + prior))
            trie += p
            seen[w] += 1
        base = sum(math.log10((words[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in t)
        result[i] = len(t), sum(w in words for w in t), total, base, score, trie
    return result


@pytest.mark.parametrize("order, context, heavy", [(4, "lang", 10**9), (6, None, 40), (3, "lang", 5), (2, None, 1)])
def test_ppm_equals_a_dictionary_trie(spark, documents, order, context, heavy):
    prior = 50.0
    rows = [tuple(r) for r in documents.select("doc_id", "text", "lang").where("length(text) < 700").collect()]
    rows += [(10_000 + k, t, "en") for k, t in enumerate((None, "", "  One\ntwo ", "One One ONE " * 30))]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = ppm.score_documents(frame, order=order, prior=prior, block_bytes=9_000, context=context, heavy=heavy, part_keys=2_000).collect()
    want = plain_scores(rows, order, prior, context is not None)
    assert len(got) == len(rows)
    for g in got:
        many, known, total, base, score, trie = want[g.doc_id]
        assert (g.n_tokens, g.n_known, g.train_tokens) == (many, known, total)
        assert g.base_score == pytest.approx(base, rel=1e-9)
        assert (g.score, g.trie_score) == pytest.approx((score, trie), rel=1e-7)


def test_ppm_contexts_reach_into_earlier_words(spark):
    rows = [(i, " ".join(("one two three", "four five a b")[(i + k) % 2] for k in range(1 + i % 4)), "x") for i in range(60)]
    rows += [(100 + k, t, "x") for k, t in enumerate(("one two three four", "four two three one", "  One\ntwo three\tfour "))]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = {r.doc_id: r.trie_score for r in ppm.score_documents(frame, block_bytes=200).collect()}
    assert abs(got[100] - got[101]) > 0.1 and got[100] == pytest.approx(got[102])


def test_ppm_sums_to_one():
    # all bytes that can follow one context, seen ones and new ones, with and without a split of the ends
    order = 3
    grams = ppm.text_grams([b"ab abc ac b \n", b"abab \n"], [1, 1], order)
    keys, n = ppm.counted(grams)
    split = {1: ppm.merged([(keys & ppm.level_mask(1), n)])}
    for context in (b"  a", b" ab", b"zzz", b"   "):
        head = int.from_bytes(bytes([1] + [0] * (6 - order)) + context, "big") << 8
        wanted = np.array([head | b for b in range(256)], np.int64)
        for length in (2, 3):
            mine = ppm._ends(keys, length) == ppm._ends(wanted[:1], length)
            low = {**split, **({2: ppm.merged([(keys & ppm.level_mask(2), n)])} if length == 3 else {})}
            lp = ppm.gram_scores(wanted, keys[mine], n[mine], low, order)
            assert (10**lp).sum() == pytest.approx(1.0)


def test_ppm_places_and_packed_keys():
    draw = np.random.default_rng(0)
    for n in (0, 1, 5, 40_000):
        keys, counts = ppm.counted(draw.integers(0, 1 << 62, n))
        assert (ppm.unpack_keys(ppm.pack_keys(keys)) == keys).all() and (ppm.unpack(ppm.pack(counts)) == counts).all()
        order = draw.permutation(len(keys))
        assert (ppm.Places(keys).find(keys[order]) == order).all()


def test_ppm_beats_the_base_where_it_did_not_learn(spark):
    """The registered query, the trie alone as well."""
    rows = ppm.op4_ppm(spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
    assert sum(r.trie_score for r in rows) > sum(r.base_score for r in rows)


# --- classifier ------------------------------------------------------------------------------------


def test_machine_pair_term():
    draw = np.random.default_rng(1)
    m = machine.Machine(0.3, draw.normal(size=50), draw.normal(size=(50, 4)), 40)
    sizes, idx, val = np.array([3, 5]), draw.integers(0, 50, 8), draw.normal(size=8)
    got, at = machine.raw_scores(m, sizes, idx, val), 0
    for n, g in zip(sizes, got):
        i, x = idx[at : at + n], val[at : at + n]
        pairs = sum(m.factors[i[a]] @ m.factors[i[b]] * x[a] * x[b] for a in range(n) for b in range(a + 1, n))
        assert g == pytest.approx(0.3 + m.weights[i] @ x + pairs)
        at += n


def test_machine_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op8_factorisation"](spark, folder).where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    good, poor = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert np.mean([g > p for g in good for p in poor]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


# --- passages --------------------------------------------------------------------------------------


@pytest.mark.parametrize("most", [10**9, 15])
def test_windows_partition_all_stretches(most):
    draw = random.Random(most)
    h = np.array([draw.randint(1, most) for _ in range(50)] + [0] + [draw.randint(1, most) for _ in range(30)], np.uint64)
    found = list(zip(*(x.tolist() for x in passages.compact_windows(h, 5))))
    for i in range(len(h)):
        for k in range(i + 4, len(h)):
            hits = [w for w in found if w[0] <= i <= w[1] <= k <= w[2]]
            if i <= 50 <= k:  # an end of a text
                assert not hits
            else:
                assert len(hits) == 1 and h[hits[0][1]] == h[i : k + 1].min()
    assert all(r - l >= 4 for l, _, r in found)


def test_passages_find_all_repeats(spark, texts):
    draw, base, planted = random.Random(3), list(texts.items()), []
    words = [f"w{i}" for i in range(3000)]
    for k in range(25):
        passage = [draw.choice(words) for _ in range(draw.randint(51, 90))]
        for c in range(draw.choice([2, 3, 6])):
            own = list(passage)
            if c and k % 3 == 0:
                own[len(own) // 2] = f"edit{c}"
            around = [[draw.choice(words) for _ in range(draw.randint(0, 200))] for _ in range(2)]
            planted.append((100_000 + 10 * k + c, " ".join(around[0] + own + around[1])))
    clean = [(200_000 + k, " ".join(draw.choice(words) for _ in range(300))) for k in range(60)]
    every = dict(base + planted + clean)
    frame = spark.createDataFrame(list(every.items()), "doc_id long, text string").repartition(6)
    rows = passages.repeated_passages(frame).collect()
    found = {r.doc_id for r in rows} | {r.partner_id for r in rows}
    assert {i for i, _ in planted} <= found and not found & {i for i, _ in clean}
    runs, top = collections.defaultdict(set), {}
    for i, t in every.items():
        w = t.lower().split()
        for k in range(len(w) - 49):
            runs[tuple(w[k : k + 50])].add(i)

    def find(a):
        top.setdefault(a, a)
        while top[a] != a:
            a = top[a]
        return a

    for r in rows:
        assert r.similarity >= 0.8 and min(r.stop_word - r.start_word, r.partner_stop - r.partner_start) >= 50
        top[find(r.doc_id)] = find(r.partner_id)
    assert all(len({find(i) for i in ids}) == 1 for ids in runs.values() if len(ids) > 1)


def test_passages_of_many_texts_lose_no_link(spark):
    """Each passage is like those that it was edited from and into only, so that no first text connects them."""
    draw, p, docs = random.Random(12), passages.PARAMS, {}
    ids = draw.sample(range(10**6), 160)
    for family in range(4):
        passage = [f"p{family}x{i}" for i in range(60)]
        for k in range(40):
            passage[draw.randrange(8, 52)] = f"e{draw.getrandbits(40)}"
            around = [[f"x{draw.getrandbits(40)}" for _ in range(draw.randint(0, 60))] for _ in range(2)]
            docs[ids[40 * family + k]] = " ".join(around[0] + passage + around[1])
    groups, links = collections.defaultdict(list), collections.defaultdict(list)
    for key, _, doc, l, c, r in zip(*(x.tolist() for x in passages.text_windows(list(docs.values()), list(docs), p))):
        groups[key].append((doc, l, c, r))
    for key, group in groups.items():
        for (a, l, c, r), (b, ll, cc, rr) in itertools.combinations(sorted(group), 2):
            low, high = max(l, ll - cc + c), min(r, rr - cc + c)
            if a != b and high - low + 1 >= p.shingles:
                links[a, b].append((key & 0xFF, low, high, cc - c))
    pairs = set()
    for (a, b), found in links.items():
        for al, ah, bl, bh in passages.interval_join(found, p):
            one, two = ([w.encode() for w in docs[x].split()[max(0, lo) : hi + p.shingle]] for x, lo, hi in ((a, al, ah), (b, bl, bh)))
            if passages.verify(one, two, p):
                pairs.add((a, b))
    assert len(pairs) > 140
    rows = passages.repeated_passages(spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)).collect()
    top = {i: i for i in docs}

    def find(a):
        while top[a] != a:
            a = top[a]
        return a

    for r in rows:
        top[find(r.doc_id)] = find(r.partner_id)
    assert [x for x in pairs if find(x[0]) != find(x[1])] == []
    classes = {i: (r.class_id, r.class_start) for r in rows for i in (r.doc_id, r.partner_id)}
    assert all(classes[a] == classes[b] for a, b in pairs)


def test_stored_tables_leave_no_shuffle_files(spark):
    root = spark.conf.get("spark.local.dir", None) or tempfile.gettempdir()
    rows = spark.range(200_000).withColumn("x", F.xxhash64("id")).repartition(4, "x")

    def kept(store):
        before = set(glob.glob(f"{root}/**/blockmgr-*/*/shuffle_*.data", recursive=True))
        assert store(rows).count() == 200_000
        return set(glob.glob(f"{root}/**/blockmgr-*/*/shuffle_*.data", recursive=True)) - before

    before = spark.conf.get(passages.CLEANUP)
    assert len(kept(passages.settle)) >= 1  # what the operator did before
    new = kept(passages.stored)  # the count's own are small
    assert sum(os.path.getsize(f) for f in new if os.path.exists(f)) < 10_000
    assert spark.conf.get(passages.CLEANUP) == before


def test_candidates_within_a_class_are_cut_to_what_is_unknown(spark):
    at = [(d, 100, 200, 7) for d in (1, 2)] + [(3, 100, 200, 8), (4, 20, 260, 7)]
    at = spark.createDataFrame(at, "doc long, low int, high int, root long")
    given = [(1, 2, 0, 295, 0, 295), (1, 2, 80, 215, 80, 215), (1, 3, 80, 215, 80, 215), (1, 5, 80, 215, 0, 130), (1, 4, 0, 195, 0, 195)]
    rows = passages.unknown(spark.createDataFrame(given, passages.CANDIDATE), at, passages.PARAMS).collect()
    beside = [(1, 2, 0, 95, 0, 295), (1, 2, 200, 295, 0, 295), (1, 2, 0, 295, 0, 95), (1, 2, 0, 295, 200, 295), (1, 4, 0, 95, 0, 195)]
    assert sorted(map(tuple, rows)) == sorted([*beside, *given[2:4]])


def test_class_of_stretches():
    draw, p, met = random.Random(5), passages.PARAMS, collections.Counter()
    for _ in range(3000):
        cuts = sorted(draw.sample(range(400), 2 * draw.randint(0, 3)))
        at = [(a, b, draw.choice([4, 4, 9])) for a, b in zip(cuts[::2], cuts[1::2])]
        low = draw.randrange(300)
        high = low + draw.randint(45, 150)
        c, other = draw.randint(low, high), draw.randint(low, high)
        one = [np.array([x], np.int64) for x in (c, other - c, low, high)]
        (got,) = passages._classes(6, *one, np.array(at, np.int64).reshape(-1, 3).T, p).tolist()
        roots = {r for a, b, r in at if a < high + 5 and b > low}
        first, stop = min(c, other), max(c, other) + 5
        begins = [i for i in range(low, high + 5 - 49) if i <= first and max(i + 50, stop) <= high + 5]
        apart = [i for i in begins if not any(a < max(i + 50, stop) and b > i for a, b, _ in at)]
        want = "own" if apart or not roots else roots.pop() if len(roots) == 1 else "several"
        assert want == (got if got >= 0 else "several" if got < passages.SEVERAL else "own")
        met[want] += 1
    assert min(met.values()) > 100 and len(met) == 4


def around(draw, *parts):
    """Words of the parts, lists or numbers of words that occur nowhere else."""
    return [w for p in parts for w in (p if isinstance(p, list) else [b"x%d" % draw.getrandbits(60) for _ in range(p)])]


@pytest.mark.parametrize("size, edits, gap", [(80, 1, 10), (80, 1, 25), (200, 4, 25), (60, 0, 10)])
def test_passage_beside_a_stray_phrase(size, edits, gap):
    draw = random.Random(size + gap)
    for _ in range(20):
        passage, stray = around(draw, size), around(draw, 6)
        edited = list(passage)
        for e in range(edits):
            edited[(e + 1) * size // (edits + 1)] = b"edit"
        found = passages.verify(
            around(draw, 100, passage, gap, stray, 90), around(draw, 100, edited, gap, stray, 90), passages.PARAMS
        )
        assert len(found) == 1 and found[0][0] <= 100 and found[0][1] >= 100 + size and found[0][4] >= 0.8


def test_passages_of_texts_with_repeated_words():
    draw, p = random.Random(8), passages.PARAMS
    for k in range(150):
        a = [b"%d" % draw.randrange(2 + k % 4) for _ in range(300)]
        b = a[:120] + a[100:200] + [b"z"] * 40 + a[150:]
        for x in passages.verify(a, b, p):
            one, two = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a[x[0] : x[1]], b[x[2] : x[3]]))
            assert len(one & two) / len(one | two) == pytest.approx(x[4]) and x[4] >= p.similarity
            assert min(x[1] - x[0], x[3] - x[2]) >= p.words


@pytest.mark.parametrize("gap", [20, 40, 80])
def test_all_passages_of_a_candidate(gap):
    draw = random.Random(gap)
    one, two = around(draw, 60), around(draw, 60)
    a, b = around(draw, 50, one, gap, two, 50), around(draw, 50, one, gap, two, 50)
    places = [(50, 110, 50, 110, 1.0), (110 + gap, 170 + gap, 110 + gap, 170 + gap, 1.0)]
    assert sorted(passages.verify(a, b, passages.PARAMS)) == places
    a, b = around(draw, one, gap, two), around(draw, two, gap, one)
    crossed = [(0, 60, 60 + gap, 120 + gap, 1.0), (60 + gap, 120 + gap, 0, 60, 1.0)]
    assert sorted(passages.verify(a, b, passages.PARAMS)) == crossed


def test_passage_of_short_runs_beside_text_that_repeats_itself():
    """A passage of equal runs of 7 and 35 shingles is found where other shingles have very many equal pairs."""
    draw = random.Random(5)
    often, passage = around(draw, 70), around(draw, 51)
    edited = [*passage[:11], b"edit", *passage[12:]]
    a = around(draw, often * 40, 60, passage, 60)
    b = around(draw, 60, edited, 60, often[:60], often[5:], often * 39)
    found = passages.verify(a, b, passages.PARAMS)
    assert any(x[:4] == (2860, 2911, 60, 111) for x in found) and len(found) == 2
    # and the places of a passage that both repeat with edits, each time others
    one, two = ([w if draw.random() > 0.03 else b"e%d" % draw.getrandbits(40) for _ in range(60) for w in often] for _ in range(2))
    found = passages.verify(one, two, passages.PARAMS)
    assert len({i for x in found for i in range(x[0], x[1])}) > 0.75 * len(one)


def test_chain_of_bits_is_as_long_as_that_of_pairs():
    draw = random.Random(7)
    for _ in range(500):
        n, m, share = draw.randrange(1, 40), draw.randrange(1, 40), draw.random()
        points = [(i, ks) for i in range(n) if (ks := [k for k in range(m) if draw.random() < share])]
        got = passages._chain_of_bits([(i, sum(1 << k for k in ks)) for i, ks in points], m)
        assert len(got) == len(passages._chain(points)) and all(k in dict(points)[i] for i, k in got)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))


# --- licences --------------------------------------------------------------------------------------


def test_licences_in_the_documents(spark, texts, documents):
    notices = {
        "MIT": "released under the mit license",
        "GPL-3.0": "this work is licensed under the gnu general public license, version 3",
        "CC-BY-NC-4.0": "licensed under cc by-nc 4.0",
        "Proprietary": "all rights reserved",
        "Apache-2.0": "licensed under the apache license, version 2.0",
    }
    got = collections.defaultdict(set)
    for r in licences.scan(documents).collect():
        got[r.doc_id].add(r.licence)
        place = " ".join(texts[r.doc_id].split()[r.start_word : r.stop_word]).lower()
        assert notices[r.licence] in place and r.coverage == 1.0 and r.differences == ""
    for i, t in texts.items():
        assert got[i] == {k for k, v in notices.items() if v in " ".join(t.lower().split())}


def test_licence_over_the_end_of_a_piece():
    scanner = licences.Scanner(licences.TEMPLATES, licences.PARAMS)
    text = next(t for n, k, t in licences.TEMPLATES if (n, k) == ("MIT", "text")).split()
    differs = list(text)
    differs[20:140:10] = ["other"] * 12
    for wording in (text, differs):
        for before in (*range(400, 500, 4), 455, 459, 463, 880, 1300):
            words = ["license" if i % 50 == 0 else f"w{i}" for i in range(before)] + wording + ["license", "end"] * 150
            found = [x[:4] for x in scanner.text(" ".join(words)) if x[1] == "text"]
            assert found == [("MIT", "text", before, before + len(text))]


@pytest.fixture(scope="module")
def scanner():
    return licences.Scanner(licences.TEMPLATES, licences.PARAMS)


@pytest.mark.parametrize("k", range(len(licences.TEMPLATES)))
def test_each_template_is_found_amid_words(scanner, k):
    """Each wording, with a word changed where it is long, gives its own name and no other."""
    name, kind, text = licences.TEMPLATES[k]
    words = text.upper().split()
    if len(words) > 20:
        words[7] = "otherwise"
    around = [f"z{i}" for i in range(700)]
    found = scanner.text("\n".join(around + words + around))
    assert len(found) == 1 and found[0][0] == name and found[0][4] >= licences.PARAMS.least_saved
    assert abs(found[0][2] - 700) <= 1 and found[0][3] - 700 <= len(words)
    assert (found[0][7] != "") == (len(words) > 20)


def test_near_licences_are_told_apart(scanner):
    """Wordings that the pack does not have, but which are near to one of another licence."""
    telling = dict(zip(((name, kind) for name, kind, _ in licences.TEMPLATES), scanner.telling))
    assert {"affero", "lesser"} <= telling["GPL-3.0-or-later", "header"] and telling["MIT", "text"] == frozenset()
    assert not {"program", "library", "software"} & telling["GPL-3.0-or-later", "header"]
    found = {}
    for line in (
        "This work is licensed under the GNU General Public License, version 9.",
        "This work is licensed under the GNU Affero Public License, version 2.",
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivs 4.0 International License.",
        "a licensed driver has permission",
    ):
        found[line] = [x[0] for x in scanner.text(line)]
    assert set(map(tuple, found.values())) == {()}, found
    header = licences._gnu("server", "Affero General Public", "3", True)
    assert [x[0] for x in scanner.text(f"a word before. {header} and after")] == ["AGPL-3.0-or-later"]
    less = [w for w in header.split() if w != "Affero"]
    assert [x[0] for x in scanner.text(" ".join(less))] == ["GPL-3.0-or-later"]


def test_saving_rank_and_wording_by_hand(scanner):
    """Bytes saved with the zstandard library alone, the rank among all templates, and differences by difflib."""
    import difflib

    import zstandard

    frames = zstandard.ZstdCompressionParameters.from_level(
        licences.PARAMS.level, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0
    )

    def size(data, words=None):
        known = zstandard.ZstdCompressionDict(words.encode() if words else b"\0" * 64, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(compression_params=frames, dict_data=known).compress(data))

    draw = random.Random(5)
    for name, kind, text in licences.TEMPLATES[3::7]:
        wording = licences.plain(text.split())
        if len(wording) > 30:
            wording[12:12] = ["extra"]
        block = [f"a{draw.randrange(99)}" for _ in range(20)] + wording + [f"b{draw.randrange(99)}" for _ in range(20)]
        data = " ".join(block).encode()
        saved = [size(data) - size(data, " ".join(licences.plain(t.split()))) for _, _, t in licences.TEMPLATES]
        for found in scanner.block(block):
            k = next(i for i, x in enumerate(licences.TEMPLATES) if x[:2] == found[:2] and saved[i] == found[4])
            assert found[5] == 1 + sum(s > saved[k] or (s == saved[k] and i < k) for i, s in enumerate(saved))
            mine = licences.plain(licences.TEMPLATES[k][2].split())
            place = block[found[2] : found[3]]
            said = [x.replace(" ", "") for x in difflib.ndiff(mine, place) if x[0] in "+-"]
            assert sorted(said) == sorted(found[7].split()) and found[6] == (len(mine) - sum(x[0] == "-" for x in said)) / len(mine)
        assert name in {x[0] for x in scanner.block(block)}


def test_long_stretches_without_a_licence_word():
    """Blocks reach as far as the templates given need."""
    text = "This licence says: " + " ".join(f"term{i}" for i in range(300)) + " and nothing else."
    own = licences.Scanner((*licences.TEMPLATES, ("Own", "text", text)), licences.PARAMS)
    found = own.text(" ".join(["some", "words"] * 400) + " " + text + " " + " ".join(["other", "words"] * 400))
    assert [(x[0], x[6], x[7]) for x in found] == [("Own", 1.0, "")]


def test_licences_of_odd_rows(spark):
    notice = "Released under the MIT License."
    rows = [(1, notice), (1, notice), (None, notice), (2, None), (3, ""), (4, " ".join(["filler"] * 50_000) + " " + notice)]
    rows += [(5, "All rights reserved."), (6, "All rights reserved. " + " ".join(f"w{i * i % 97}" for i in range(63)))]
    got = licences.scan(spark.createDataFrame(rows, "doc_id long, text string").withColumn("licence", F.lit("own"))).collect()
    assert sorted(((r.doc_id, r.licence, r.start_word) for r in got), key=repr) == sorted(
        [(1, "MIT", 0), (1, "MIT", 0), (None, "MIT", 0), (4, "MIT", 50_000), (5, "Proprietary", 0), (6, "Proprietary", 0)], key=repr
    )


# --- chat ------------------------------------------------------------------------------------------


def test_escapes_are_reversible():
    draw = random.Random(2)
    for _ in range(3000):
        t = "".join(draw.choice("<|\\\nim_end>a") for _ in range(12))
        assert chat.unescape(chat.escape(t)) == t and "<|" not in chat.escape(t)
        assert chat.read_back(chat.marked([(t, t), (t, "")])) == [(t, t), (t, "")]


def test_chat_query(spark):
    folder = "/root/testdata/sf0.001"
    given = collections.defaultdict(list)
    for r in spark.read.parquet(f"{folder}/conversations.parquet").orderBy("conv_id", "turn").collect():
        given[r.conv_id].append((r.role, r.text or ""))
    given[-1] = [("user", chat.TRICK), ("assistant", chat.TRICK)]
    got = {r.conv_id: r for r in QUERIES["op10_chat"](spark, folder).collect()}
    assert set(got) == set(given)
    for i, turns in given.items():
        masked = "".join(t for r, t in turns if r == "assistant")
        g = got[i]
        assert (g.n_turns, g.loss_chars, g.formatted_chars) == (len(turns), len(masked), len(chat.marked(turns)))
        assert g.loss_sha256 == hashlib.sha256(masked.encode()).hexdigest()
        assert g.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def test_rewriting_templates_are_noticed(spark):
    def trimmed(turns):
        """Shows the thoughts of the last answer only: adding a turn rewrites the one before."""
        return chat.marked([(r, t if k == len(turns) - 1 else t.split("#")[-1]) for k, (r, t) in enumerate(turns)])

    turns = [(1, k, "assistant" if k % 2 else "user", f"think{k}#say{k}" if k % 2 else f"ask{k}") for k in range(6)]
    rows = chat.format_turns(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"), trimmed).collect()
    assert [r.rewrites for r in rows] == [False, False, True, False, True, False]
    output = ""
    for r in rows:
        output = output[: r.start] + r.segment
    assert output == trimmed([(t[2], t[3]) for t in turns])
    digests = chat.digest_turns(chat.format_turns(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"), trimmed))
    assert digests.first().turns_sha256 is None and digests.first().rewritten_turns == 2


def test_long_conversations_are_exact(spark):
    turns = [(1, k, "user" if k % 2 == 0 else "assistant", f"text {k}" * (k % 5)) for k in range(300)]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    for window in (4, 64):
        rows = chat.format_turns(frame, window=window).collect()
        assert "".join(r.segment for r in rows) == chat.marked([(t[2], t[3]) for t in turns])
        assert not any(r.rewrites for r in rows)
        assert all(r.segment[r.text_start : r.text_stop] == t[3] for r, t in zip(rows, turns))


# --- registry and pipeline -------------------------------------------------------------------------


def test_each_operator_has_a_query():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(ORACLES) <= set(QUERIES)


def test_pipeline_equals_plain_stages(spark):
    """The stages' decisions from plain versions, given the labelled lines."""
    folder = SMALL
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    field = linecrf.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    kept = {r.doc_id: r for r in linecrf.judge(docs, field).where("kept").collect()}
    assert all(plain_counts(r.text)[0] >= 50 for r in kept.values())
    owner = plain_groups({i: r.text for i, r in kept.items()})
    kept = {i: r for i, r in kept.items() if owner[i][0] == i}
    group = plain_components({i: plain_print(r.text) for i, r in kept.items()})
    kept = {i: r for i, r in kept.items() if group[i] == i}
    library = Tokenizer.from_file(bpe.vocabulary_path())
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in rows} <= set(kept)
    sources = collections.defaultdict(int)
    for r in kept.values():
        sources[r.source] += len(WORD.findall(r.text))
    copies = collections.Counter(r.doc_id for r in rows)
    targets = mixing.targets(spark.createDataFrame(list(sources.items()), "source string, source_size long")).collect()
    rate = {t.source: t.target / t.source_size for t in targets}
    for i, r in kept.items():
        whole = math.floor(rate[r.source])
        chance = int(hashlib.md5(f"mix-1:{i}".encode()).hexdigest()[:12], 16) / 2**48
        assert copies[i] == whole + (chance < rate[r.source] - whole)
    for r in rows:
        ids = library.encode(kept[r.doc_id].text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and np.frombuffer(r.ids, "<u4").tolist() == ids
        assert r.decoded_sha256 == hashlib.sha256(kept[r.doc_id].text.encode()).hexdigest()


def test_chat_long_histories_are_rendered_whole():
    given = [(("user", "assistant")[k % 2], f"t{k}") for k in range(300)]

    def numbered(turns):
        return "".join(f"{k}:{text};" for k, (_, text) in enumerate(turns))

    def rewriting(turns):  # the first turn is rewritten at the 200th
        return "".join(f"{'X' if k == 0 and len(turns) >= 200 else text};" for k, (_, text) in enumerate(turns))

    def alternating(turns):
        assert all(role == ("user", "assistant")[k % 2] for k, (role, _) in enumerate(turns))
        return chat.marked(turns)

    for template, bad in ((numbered, []), (rewriting, [199]), (alternating, [])):
        rendering = chat.Rendering(template, window=8)
        rows = [rendering.add(*turn) for turn in given]
        assert [k for k, r in enumerate(rows) if r["rewrites"]] == bad
        output = ""
        for r in rows:
            output = output[: r["start"]] + r["segment"]
        assert output == template(given)
