"""The manifest against a plain recursive tree, over many rounds of the exchange, and its defined cases."""

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from cartsight.llm import merkle
from cartsight.sources.tables import settle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(doc_id, source, lang, n_chars, text):
    values = [doc_id, source, lang, n_chars, text]
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(nodes, fanout):
    """Root, and for each node its siblings level by level as (before, after)."""
    paths = [[] for _ in nodes]
    owners = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, below = [], []
        for i in range(0, len(nodes), fanout):
            run = nodes[i : i + fanout]
            for k in range(len(run)):
                for leaf in owners[i + k]:
                    paths[leaf].append((run[:k], run[k + 1 :]))
            up.append(sha(*run))
            below.append([leaf for group in owners[i : i + fanout] for leaf in group])
        nodes, owners = up, below
    return nodes[0], paths


def climb(node, path):
    for before, after in path:
        node = sha(*before, node, *after)
    return node


def plain_manifest(rows, fanout=3):
    """{doc_id: (leaf, subroot, root, proof, folded)} with the line ends of every second text cut out."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        own = sorted((r for r in rows if r[1] == s), key=lambda r: r[0])
        trees[s] = own, *plain_tree([plain_leaf(*r) for r in own], fanout)
    root, tops = plain_tree([trees[s][1] for s in sources], fanout)
    out = {}
    for s, top in zip(sources, tops):
        own, subroot, paths = trees[s]
        for r, path in zip(own, paths):
            odd = zlib.crc32(str(r[0]).encode()) % 2
            claim = plain_leaf(*r) if odd or r[4] is None else plain_leaf(*r[:4], r[4].replace("\n", ""))
            proof = [x for before, after in path + top for x in before + after]
            out[r[0]] = plain_leaf(*r), subroot, root, proof, climb(claim, path + top)
    return out


def random_rows(n, sources, seed=1):
    rng = random.Random(seed)
    texts = [None, "", "one line", "two\nlines", "é\U0001f600\n", "\n\n"]
    return [
        (i, rng.choices(sources, range(1, len(sources) + 1))[0], rng.choice(["en", None]), rng.choice([0, 7, None]), rng.choice(texts))
        for i in rng.sample(range(10 * n), n)
    ]


def claim():
    cut = [F.replace(F.col(c), F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in merkle.FIELDS]
    odd = F.crc32(F.col("doc_id").cast("string")) % 2 == 1
    return F.when(odd, merkle.leaf_hash([F.col(c) for c in merkle.FIELDS])).otherwise(merkle.leaf_hash(cut))


@pytest.mark.parametrize(
    "n, sources, height, fanout",
    [(300, [None, "", "a", "é"], 1, 3), (400, [f"s{i}" for i in range(40)], 2, 3), (90, ["x"], 1, 2)],
)
def test_equals_the_plain_tree(spark, n, sources, height, fanout):
    rows = random_rows(n, sources)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = merkle.manifest(docs, claim=claim(), carry=["doc_id"], height=height, fanout=fanout).collect()
    expected = plain_manifest(rows, fanout)
    assert len(found) == n
    for r in found:
        assert (r.leaf, r.subroot, r.root, r.proof, r.folded_root) == expected[r.doc_id]
        assert r.verified == (r.folded_root == r.root)
    assert 0 < sum(r.verified for r in found) < n


@pytest.mark.parametrize("many", [1, 4, 10, 28])
def test_every_block_gets_the_whole_path(spark, many):
    nodes = [sha(str(i)) for i in range(many)]
    blocks = settle(spark.createDataFrame([(5, i, many, x) for i, x in enumerate(nodes)], "tree long, block long, n long, node string"))
    root, paths = plain_tree(nodes, 3)
    found = merkle.butterfly(blocks, height=0).collect()
    assert sorted((r.block, r.node, tuple(r.path)) for r in found) == [
        (i, root, tuple(x for before, after in p for x in before + after)) for i, p in enumerate(paths)
    ]


def test_defined_cases(spark):
    clash = {c: F.lit(f"own {c}") for c in ("leaf", "tree", "block", "at", "n", "claim", "_carried", "_source", "node", "path")}
    rows = [(1, "a", "en", 1, "same"), (1, "a", "en", 1, "same"), (None, "a", None, None, None), (2, None, "en", 3, "x" * 300_000), (1, "a", "en", 1, "other")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns(clash).repartition(3)
    found = merkle.manifest(docs, height=1).collect()
    assert len(found) == 5 and all(r.verified for r in found) and len({r.root for r in found}) == 1
    assert {r["path"] for r in found} == {"own path"} and {r["tree"] for r in found} == {"own tree"}
    assert all(len(r.leaf) == 64 for r in found)
    lone = next(r for r in found if r.doc_id == 2)
    assert lone.subroot == lone.leaf == plain_leaf(*rows[3])
    ordered = sorted([plain_leaf(*r) for r in rows if r[0] == 1])
    subroot, _ = plain_tree([plain_leaf(*rows[2]), *ordered], 3)
    assert {r.subroot for r in found if r.doc_id != 2} == {subroot}
    assert {r.root for r in found} == {sha(lone.leaf, subroot)}


def test_one_row_and_none(spark):
    one = merkle.manifest(spark.createDataFrame([(7, "a", "en", 1, "t")], SCHEMA)).collect()[0]
    assert one.leaf == one.subroot == one.root == one.folded_root and one.proof == [] and one.verified
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    got = merkle.op13_merkle(spark, folder)
    want = db.sql(merkle.SQL)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
    assert 0 < got.where("verified").count() < got.count()
