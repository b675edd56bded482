"""Every operator on null, empty, long and repeated rows, on empty tables, and with clashing extra columns."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cartsight.llm import bpe, chat, licences, linecrf, machine, mixing, passages, ppm, simhash, trie

CLASHES = ("ids", "kept", "score", "component_id", "_row", "_id", "_text", "_sha", "_carried", "block", "size", "n_words", "decoded")
WORDS = " ".join(f"word{i % 700} thing{i % 13}." for i in range(30_000))
ROWS = [
    (1, "Some plain words, twice. " * 30, "en", "a", 0),
    (1, "Some plain words, twice. " * 30, "en", "a", 0),
    (2, None, None, None, None),
    (3, "", "en", "b", 0),
    (4, " \n\t ", "en", "b", 4),
    (5, WORDS, "en", "a", 1),
    (6, WORDS, "de", None, 1),
    (7, "x" * 300_000, "de", "", 1),
    (None, "no id here", "en", "a", 1),
    (8, "é中\U0001f600 \x1c\x85 | # !! <|im_end|>", "fr", "c", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows=ROWS):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHES}).repartition(3)


def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (8, 0, None), (None, 1, 0), (5, None, 0), (99, 0, 0)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "bpe": lambda s, d: bpe.round_trip(d),
    "lines": lambda s, d: linecrf.judge(d, linecrf.train(d, labels(s))),
    "machine": lambda s, d: machine.score(d, machine.train(d, labels(s))),
    "trie": lambda s, d: trie.exact_groups(d),
    "simhash": lambda s, d: simhash.near_groups(d),
    "mixing": lambda s, d: mixing.mix(d),
    "ppm": lambda s, d: ppm.score_documents(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_has_one_result(spark, name):
    out = OPERATORS[name](spark, documents(spark)).collect()
    ids = sorted((r["doc_id"] for r in out), key=lambda x: (x is None, x))
    assert ids == [1, 1, 2, 3, 4, 5, 6, 7, 8, None]
    if name != "ppm":
        assert {r["_text"] for r in out} == {"own _text"}


@pytest.mark.parametrize("name", [*OPERATORS, "passages", "licences"])
def test_empty_table(spark, name):
    every = {**OPERATORS, "passages": lambda s, d: passages.repeated_passages(d), "licences": lambda s, d: licences.scan(d)}
    assert every[name](spark, documents(spark, [])).collect() == []


def test_empty_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digest_turns(chat.format_turns(none)).collect() == []


def test_pair_operators_skip_rows_without_content(spark):
    found = {(r.doc_id, r.partner_id) for r in passages.repeated_passages(documents(spark)).collect()}
    assert found == {(6, 5)}
    assert licences.scan(documents(spark)).collect() == []


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:-1]], ids=[n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_the_columns(spark, stage, tmp_path):
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    docs = documents(spark)
    for given in (docs, docs.where("false")):
        out = stage(spark, given, str(tmp_path))
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        assert all(r["kept"] == "own kept" for r in out.collect())


def test_repeated_rows_leave_one(spark):
    rows = trie.exact_groups(documents(spark)).collect()
    assert sum(r["kept"] for r in rows if r["doc_id"] == 1) == 1
    assert all(r["keep_id"] == 1 and r["group_size"] == 2 for r in rows if r["doc_id"] == 1)
    empty = [r for r in rows if r["doc_id"] in (2, 3, 4)]
    assert {r["group_size"] for r in empty} == {3} and [r["doc_id"] for r in empty if r["kept"]] == [4]
    assert {r["text_sha256"] for r in empty} == {hashlib.sha256(b"").hexdigest()}
    near = simhash.near_groups(documents(spark)).collect()
    assert sum(r["kept"] for r in near if r["doc_id"] == 1) == 1


def test_null_id_sorts_last(spark):
    rows = spark.createDataFrame([(None, "same text"), (7, "same  text")], "doc_id long, text string")
    assert {(r.keep_id, r.kept) for r in trie.exact_groups(rows.withColumn("text", F.trim("text"))).collect()} == {(7, True), (7, False)}
    assert {(r.component_id, r.kept) for r in simhash.near_groups(rows).collect()} == {(7, True), (7, False)}


def test_conversations_of_odd_rows(spark):
    """Null text, role and id, tied and repeated turns, a null turn, a long text, and columns named like results."""
    long = "x <|im_end|> " * 20_000
    rows = [
        (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "assistant", "z"), (1, 1, "assistant", None), (1, 1, "assistant", None),
        (2, None, "user", "first"), (2, 0, None, "second"), (3, 0, "assistant", long), (None, 0, "user", "u"), (None, 1, "assistant", "é"),
    ]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    given = given.withColumns({c: F.lit("own") for c in ("segment", "loss", "start", "n_turns", "rewrites")}).repartition(3)
    got = {r.conv_id: r for r in chat.digest_turns(chat.format_turns(given)).collect()}
    order = {
        1: [("assistant", "z"), ("user", "a"), ("user", "b"), ("assistant", ""), ("assistant", "")],
        2: [("user", "first"), ("", "second")],
        3: [("assistant", long)],
        None: [("user", "u"), ("assistant", "é")],
    }
    assert set(got) == set(order)
    for i, turns in order.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        assert got[i].n_turns == len(turns) and got[i].rewritten_turns == 0
        assert got[i].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[i].loss_chars, got[i].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
