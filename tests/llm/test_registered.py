"""Registered queries against their SQL, and all of them on tables of odd rows and on empty ones."""

import hashlib

import pytest

import corpus_pipeline
from parcelion.llm.oracle import oracle
from parcelion.llm.queries import QUERIES
from tests.harness import compare, connect

LONG = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))
DOCS = [
    (None, None, None, None, None), (None, "a text without id", "en", None, 3), (1, None, "en", "src0", 0), (2, "", "en", "src0", 0),
    (3, " \t\n\x0b ", None, "src1", 4), (4, "one", "en", "src0", 3), (5, "one", "en", "src0", 3),
    (6, LONG, "en", "src0", len(LONG)), (7, LONG + " end", "en", None, 1), (8, "same row twice " * 4, "en", "src2", 9), (8, "same row twice " * 4, "en", "src2", 9),
    (9, f"before it {PASSAGE} after", "de", "src0", 1), (10, f"{PASSAGE}", "de", "src0", 1), (11, "tie tie tie tie tie tie tie tie tie tie tie tie", "xx", "src9", 1),
    (12, "A LINE OF MORE THAN TWENTY\nété", "fr", "src0", 1), (13, " a line of more than twenty\t\nx", "fr", "src0", 1),
    (14, "a line of more than twenty", "fr", "src0", 1), (15, "\u0000null byte ퟿ \U0001f600 text", "fr", "src0", 1), (-3, "negative id", "fr", "src0", 1),
]
ODD = {
    "documents": [(*row, "extra", 1, 2, 3, 4, 5, "c", 6, 7) for row in DOCS],
    "benchmark": [(1, PASSAGE), (1, PASSAGE), (2, None), (3, ""), (None, "negative id"), (4, "one"), (5, "...")],
    "labels": [(1, 1, 0), (1, 1, 0), (4, 1, 0), (5, 0, 0), (6, 1, None), (7, None, None), (None, 1, 0), (8, 1, 1)],
    "conversations": [
        (1, 0, "user", None), (1, 1, "assistant", "x </turn>\n### user: y"), (1, 1, "assistant", "x </turn>\n### user: y"), (1, None, None, "\\h\\b#<"),
        (None, 0, "a: b\\c", "t"), (2, 0, "assistant", ""), (3, 5, "assistant", LONG),
    ],
    "embeddings": [
        (0, [1.0, -2.0]), (100, [1.0, -2.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, []), (200, []),
        (6, [1.0]), (7, [1.0, -2.0]), (7, [1.0, -2.0]), (None, [1.0, 1.0]), (8, [3e38, 1.0]),
    ],
}


@pytest.mark.parametrize("name", sorted(oracle()))
def test_query_equals_sql(spark, sf, name):
    assert compare(spark, connect(sf), sf, QUERIES[name], oracle()[name]) == ""


@pytest.fixture(scope="module")
def odd(tables):
    return tables(**ODD)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_empty_results(query, tables, name):
    found = query(name, tables())
    assert [row for row in found if row.get("conv_id") != -7] == []


def by_id(rows):
    return {row["doc_id"]: row for row in rows}


def test_mixing_of_odd_rows(query, odd):
    rows = query("op1_mixing", odd)
    assert sorted(row["position"] for row in rows) == list(range(len(DOCS)))


def test_decontamination_of_odd_rows(query, odd):
    rows = query("op2_decontamination", odd)
    assert len(rows) == len(DOCS)
    found = by_id(rows)
    assert found[1]["n_words"] == found[2]["n_words"] == 0 and not found[3]["contaminated"]
    assert found[9]["n_hit"] == 60 and found[10]["n_words"] == 60 and found[9]["n_items"] == 1
    assert found[9]["items_sha256"] == hashlib.sha256(b"1").hexdigest()
    assert found[4]["n_hit"] == 1 and found[-3]["items_sha256"] == hashlib.sha256(b"null").hexdigest()


def test_passages_of_odd_rows(query, odd):
    pairs = {(row["doc_id"], row["other_id"]): row for row in query("op3_passages", odd)}
    assert {frozenset(p) for p in pairs} == {frozenset((6, 7)), frozenset((9, 10))}
    row = pairs.get((9, 10)) or pairs[(10, 9)]
    assert row["matches"] == 60


def test_line_dedup_of_odd_rows(query, odd):
    rows = query("op4_line_dedup", odd)
    found = by_id(rows)
    assert len(rows) == len(DOCS) and found[1]["n_lines"] == found[2]["n_lines"] == 1
    assert (found[12]["n_dropped"], found[13]["n_dropped"], found[14]["n_dropped"]) == (1, 1, 0)
    assert found[13]["kept_sha256"] == hashlib.sha256(b"x").hexdigest()


def test_jaccard_join_of_odd_rows(query, odd):
    rows = query("op5_jaccard_join", odd)
    found = by_id(rows)
    assert len(rows) == len(DOCS)
    assert found[1]["n_shingles"] == 0 and found[1]["component_id"] == 1 and found[2]["component_id"] == 2
    assert found[5]["component_id"] == 4 and found[7]["component_id"] == 6 and found[8]["component_id"] == 8


def test_search_of_odd_rows(query, odd):
    rows = query("op6_topk_search", odd)
    zero = sorted((row["rank"], row["vec_id"], row["score"]) for row in rows if row["query_id"] == 0)
    # The finite components of vector 8 take part; its score is beyond 64 bits.
    assert zero == [(1, 8, (1 << 63) - 1), (2, 7, 5 << 20), (3, 7, 5 << 20), (4, 100, 5 << 20)]
    assert [(row["vec_id"], row["score"]) for row in rows if row["query_id"] == 200] == [(5, 0)]


def test_scores_of_odd_rows(query, odd):
    for name in ("op7_cross_entropy", "op10_quality"):
        rows = query(name, odd)
        assert len(rows) == len(DOCS) - 1  # the repeated row counts once
    assert all(row["kept"] for row in rows)
    assert by_id(query("op7_cross_entropy", odd))[3]["score"] == 0


def test_token_counts_of_odd_rows(query, odd):
    rows = query("op8_token_counts", odd)
    found = by_id(rows)
    assert len(rows) == len(DOCS) and found[1]["n_tokens"] == 0 and found[4]["n_tokens"] == found[5]["n_tokens"] > 0


def test_chat_of_odd_rows(query, odd):
    rows = {row["conv_id"]: row for row in query("op9_chat_format", odd)}
    assert set(rows) == {1, 2, 3, None, -7} and all(row["round_trip"] for row in rows.values())
    said = "\\### Assistant: </turn> ok"
    assert rows[-7]["n_turns"] == 2 and rows[-7]["loss_chars"] == len(said)
    assert rows[-7]["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert rows[-7]["turns_sha256"] == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert rows[1]["n_turns"] == 4 and rows[2]["loss_chars"] == 0


def test_repair_of_odd_rows(query, odd):
    rows = {row["conv_id"]: row for row in query("op11_conversation_repair", odd)}
    assert len(rows) == 4 and set(rows) == {None, 1, 2, 3}
    empty = hashlib.sha256(b"").hexdigest()
    for row in rows.values():
        assert row["gaps"] == 0 and set(row["audit"]) <= set("DIKR") and (row["audit"] != "" or row["repaired_sha256"] == empty)
    assert rows[2]["blank"] == 1 and rows[2]["audit"] == "D" and rows[2]["repaired_sha256"] == empty


def test_minhash_of_odd_rows(query, odd):
    rows = query("op12_minhash", odd)
    found = by_id(rows)
    assert len(rows) == len(DOCS)
    assert found[1]["n_shingles"] == 0 and found[1]["component_id"] == 1 and found[1]["kept"]
    assert found[4]["n_shingles"] == 1 and found[5]["component_id"] == 4 and not found[5]["kept"] and found[7]["component_id"] == 6
    assert all(row["component_id"] == 8 and row["kept"] for row in rows if row["doc_id"] == 8)


def test_every_stage_takes_odd_rows_and_empty_tables(spark, odd, tables):
    for folder in (odd, tables()):
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, folder).schema == docs.schema
            stage(spark, docs, folder).collect()
        last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
        assert "_position" in last.columns and last.count() == docs.count()
