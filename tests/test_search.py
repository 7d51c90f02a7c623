import math
import sqlite3

import pytest
from pyspark.sql import functions as F

from lexispark import session
from lexispark.operators.search import index_of, open_index, parse_query, postings, search, search_index, snippet, tokens, update_index, write_index

ROWS = [(1, "O navio do rio, e o Navio.", "mar"), (2, "Porto e navio: o rio leva o navio ao porto.", None), (3, "A cerimônia da neve", "navio"), (4, None, None), (5, "navios navegam; rio", "rio"), (6, "", "x")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "id int, a string, b string")


@pytest.fixture(scope="module")
def index(spark, docs, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("index"))
    write_index(docs, "id", ["a", "b"], folder)
    return open_index(spark, folder, ["a", "b"])


@pytest.mark.parametrize(
    "query",
    ["navio", "navio rio", "navio AND rio", "navio OR neve", "navio NOT porto", "(navio OR neve) NOT rio", "nav*", '"o navio"', "o + navio", "NEAR(navio porto, 2)", "NEAR(rio navio, 1)", "b : navio", "a : (navio OR neve)", "^o", "cerimonia", '"rio leva" OR mar'],
)
def test_matches_and_scores_equal_an_fts5_table(docs, index, query):
    db = sqlite3.connect(":memory:")
    db.execute("CREATE VIRTUAL TABLE t USING fts5(a, b, tokenize='unicode61 remove_diacritics 2')")
    db.executemany("INSERT INTO t(rowid, a, b) VALUES (?, ?, ?)", ROWS)
    want = {r[0]: r[1] for r in db.execute("SELECT rowid, bm25(t) FROM t WHERE t MATCH ?", (query,))}
    scanned = {r.id: r.score for r in search(docs, query, ["a", "b"], ["id"]).collect()}
    looked_up = {r.doc: r.score for r in search_index(index, query).collect()}
    for got in (scanned, looked_up):
        assert set(got) == set(want)
        for k, v in want.items():
            assert math.isclose(got[k], v, abs_tol=2e-6)


def test_index_reads_only_postings_of_the_terms(index):
    plan = search_index(index, "navio OR nev*")._jdf.queryExecution().toString()
    assert "EqualTo(term,navio)" in plan and "StringStartsWith(term,nev)" in plan and "PushedFilters" in plan


def test_index_of_an_empty_table(spark, docs, tmp_path):
    write_index(docs.limit(0), "id", ["a", "b"], str(tmp_path))
    assert search_index(open_index(spark, str(tmp_path), ["a", "b"]), "navio").count() == 0


@pytest.mark.parametrize("bad", ["(navio", "navio AND", "NEAR(a b", "OR x", '"abc'])
def test_bad_queries_are_refused(bad):
    with pytest.raises(ValueError):
        parse_query(bad)


def test_tokens_postings_and_snippet(spark, docs):
    assert docs.where("id = 3").select(tokens(F.col("a"))).first()[0] == ["a", "cerimonia", "da", "neve"]
    p = {(r.term, r.doc, r.col, r.pos) for r in postings(docs, "id", ["a", "b"]).collect()}
    assert ("navio", 2, "a", 2) in p and ("rio", 5, "b", 0) in p
    text = " ".join(f"w{i}" for i in range(40)) + " Cerimônia fim"
    got = spark.range(1).select(snippet(F.lit(text), ["cerimonia"])).first()[0]
    assert got.startswith("…w30") and got.endswith("[Cerimônia] fim")
    assert spark.range(1).select(snippet(F.lit(None).cast("string"), ["x"])).first()[0] == ""


def test_updated_index_equals_a_new_one(spark, docs, tmp_path):
    write_index(docs, "id", ["a", "b"], f"{tmp_path}/old")
    changed = spark.createDataFrame([(2, "neve e navio", None), (9, "rio navio navio", "mar"), (3, None, None)], "id int, a string, b string")
    deleted = spark.createDataFrame([(5,), (77,)], "id int")
    update_index(spark, f"{tmp_path}/old", changed, deleted, "id", ["a", "b"], f"{tmp_path}/new")
    now = docs.where("id NOT IN (2, 3, 5)").unionByName(changed)
    for query in ("navio", "rio OR neve", "nav* NOT mar"):
        got = {(r.doc, r.score) for r in search_index(open_index(spark, f"{tmp_path}/new", ["a", "b"]), query).collect()}
        assert got == {(r.id, r.score) for r in search(now, query, ["a", "b"], ["id"]).collect()}


def test_index_of_a_table_is_kept_for_the_session_and_made_again_when_gone(docs):
    with session.intermediates():
        first = index_of(docs, "id", ["a"], "docs")
        assert index_of(docs, "id", ["a"], "docs").postings.inputFiles() == first.postings.inputFiles()
        assert search_index(first, "navio").count() == 2
    again = index_of(docs, "id", ["a"], "docs")
    assert search_index(again, "navio").count() == 2 and again.postings.inputFiles() != first.postings.inputFiles()
