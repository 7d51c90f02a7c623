import os

import pytest
from oracle import DATA, compare, connect

from lexispark.plans.registry import core_oracle, core_queries
from lexispark.session import load

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect()


@pytest.mark.parametrize("name", sorted(core_oracle()))
def test_query_equals_its_sql(spark, con, name):
    compare(spark, con, core_queries()[name], core_oracle()[name])


def test_queries_without_sql_are_those_tested_by_brute_force():
    assert set(core_queries()) - set(core_oracle()) == {"bigram_matches", "close_matches", "page_headwords", "segment_pages", "simple_entries", "events_hourly", "events_sessions"} - set(core_oracle())


def test_close_and_bigram_matches_hold_on_the_tables(spark):
    words = {r[0] for r in load(spark, DATA, "v2_entry").select("lemma_sort").collect()}
    known = {r[0] for r in load(spark, DATA, "ls_entries").select("lemma").collect()}
    rows = core_queries()["close_matches"](spark, DATA).collect()
    assert rows and all(r.q in words and r.w in known and 0.7 <= r.ratio <= 1 and 1 <= r["rank"] <= 3 for r in rows)
    assert {r.q for r in rows if r.ratio == 1} == words & known - {""}
    pairs = core_queries()["bigram_matches"](spark, DATA)
    assert pairs.count() == pairs.distinct().count() > 0 and pairs.where("ratio < 0.5 OR ratio > 1 OR (distance = 0) != (ratio = 1)").where("distance = 0").count() == 0


def test_entries_read_off_pages(spark):
    rows = core_queries()["simple_entries"](spark, DATA).collect()
    assert len(rows) > 50 and all(r.lema and "\n" not in r.definicao for r in rows)
    pages = load(spark, DATA, "ocr_page").where("page_num IS NOT NULL").select("doc_name", "page_num").distinct().count()
    heads = core_queries()["page_headwords"](spark, DATA)
    assert 0 < heads.select("key").distinct().count() <= pages and heads.count() == heads.distinct().count()


def test_segments_keep_all_text_in_order(spark):
    rows = core_queries()["segment_pages"](spark, DATA).collect()
    assert rows and len({(r.doc, r.ordinal) for r in rows}) == len(rows) and all(r.entry.strip() for r in rows)
    for doc in {r.doc for r in rows}:
        ordinals = sorted(r.ordinal for r in rows if r.doc == doc)
        assert ordinals == list(range(ordinals[0], ordinals[0] + len(ordinals))) and ordinals[0] in (0, 1)
