import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(__file__)))
from oracle import DATA, compare, connect  # noqa: E402

from lexispark.llm.queries import ORACLE, QUERIES  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
COLUMNS = {
    "p1_found": ["group_id", "definicao_from", "conf_from"], "p3_found": ["tab", "rec_key", "field", "line_no", "kind"], "p4_found": ["tab", "rec_key"], "p7_found": ["entry_id", "ls_id"],
    "p8_found": ["doc_id", "item_id"], "p10_found": ["doc_id"],
}


MAY_BE_EMPTY: set[str] = set()


def table(spark, name):
    return spark.read.parquet(f"{DATA}/{name}.parquet")


@pytest.fixture(scope="module")
def results(spark):
    """All results on the smallest tables, computed once."""
    made = {}

    def get(name):
        if name not in made:
            made[name] = QUERIES[name](spark, DATA).cache()
        return made[name]

    return get


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs_with_the_agreed_columns(results, name):
    df = results(name)
    assert df.columns == COLUMNS.get(name, df.columns)
    n = df.count()
    assert n > 0 or name in MAY_BE_EMPTY
    assert df.distinct().count() == n


def test_groups_and_their_records(spark, results):
    rows = {r.entry_id: r for r in table(spark, "v2_entry").collect()}
    found = results("p1_found").collect()
    assert len({r.group_id for r in found}) == len(found)
    for r in found:
        assert r.group_id in rows and r.conf_from >= r.group_id and (r.definicao_from is None or rows[r.definicao_from].definicao.strip())
    records = {r.group_id: r for r in results("p1_records").collect()}
    assert set(records) == {r.group_id for r in found}
    for r in found:
        kept = records[r.group_id]
        assert (kept.definicao_from, kept.conf_from) == (r.definicao_from, r.conf_from)
        assert kept.conf == rows[r.conf_from].conf and kept.needs_review == rows[r.conf_from].needs_review
        assert kept.definicao == (rows[r.definicao_from].definicao if r.definicao_from else None)


def test_noise_is_gone_from_the_repaired_texts(spark, results):
    found, texts = results("p3_found").collect(), results("p3_texts").collect()
    assert {r.kind for r in found} == {"header", "pagenum", "hyphen", "misread"}
    assert len({(r.tab, r.rec_key, r.field) for r in texts}) == len(texts)
    assert not any("¬" in r.text or "-\n" in r.text for r in texts)
    lines = {(f"{r.doc_name}:{r.page_num}", f): (r[f] or "").split("\n") for r in table(spark, "ocr_page").collect() for f in ("raw_text", "extracted_text")}
    heads = [(r, lines[r.rec_key, r.field][r.line_no - 1].strip()) for r in found if r.tab == "ocr_page" and r.kind == "header"]
    repaired = {(r.rec_key, r.field): r.text for r in texts}
    assert heads and not any(len(h) > 12 and h in repaired.get((r.rec_key, r.field), "") for r, h in heads)


def test_matches_have_confidences_and_are_those_found(results):
    rows = results("p7_matches").collect()
    assert {(r.entry_id, r.ls_id) for r in rows} == {(r.entry_id, r.ls_id) for r in results("p7_found").collect()}
    assert all(0.5 <= r.score <= 1 and 0 <= r.confidence <= 1 for r in rows)


def test_leaks_are_counted_per_item(spark, results):
    found = results("p8_found").collect()
    counts = {i: sum(1 for r in found if r.item_id == i) for i in {r.item_id for r in table(spark, "eval_item").collect()}}
    leaks = results("p8_leaks").collect()
    assert {r.item_id: r.n_docs for r in leaks} == counts and all((r.largest_share is None) == (r.n_docs == 0) for r in leaks)
    # an exact copy of an item is always found
    text = {r.doc_id: " ".join((r.text or "").split()) for r in table(spark, "documents").collect()}
    exact = {(d, r.item_id) for r in table(spark, "eval_item").collect() for d, t in text.items() if " ".join(r.text.split()) in t}
    assert exact <= {(r.doc_id, r.item_id) for r in found}


def test_mix_keeps_repeats_and_reports_what_it_draws(spark, results):
    wanted = {r.source: r for r in table(spark, "mix_target").collect()}
    drawn = results("p9_mix").collect()
    assert all(r.copies <= (wanted[r.source].max_repeat if r.source else max(w.max_repeat for w in wanted.values())) for r in drawn)
    shares = {r.source: r for r in results("p9_shares").collect()}
    assert set(wanted) <= set(shares) and abs(sum(r.actual_share for r in shares.values()) - 1) < 1e-3
    assert all(shares[s].target_share == w.target_share for s, w in wanted.items())


def test_report_counts_the_cut_documents(spark, results):
    found = {r.doc_id for r in results("p10_found").collect()}
    report = results("p10_report").collect()
    docs = table(spark, "documents")
    assert sum(r.n_docs for r in report) == docs.count()
    assert {r.source: r.n_cut for r in report if r.n_cut} == {r.source: r["count"] for r in docs.where(docs.doc_id.isin(list(found))).groupBy("source").count().collect()}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    compare(spark, connect(), QUERIES[name], ORACLE[name])
