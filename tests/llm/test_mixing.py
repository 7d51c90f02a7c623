import os
import random

import pytest

from lexispark.llm import mixing
from lexispark.llm.mixing import TOKENIZER, Mix

pytestmark = pytest.mark.skipif(not os.path.exists(TOKENIZER), reason="no tokenizer file")
DOCS, TARGETS = "doc_id bigint, text string, source string, n_tokens bigint, p string", "source string, target_share double, max_repeat int, rate double"


def table(spark, spec):
    rows, i = [], 0
    for source, n, words in spec:
        for _ in range(n):
            rows.append((i, f"{words} numero {i} " * 3, source, 0, "clash"))
            i += 1
    return spark.createDataFrame(rows, DOCS)


def test_shares_meet_targets_within_repeats(spark):
    docs = table(spark, [("a", 1500, "navio do rio"), ("b", 600, "neve do inverno"), ("c", 200, "porto e vento"), ("other", 50, "nada disso")])
    mix = Mix(docs, spark.createDataFrame([("a", 0.5, 1, 0.0), ("b", 0.3, 2, 0.0), ("c", 0.18, 3, 0.0), ("none", 0.02, 4, 0.0)], TARGETS))
    report = {r.source: r for r in mix.report().collect()}
    for s, share in (("a", 0.5), ("b", 0.3), ("c", 0.18)):
        assert abs(report[s].actual_share - share / 0.98) < 0.02
        assert report[s].reachable
    assert not report["none"].reachable and report["none"].actual_share == 0
    assert report["other"].docs_drawn == 0
    assert max(r.copies for r in mix.copies().where("source = 'c'").collect()) <= 3
    assert max(r.copies for r in mix.copies().where("source = 'a'").collect()) == 1


def test_total_too_large_is_reported_as_unreachable(spark):
    docs = table(spark, [("a", 100, "navio"), ("b", 10, "neve")])
    mix = Mix(docs, spark.createDataFrame([("a", 0.5, 1, 0.0), ("b", 0.5, 2, 0.0)], TARGETS), total_tokens=1500)
    report = {r.source: r for r in mix.report().collect()}
    assert report["a"].reachable and not report["b"].reachable
    assert {r.copies for r in mix.copies().where("source = 'b'").collect()} == {2}


def test_unlabelled_documents_count_by_membership(spark):
    docs = table(spark, [("a", 300, "navio rio porto vento mar"), ("b", 300, "lei contrato juiz sentença tribunal"), (None, 100, "juiz tribunal contrato lei sentença")])
    mix = Mix(docs, spark.createDataFrame([("a", 0.5, 1, 0.0), ("b", 0.5, 1, 0.0)], TARGETS))
    soft = mix.soft.collect()
    assert all(r.p[mix.names.index("b")] > 0.9 for r in soft)
    report = {r.source: r for r in mix.report().collect()}
    assert abs(report["a"].actual_share - 0.5) < 0.03
    assert mix.copies().where("source IS NULL").count() > 0


def test_nulls_empty_and_repeats(spark):
    docs = spark.createDataFrame([(None, "x", "a", 0, ""), (1, None, "a", 0, ""), (2, "", "a", 0, ""), (3, "um navio", "a", 0, ""), (4, "um porto", None, 0, "")], DOCS)
    targets = spark.createDataFrame([("a", 1.0, 1, 0.0), (None, 0.5, 1, 0.0), ("a", 1.0, 1, 0.0)], TARGETS)
    assert {r.doc_id for r in Mix(docs, targets).copies().collect()} <= {3, 4}
    assert Mix(docs.limit(0), targets).copies().count() == 0
    assert Mix(docs, targets.limit(0)).copies().count() == 0


def test_small_targets_and_unlabelled_documents_outlast_many_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_SOURCES", 3)
    docs = table(spark, [("z", 30, "neve inverno frio"), (None, 5, "neve inverno frio")] + [(f"s{i}", 100 + i, "navio do rio e do porto") for i in range(6)])
    mix = Mix(docs, spark.createDataFrame([("z", 0.5, 1, 0.0), ("s5", 0.5, 1, 0.0)], TARGETS))
    report = {r.source: r for r in mix.report().collect()}
    assert report["z"].docs_available == 30 and report["z"].docs_drawn > 0
    assert {s: r.docs_available for s, r in report.items()} == {"z": 30, "s5": 105, "s4": 104, "(other sources)": 406}
    assert report["(other sources)"].docs_drawn < 1 and report["(other sources)"].target_share == 0
    assert mix.soft.count() == 5 and mix.copies().where("source IS NULL").count() > 0
    assert abs(report["z"].actual_share - 0.5) < 0.1


def test_posteriors_hold_on_documents_not_seen(spark):
    """Sources that differ in words, or only in form, are told apart on documents the classifier has not seen."""
    rng = random.Random(2)
    vocab = ["navio", "rio", "porto", "vento", "lei", "juiz", "neve", "casa"]
    text = lambda words, form: form([rng.choice(words) for _ in range(rng.randint(20, 40))])
    line = lambda w: " ".join(w) + "."
    listed = lambda w: ";\n".join(w)
    for made in ([("a", vocab[:4], line), ("b", vocab[4:], line)], [("a", vocab, line), ("b", vocab, listed)]):
        rows = [(i, s, text(w, f)) for i in range(300) for s, w, f in made]
        df = spark.createDataFrame([(i * 2 + (s == "b"), s, t) for i, s, t in rows], "doc_id bigint, source string, text string")
        n, hit, own = mixing.source_model(df, ["a", "b"], 600)[1]
        assert n > 50 and hit > 0.95 and own > 0.9


def test_sample_of_labelled_documents_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FIT_ROWS", 100)
    docs = table(spark, [("a", 3000, "navio rio porto"), ("b", 3000, "lei contrato juiz"), (None, 5, "juiz lei")])
    mix = Mix(docs, spark.createDataFrame([("a", 0.5, 1, 0.0), ("b", 0.5, 1, 0.0)], TARGETS))
    assert 5 <= mix.quality[0] <= 50 and mix.soft.count() == 5
