import json
import os

from pyspark.sql import functions as F

from lexispark.operators import dedupe, listing, publish, segment
from lexispark.sources import readers, writers


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_filters_and_orders(spark):
    df = spark.createDataFrame([(1, "Abē", "conf:high"), (2, "abē", " HIGH "), (3, "ABĒ", "low"), (4, None, None)], "id int, l string, conf string")
    assert [r.id for r in df.where("l IS NOT NULL").orderBy(listing.nocase(F.col("l")), "id").collect()] == [3, 1, 2]  # only ASCII letters lose their case
    assert {r.id for r in listing.rated(df, "conf", "high", "id", 9).collect()} == {1, 2} and listing.rated(df, "conf", None, "id", 2).count() == 2
    a, b = (sorted(r.id for r in listing.random_sample(df.repartition(n), "id", 2, 3).collect()) for n in (1, 4))
    assert a == b and len(a) == 2
    assert one(spark, listing.quoted_term(F.lit("x 'Abē' y"), "abe"), listing.quoted_term(F.lit("abe"), "abe"), listing.exact_or_listed(F.lit("Abe, abi"), "abe"), listing.exact_or_listed(F.lit("aber"), "abe")) == (True, False, True, False)
    assert df.where(listing.in_fields(["l", "conf"], "HIGH")).count() == 2 and df.where(listing.any_of(F.col("l"), ["abē"])).count() == 3
    assert listing.csv_ids("1,2;3, ,;") == [1, 2, 3]


def test_prefix_tier_answers_only_what_is_open(spark):
    e = spark.createDataFrame([("abc", "x", 1), ("abcd", "abc", 2), ("zzq", "zz", 3), (None, None, 4)], "s string, l string, o int")
    w = spark.createDataFrame([("w1", "abc"), ("w2", "zz"), ("w3", "abcd"), ("w4", "ab"), ("w5", "zzq"), ("w6", "abx"), ("w7", None)], "k string, w string")
    got = {r.k: (r.tier, r.o) for r in listing.best_with_prefixes(w, "k", "w", e, ["s", "l"], "s", ["o"]).collect()}
    assert got == {"w1": (0, 1), "w2": (1, 3), "w3": (0, 2), "w5": (0, 3)}
    only = {r.k: (r.tier, r.o) for r in listing.best_with_prefixes(w, "k", "w", e.where("o = 2"), ["s"], "s", ["o"]).collect()}
    assert only == {"w1": (1, 2), "w3": (0, 2)}


def test_pages_are_clamped_and_sorted_inside(spark):
    df = spark.createDataFrame([(i, f"n{9 - i % 10}") for i in range(25)], "id int, name string")
    first, last = (listing.result_page(df, ["id"], p, 10, F.col("name")).collect() for p in (0, 7))
    assert [r.page for r in first] == [1] * 10 and sorted(r.id for r in first) == list(range(10)) and [r.name for r in first] == sorted(r.name for r in first)
    assert [r.page for r in last] == [3] * 5 and listing.result_page(df.limit(0), ["id"], 3, 10, F.col("name")).count() == 0
    assert listing.shown(df, None, 5).count() == 5 and listing.shown(df, "x", 5).count() == 25


def test_corrections(spark):
    df = spark.createDataFrame([(1, "Abc", "n", "conf:high"), (2, "abc", None, None), (3, "x", "", "low")], "id int, lemma string, notas string, conf string")
    fixes = spark.createDataFrame([(1, "abd", None, "conf:med"), (2, "abd", "por LS", "conf:med")], "id int, new_lemma string, reason string, conf string")
    got = {r.id: (r.lemma, r.notas, r.conf) for r in listing.ocr_fix(df, fixes, "id", "T").collect()}
    assert got == {1: ("abd", "n | [ocr_fix T] auto | lemma_in='Abc' → 'abd'", "conf:high"), 2: ("abd", "[ocr_fix T] por LS | lemma_in='abc' → 'abd'", "conf:med"), 3: ("x", "", "low")}
    e = spark.createDataFrame([(1, "Roma", "s.", "conf:low"), (2, "roma", None, None), (3, "ABC", None, None)], "entry_id bigint, lemma string, label string, conf string")
    t = spark.createDataFrame([("a", 1, "roma", "romae", "", "conf:med", False), ("a", 2, "roma", "romae", "", "x", False), ("b", 3, "abc", "abd", "m", "conf:high", False), ("c", 1, "roma", "romae", "", "", True)], "suggestion_id string, entry_id bigint, lemma_in string, new_lemma string, reason string, conf string, by_id boolean")
    u = {(r.suggestion_id, r.entry_id): r for r in listing.suggestion_updates(t, e, "T").collect()}
    assert u["a", 1].status == "REVIEW" and u["a", 1].payload is None and u["c", 1].new_lemma == "Romae" and u["b", 3].new_lemma == "ABD"
    assert json.loads(u["b", 3].payload) == {"action": "UPDATE", "id": 3, "old_lemma": "ABC", "new_lemma": "ABD", "conf_set": "conf:high", "def_changed": False, "note": "[ocr_fix T] m | lemma_in='abc' → 'abd'"}


def test_headwords_and_abbreviations(spark):
    head = lambda s: one(spark, segment.headword_list(F.lit(s)))[0]
    assert head("2. abeo, abis, abire v.intr. sair") == ["abeo", "abis", "abire"] and head("abeo, abis — sair") == ["abeo", "abis"] and head("amor, -oris — m. amor") == ["amor, -oris"] and head("casa") == ["casa"]
    run = lambda s: one(spark, segment.abbreviation_run(F.lit(s)))[0]
    assert run("adv. comp. mais adj.") == ["adv.", "comp."] and run("adj. m.") == ["adj.", "m."] and run("mais") == []
    text = "resto\nAbeo, -is, -ire. Sair\nde casa.\n2. casa, -ae. Morada"
    got = one(spark, segment.simple_entries(F.lit(text)))[0]
    assert [(x.number, x.lema, x.formas, x.definicao) for x in got] == [("", "Abeo", "-is, -ire", "Sair de casa."), ("2.", "casa", "-ae", "Morada")]
    chunk = "navis, -is\numa linha\nnavix, x\nporta, y\n" + "-" * 40 + "\nportus\nportux mar"
    known = spark.createDataFrame([("navis",), ("porta",), ("portus",), ("zebra",)], "w string")
    got = {r.headword for r in segment.chunk_headwords(spark.createDataFrame([("c", chunk), ("d", None)], "k string, t string"), "k", "t", known).collect()}
    assert {"navis", "portus", "porta"} <= got and "zebra" not in got


def test_homonym_labels_and_counts(spark):
    df = spark.createDataFrame([("k", i) for i in range(7)] + [("o", 1), ("o", 2)], "k string, i int")
    gated = spark.createDataFrame([("k", "AUTO_HOMONYMS_KEEP"), ("o", "REVIEW")], "key string, gate string")
    assert {r.i: r.canonical_group for r in dedupe.homonyms(df, "k", "i", gated).collect()} == {0: "I", 1: "II", 2: "III", 3: "IV", 4: "V", 5: "V", 6: "V"}
    v = spark.createDataFrame([("g", "keep", None, True), ("g", "redirect", None, True), ("h", "manual", "manual_skipped", False), ("i", "drop", "unknown_action:drop", False)], "group_id string, action string, reason string, valid boolean")
    assert tuple(dedupe.decision_counts(v).first()) == (1, 1, 1, 1, 2)


def test_documents_vectors_and_backups(spark, tmp_path):
    df = spark.createDataFrame([(2, "b", [3.0, 4.0]), (1, 'a "q"', [0.0, 0.0]), (3, None, None)], "id int, t string, v array<double>")
    writers.json_document(df.drop("v"), "x", f"{tmp_path}/doc", "T", "id")
    parts = sorted(os.path.join(r, f) for r, _, fs in os.walk(f"{tmp_path}/doc") for f in fs if not f.startswith((".", "_")))
    whole = json.loads("".join(open(p).read() for p in parts))
    assert whole == {"metadata": {"tipo": "x", "exportado_em": "T", "total_entradas": 3}, "entradas": [{"id": 1, "t": 'a "q"'}, {"id": 2, "t": "b"}, {"id": 3, "t": None}]}
    writers.write_vectors(df, "id", "v", f"{tmp_path}/vectors")
    assert {(r.vector_id, r.id, tuple(r.v)) for r in readers.vector_index(spark, f"{tmp_path}/vectors").collect()} == {(0, 1, (0.0, 0.0)), (1, 2, (0.6, 0.8))}
    df.write.parquet(f"{tmp_path}/base.parquet")
    kept = writers.backup(spark, f"{tmp_path}/base.parquet", f"{tmp_path}/backups", "20240101-000000")
    assert kept.endswith("backups/base.20240101-000000.parquet") and spark.read.parquet(kept).count() == 3
    writers.export_entry(df.where("id = 2").withColumnRenamed("v", "exemplos"), f"{tmp_path}/one", "csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/one").columns == ["id", "t"]


def test_unified_export(spark):
    a = spark.createDataFrame([("Abc", "um"), ("abd", None), (None, "x")], "lemma string, body string")
    b = spark.createDataFrame([("Abc", "one"), ("Abc", "two"), ("zz", "three")], "lemma string, body string")
    got = [r.text for r in publish.unified({"pt": a, "en": b}).orderBy("rn").collect()]
    assert got == ["**Abc**\n- *pt*: um\n- *en*: one / two", "**abd**\n- *pt*: ", "**zz**\n- *en*: three"]


def test_candidates_merge_in_order():
    """Worked by hand: window of initials, unknown words, misread numbers, abbreviations, lines without grammar."""
    c = [("resto sem nada", False, False), ("abeo, is, v.", True, False), ("zonu, us, s. m.", False, False), ("abies, ae, s. f.", False, False), ("navis, is, s. f.", True, False), ("l. abrumpo, v.", False, True), ("adj. masc. x, n.", False, False), ("daí: v. n.", False, False), ("naufragus, adj. x", False, False), ("acer, puro texto longo", True, False)]
    pieces, window = segment.merge_candidates(c)
    assert pieces == [
        (False, "resto sem nada"), (True, "abeo, is, v.\nzonu, us, s. m."), (True, "abies, ae, s. f.\nnavis, is, s. f."), (True, "abrumpo, v.\nadj. masc. x, n.\ndaí: v. n."), (True, "naufragus, adj. x\nacer, puro texto longo"),
    ]
    assert window == "aanan"
    for at in range(len(c)):
        first, carried = segment.merge_candidates(c[:at])
        rest, end = segment.merge_candidates(c[at:], carried)
        joined = [t for _, t in first]
        for opens, t in rest:
            if opens or not joined:
                joined.append(t)
            else:
                joined[-1] += "\n" + t
        assert joined == [t for _, t in pieces] and end == window
