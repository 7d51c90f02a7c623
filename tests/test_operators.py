import json
import random
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexispark.operators import dedupe, fuzzy, lookup, patch, publish, vector, windows
from lexispark.plans import lexicon


def test_numbered_equals_a_sort(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(50), i) for i in range(500)]
    got = windows.numbered(spark.createDataFrame(rows, "a int, b int"), ["a", "b"])
    assert [r[:2] for r in sorted(got.collect(), key=lambda r: r.rn)] == sorted(rows)
    assert sorted(r.rn for r in got.collect()) == list(range(1, 501))
    assert windows.numbered(spark.createDataFrame([], "a int, b int"), ["a", "b"]).count() == 0


def test_page_gaps_and_neighbours(spark):
    p = spark.createDataFrame([("d", 3), ("d", 4), ("d", 7), ("d", None), ("e", 1)], "doc string, page int")
    assert {(r.doc, r.page) for r in windows.page_gaps(p, "doc", "page").collect()} == {("d", x) for x in (1, 2, 5, 6)}
    n = windows.neighbours(spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "v string"), ["v"], "v", 2)
    assert {r.v: (r.prev, r.next) for r in n.collect()}["c"] == (["a", "b"], ["d"])


def test_unique_keys_and_proofs(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4)], "k string, x int")
    right = spark.createDataFrame([("a", 9), ("b", 8), (None, 7)], "k string, y int")
    assert [tuple(r) for r in lookup.unique_key_join(left, right, "k").collect()] == [("a", 1, 9)]
    found = lookup.proofs(left, "k", {"s1": right.select("k"), "s2": spark.createDataFrame([("a",)], "k string")})
    assert {r.x: (r.found_count, r.found_where, r.consensus_note) for r in found.collect()} == {1: (2, "s1,s2", "strong"), 2: (1, "s1", "weak"), 3: (1, "s1", "weak"), 4: (0, "", "none")}
    with pytest.raises(ValueError):
        lookup.require_all(left.where("k = 'b'"), right.where("k = 'a'"), "k")
    assert lookup.require_columns(left, {"key": ["lemma", "K"]}) == {"key": "k"}


def test_first_matches_equal_a_capped_join(spark):
    rng = random.Random(6)
    left = spark.createDataFrame([(i, rng.choice(["a", "b", None, "c"]), rng.choice(["x", "y", None])) for i in range(30)], "i int, s string, l string")
    right = spark.createDataFrame([(j, rng.choice(["a", "a", "a", "b", None]), rng.choice(["x", "z", None])) for j in range(60)], "j int, n string, f string")
    whole = lookup.either_key_join(left, right, [("s", "n"), ("l", "f")]).select("i", "j").distinct()
    want = {tuple(r) for r in lookup.capped(whole, ["i"], [F.col("j")], 4).collect()}
    assert {tuple(r) for r in lookup.first_matches(left, "i", right, "j", [("s", "n"), ("l", "f")], 4).collect()} == want and want


def test_tiers_take_the_first_answer(spark):
    t0 = spark.createDataFrame([(1, 1, 10)], "g int, o int, v int")
    t1 = spark.createDataFrame([(1, 0, 20), (2, 5, 30), (2, 4, 40)], "g int, o int, v int")
    assert {r.g: (r.tier, r.v) for r in lookup.best_by_tier([t0, t1], "g", ["o"]).collect()} == {1: (0, 10), 2: (1, 40)}


def test_shards_sum_up(spark):
    rows = spark.range(1, 376).select(F.col("id"), (F.col("id") % 9).alias("page"))
    s = publish.shards(rows, ["id"], 50)
    index = publish.shard_index(s, "id", "page").collect()
    assert sum(r["count"] for r in index) == 375 and len(index) == 8
    blocks = sorted(publish.block_index(s).collect(), key=lambda r: r.block)
    assert [b.start_idx for b in blocks] == [1] + [b.end_idx + 1 for b in blocks[:-1]]
    assert publish.lookup(s, "id").where("id = 51").first().block_file == "block-0002.json"


def test_flatten_counts_before_dropping_redirects(spark):
    df = spark.createDataFrame([("d", [(0, "a"), (1, "b"), (0, "c")])], "doc string, items array<struct<redirect_only:int,x:string>>")
    assert {r.id for r in publish.flatten_items(df, "items", "doc").collect()} == {"d-e1", "d-e3"}


def test_close_matches_equal_difflib(spark):
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("abcr") for _ in range(rng.randint(3, 8))) for _ in range(150)})
    queries = words[::7]
    got = {}
    q = spark.createDataFrame([(x,) for x in queries] + [(None,), ("",)], "x string")
    w = spark.createDataFrame([(x,) for x in words] + [(None,)], "x string")
    for r in fuzzy.close_matches(q, "x", w, "x", 3, 0.7).collect():
        got.setdefault(r.q, []).append((r.rank, round(r.ratio, 6)))
    for x in queries:
        ratios = sorted((SequenceMatcher(None, y, x).ratio() for y in words), reverse=True)
        assert [r for _, r in sorted(got[x])] == [round(r, 6) for r in ratios if r >= 0.7][:3]


def test_close_matches_with_other_initials(spark):
    rng = random.Random(10)
    words = sorted({"".join(rng.choice("abcrR") for _ in range(rng.randint(3, 13))) for _ in range(700)} | {"abcabca", "abcabcarrrrrr", "lufarflaneus", "Rissaprafiis", "a" * 40 + "bc" * 30})
    queries = words[::9] + ["flufarflalunus", "risaprafiis", "abcabca", "a" * 38 + "bc" * 31]
    q, w = spark.createDataFrame([(x,) for x in queries], "x string"), spark.createDataFrame([(x,) for x in words], "x string")
    for cutoff in (0.7, 0.8):
        got = {(r.q, r["rank"]): (r.w, r.ratio) for r in fuzzy.close_matches(q, "x", w, "x", 3, cutoff).collect()}
        want = {}
        for x in queries:
            near = sorted((-SequenceMatcher(None, y, x).ratio(), y) for y in words)
            want |= {(x, i): (y, round(-r, 6)) for i, (r, y) in enumerate(near[:3], 1) if -r >= cutoff}
        assert got == want


def test_bigram_matches_equal_all_pairs(spark):
    rng = random.Random(11)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 9))) for _ in range(900)] + ["", "flufarflal", "lufarflal", "Rissaprafiis"]
    others = words[::3] + ["rissaprafiis", "zzz", "abab"]
    grams = lambda x: {x[i : i + 2] for i in range(max(len(x) - 1, 1))}
    a, b = spark.createDataFrame([(x,) for x in words] + [(None,)], "x string"), spark.createDataFrame([(x,) for x in others] + [(None,)], "x string")
    for least in (0.5, 0.7):
        got = [(r.word, r.match, r.ratio) for r in fuzzy.bigram_matches(a, "x", b, "x", least).collect()]
        want = {(x, y, len(grams(x) & grams(y)) / len(grams(x) | grams(y))) for x in words for y in others}
        assert len(got) == len(set(got)) and set(got) == {t for t in want if t[2] >= least}
    assert {("flufarflal", "lufarflal"), ("Rissaprafiis", "rissaprafiis"), ("", "")} & {t[:2] for t in got} == {("Rissaprafiis", "rissaprafiis"), ("", "")}


def test_bigram_query_has_pairs_with_other_beginnings(spark, tmp_path):
    spark.createDataFrame([(1, "danribespunio"), (2, "cornu")], "entry_id bigint, lemma_sort string").write.parquet(f"{tmp_path}/v2_entry.parquet")
    spark.createDataFrame([("a", "Danribespunio"), ("a", "Danribespunio"), ("b", "cornuum")], "id string, lemma string").write.parquet(f"{tmp_path}/ls_entries.parquet")
    assert {tuple(r) for r in lexicon.bigram_matches(spark, str(tmp_path)).collect()} == {(1, "a", 0.846154, 1), (2, "b", 0.666667, 2)}


def test_ratio_and_variants(spark):
    f = lambda a, b: spark.createDataFrame([(a, b)], "a string, b string").select(fuzzy.bigram_ratio(F.col("a"), F.col("b"))).first()[0]
    assert f("abc", "abd") == pytest.approx(1 / 3) and f("", "") == 1.0 and f("a", "a") == 1.0
    v = spark.range(1).select(fuzzy.swap_variants(F.lit("cornu")), fuzzy.prefix_variants(F.lit("subrideo"))).first()
    assert "comu" in v[0] and "cunnu" not in v[0] and "sub-rideo" in v[1]


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(999, None)], "id bigint, v array<float>").repartition(5)
    got = {(r.query_id, r.rank): r.hit_id for r in vector.top_k(df.where("id % 20 = 0"), df, "id", "v", 5).collect()}
    n = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    for q in range(0, 200, 20):
        s = n @ n[q]
        s[q] = -9
        assert [got[q, r] for r in range(1, 6)] == np.argsort(-s, kind="stable")[:5].tolist()


def test_decisions(spark):
    members = spark.createDataFrame([("g", "a"), ("g", "b"), ("h", "c"), ("s", "x")], "group_id string, id string")
    made = [("g", "a", "keep", None), ("g", "b", "redirect", "a"), ("h", "c", "keep", None), ("u", "z", "keep", None), ("s", "x", "keep", None)]
    got = {r.id: r.reason for r in dedupe.validate_decisions(spark.createDataFrame(made, "group_id string, id string, action string, redirect_to string"), members).collect()}
    assert got == {"a": None, "b": None, "c": "group_below_min_size", "z": "group_not_in_db", "x": "group_below_min_size"}
    bad = [("g", "a", "redirect", None), ("g", "b", "redirect", "b"), ("g", "q", "keep", None), ("g", "", "keep", None)]
    got = {r.id: r.reason for r in dedupe.validate_decisions(spark.createDataFrame(bad, "group_id string, id string, action string, redirect_to string"), members, strict=False).collect()}
    assert got == {"a": "redirect_missing_target", "b": "redirect_to_self", "q": "id_not_in_group", "": "missing_id"}
    strict = dedupe.validate_decisions(spark.createDataFrame(bad, "group_id string, id string, action string, redirect_to string"), members)
    assert {r.reason for r in strict.collect()} == {"id_set_mismatch"}


def test_gates_compare_nulls(spark):
    df = spark.createDataFrame([("a", None, "N"), ("a", None, "N"), ("b", "x", "N"), ("b", "y", "V"), ("c", "x", "N"), ("c", None, "UNK"), (None, "x", "N")], "k string, d string, p string")
    assert {r.key: r.gate for r in dedupe.cluster_gates(df, F.col("k"), ["d"], F.col("p"), spark.createDataFrame([("b",), ("b",), (None,)], "x string")).collect()} == {"a": "AUTO_KEEP_ALL", "b": "AUTO_HOMONYMS_KEEP", "c": "REVIEW"}
    without = dedupe.cluster_gates(df, F.col("k"), ["d"], F.col("p"), df.select("k").limit(0))
    assert {r.key: r.gate for r in without.collect()}["b"] == "REVIEW"


def test_patches(spark):
    df = spark.createDataFrame([(1, "high", "n"), (2, None, None), (3, "low", "")], "id int, conf string, notas string")
    p = spark.createDataFrame([(1, "x"), (2, "y")], "id int, note string")
    out = patch.apply_patch(df, p, "id", {"conf": patch.raise_confidence(F.col("conf")), "notas": patch.append_note(F.col("notas"), F.col("p_note"), " | ")})
    assert {r.id: (r.conf, r.notas) for r in out.collect()} == {1: ("high", "n | x"), 2: ("med", "y"), 3: ("low", "")}
    assert {(r.id, r.column) for r in patch.changed(df, out, "id", ["conf", "notas"]).collect()} == {(1, "notas"), (2, "conf"), (2, "notas")}


def test_suggestion_targets(spark):
    s = spark.createDataFrame([(1, 10, "a", None, "a"), (2, 99, "a", None, "a"), (3, None, "a", "V", "a"), (4, None, "a", None, "a"), (5, None, "zz", None, "zz")], "suggestion_id int, entry_id bigint, norm string, pos string, letters string")
    e = spark.createDataFrame([(10, "a", "N", "a"), (11, "a", "V", "ab")], "entry_id bigint, norm string, pos string, letters string")
    take = lambda mode: {(r.suggestion_id, r.entry_id, r.status) for r in patch.choose_targets(s, e, mode).collect()}
    base = {(1, 10, "TAKE"), (2, None, "MISS"), (3, 11, "TAKE"), (5, None, "MISS")}
    assert take("pos") == base | {(4, None, "REVIEW")}
    assert take("all") == base | {(4, 10, "TAKE"), (4, 11, "TAKE")}
    assert take("safe") == take("one") == base | {(4, 10, "TAKE")}



def test_dictionary_assembly(spark):
    from lexispark.operators import dictionary

    e = spark.createDataFrame([(1, "a (Cic. Div. 1, 2) b (Cald. 3)"), (2, None), (3, "x")], "id int, t string")
    x = dictionary.examples(e, "id", "t")
    assert {(r.entry_id, r.n, r.status) for r in x.collect()} == {(1, 1, "ok"), (1, 2, "parcial")}
    assert [r.n for r in dictionary.search_examples(x, status="parcial").collect()] == [2]
    assert [r.n for r in dictionary.search_examples(x, "div").collect()] == [1]
    kids = dictionary.with_children(e.select("id"), "id", x, "entry_id", "n", ["raw_ref"])
    assert {r.id: len(r.children) for r in kids.collect()} == {1: 2, 2: 0, 3: 0}


def test_suggestions_payloads_and_decisions(spark):
    from lexispark.operators import dictionary

    e = spark.createDataFrame([(1, "cornua"), (2, "comua"), (3, "zzz"), (4, None)], "id int, l string")
    trusted = spark.createDataFrame([("cornua",)], "l string")
    none = trusted.limit(0)
    got = dictionary.suggest_fixes(e, "id", "l", trusted, "l", none, "l", accept=0.2).collect()
    assert [(r.key, r.suggestion, r.conf) for r in got] == [(2, "cornua", "med")]
    lines = [json.dumps({"custom_id": "dedupe::g", "parsed": {"results": [{"id": "a", "action": "keep"}]}}), json.dumps({"custom_id": "dedupe::h", "content": json.dumps({"results": [{"id": "b", "action": "redirect", "redirect_to": "c"}]})}), "junk", json.dumps({"custom_id": "x", "content": "{"})]
    d = dictionary.parse_decisions(spark.createDataFrame([(x,) for x in lines], "v string"), "v")
    assert {(r.group_id, r.id, r.error) for r in d.collect()} == {("g", "a", None), ("h", "b", None), (None, None, "bad_custom_id"), ("x", None, "bad_custom_id")}
    rows = spark.createDataFrame([("g", 2, "b"), ("g", 1, "a")], "g string, i int, t string")
    p = dictionary.group_payload(rows, "g", "i", ["t"], spark.createDataFrame([("g", "LS — x")], "g string, line string")).first()
    assert [x["i"] for x in json.loads(p.payload)["items"]] == [1, 2] and json.loads(p.payload)["evidence"] == "LS — x"
    n = dictionary.narrowed(spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "g string, v int"), "g", F.col("v") == 2)
    assert {(r.g, r.v) for r in n.collect()} == {("a", 2), ("b", 1)}
    o = dictionary.best_overlap(spark.createDataFrame([("a", ["x", "y"]), ("a", ["x"]), ("b", ["q"]), ("b", ["x", "z"])], "g string, h array<string>"), "g", F.array(F.lit("x"), F.lit("y")), F.col("h"))
    assert {(r.g, tuple(r.h)) for r in o.collect()} == {("a", ("x", "y")), ("b", ("x", "z"))}


def test_spread_join_equals_a_join(spark, monkeypatch):
    from lexispark.operators import skew

    monkeypatch.setattr(skew, "HOT_ROWS", 20)
    big = spark.createDataFrame([(i, i % 3 if i < 90 else (None if i % 2 else i)) for i in range(120)], "x int, k int")
    small = spark.createDataFrame([(0, "a"), (2, "b"), (94, "c"), (7, "d")], "k int, v string")
    for how in ("left", "inner", "left_semi", "left_anti"):
        want = sorted(map(str, (tuple(r) for r in big.join(small, "k", how).select(*(["x", "k"] + (["v"] if how in ("left", "inner") else []))).collect())))
        got = skew.spread_join(big, small, "k", how)
        assert sorted(map(str, (tuple(r) for r in got.select(*(["x", "k"] + (["v"] if how in ("left", "inner") else []))).collect()))) == want
    assert sorted(skew.hot_keys(big, "k")) == [0, 1, 2]
