import unicodedata

from pyspark.sql import functions as F

from lexispark.llm.visual import consistent_texts, inconsistent_rows, make_consistent

CASES = {
    "ｐｌｕｔｅｎａ": "plutena", "ba​se": "base", "ā": "ā", "ā̆": None, "ā̆": "ā̆", "nоvus": "novus", "βάτραξος": None, "-α": "-a", "mu­ro ": "muro", "a b": "a b", "ﬁrmus": "firmus",
    "–us": "-us", " x": "x", "a  b": "a b", "　": "", "": None, "ordinary": None, "DECAGRĒDIŪM": None, "ı": "i", "μάλα": "μάλα", "ȩ́": "ȩ́",
}


def test_cases(spark):
    df = spark.createDataFrame([(k,) for k in CASES] * 2 + [(None,)], "text string")
    got = {r.text: r.consistent for r in consistent_texts(df).collect()}
    assert got == {k: v for k, v in CASES.items() if v is not None}


def test_result_is_a_fixed_point_and_composed(spark):
    letters = "".join(chr(x) for x in range(0xC0, 0x250)) + "".join(chr(x) for x in range(0xFF21, 0xFF5B))
    texts = [f"x{a}́{b}" for a, b in zip(letters, reversed(letters))]
    got = [r.consistent for r in consistent_texts(spark.createDataFrame([(t,) for t in texts], "text string")).collect()]
    assert all(unicodedata.normalize("NFC", g) == g for g in got)
    assert consistent_texts(spark.createDataFrame([(g,) for g in got], "text string")).count() == 0


def test_rows_with_clashing_names_nulls_and_repeats(spark):
    df = spark.createDataFrame([(1, "ａ", "x"), (1, "ａ", "x"), (2, None, "y"), (None, "ａ", ""), (3, "a", "")], "id bigint, text string, consistent string")
    assert [(r.tab, r.rec_key) for r in inconsistent_rows((df, "id", F.array("text"), "t")).collect()] == [("t", "1")]
    out = make_consistent(df, "text")
    assert sorted((r.id or 0, r.consistent or "") for r in out.collect()) == [(0, "a"), (1, "a"), (1, "a"), (2, ""), (3, "a")]
    assert inconsistent_rows((df.limit(0), "id", F.array("text"), "t")).count() == 0


def test_long_text(spark):
    t = "ａb " * 20_000 + "ā̆"
    assert consistent_texts(spark.createDataFrame([(t,), ("ab " * 20_000 + "a",)], "text string")).first().consistent == "ab " * 20_000 + "ā̆"


def test_marks_compose_unless_blocked(spark):
    texts = ["a\u0330\u0301", "a\u0323\u0302", "a\u0302\u0323", "a\u0301\u0301", "\u0301a", "e\u0327\u0306"]
    got = {r.text: r.consistent for r in consistent_texts(spark.createDataFrame([(t,) for t in texts], "text string")).collect()}
    assert {t: got.get(t, t) for t in texts} == {t: unicodedata.normalize("NFC", t) for t in texts}


def test_letters_beyond_the_first_planes(spark):
    """Mathematical letters, Lisu and Cherokee letters, small capitals, circled letters: none passes as consistent."""
    texts = {"n𝐚vis": "navis", "ꓮvis": "Avis", "ɴavis": "navis", "ᴍare": "mare", "Ꭺvis": "Avis", "𝓷avis": "navis", "ⓝavis": "navis", "navis한": None, "\uf900": unicodedata.normalize("NFKC", "\uf900")}
    got = {r.text: r.consistent for r in consistent_texts(spark.createDataFrame([(t,) for t in texts], "text string")).collect()}
    assert got == {k: v for k, v in texts.items() if v}


def test_several_sources_in_one_pass(spark):
    a, b = spark.createDataFrame([(1, "ａ")], "i int, t string"), spark.createDataFrame([("x", ["ａ", "a"]), ("y", ["a"]), ("z", None)], "k string, t array<string>")
    assert {tuple(r) for r in inconsistent_rows((a, "i", F.array("t"), "a"), (b, "k", F.col("t"), "b")).collect()} == {("a", "1"), ("b", "x")}
