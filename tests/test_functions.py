import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexispark.functions import morph, strings
from lexispark.functions.citation import reference_text, split_reference
from lexispark.functions.fold import accent_table, first_letter, latin_key, lemma_key, letters_only, slugify


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("r")).first().r


@settings(max_examples=200)
@given(st.text(alphabet=st.characters(min_codepoint=0x20, max_codepoint=0x24F)))
def test_accent_table_equals_decomposition(text):
    a, b = accent_table()
    folded = "".join(c for c in text.translate(str.maketrans(a, b)) if unicodedata.category(c) != "Mn")
    assert folded == "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn")


def test_references(spark):
    cases = {
        "Cic. Div. 1, 23": ("Cic.", "Div.", "1, 23", "ok", 0.9, None), "Cic. 16": ("Cic.", None, "16", "parcial", 0.6, "issues=obra_ausente"), "": (None, None, None, "invalido", 0.0, "issues=vazio"),
        "Plín. 3": (None, None, None, "invalido", 0.2, "issues=nao_casou"), "App. M. 3, 7": ("Apul.", "M.", "3, 7", "ok", 0.9, None),
    }
    for text, want in cases.items():
        r = one(spark, split_reference, text)
        assert (r.fonte, r.obra, r.loc, r.status, r.confidence, r.err_msg) == want
    assert one(spark, split_reference, None).status == "invalido"
    assert one(spark, lambda c: reference_text(F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("string"), c), "cru") == "cru"


def test_keys_and_strings(spark):
    assert one(spark, slugify, "Lewis & Short") == "lewis-short"
    assert one(spark, slugify, "") == "volume"
    assert one(spark, lambda c: first_letter(c), "ābaco") == "A"
    assert one(spark, lambda c: first_letter(c, letters=True), "-os") == "#"
    assert one(spark, latin_key, "Jūvenis, -e (æ)") == "iuueniseae"
    assert one(spark, lambda c: lemma_key(c, True), "  Jūs  Vītae ") == "ius uitae"
    assert one(spark, letters_only, "Ā-b c") == "abc"
    for template, text, want in (("ROMA", "roma", "ROMA"), ("roma", "Roma", "roma"), ("Roma", "romae", "Romae")):
        assert one(spark, lambda c, t=template: strings.case_like(F.lit(t), c), text) == want
    assert tuple(one(spark, strings.chunk_and_page, "chunk_13:13:0")) == ("chunk_13", 13)
    assert tuple(one(spark, strings.chunk_and_page, "chunk_x")) == ("chunk_x", None)
    assert one(spark, strings.entry_prefix, "n00001.e01") == "n00001" and one(spark, strings.entry_prefix, "x1") is None
    assert one(spark, strings.json_list, "[1") == [] and one(spark, strings.json_list, '["a"]') == ["a"]
    assert one(spark, strings.decode_escapes, "\\u00e1 b") == "á b"
    assert one(spark, lambda c: strings.tagged(F.array(c, F.lit('"b"@la')), "pt"), '"a"@pt') == ["a"]
    assert one(spark, strings.headword_line, "navis ou naus, -is, s. f.").variants == ["naus"]


def test_labels(spark):
    m = one(spark, morph.parse_label, "s. masc. 2ª (-i) arc.")
    assert (m.pos, m.gender, m.decl_class, m.extras, m.indeclinable) == ("NOUN", "m", "2ª (-i)", ["arc."], 0)
    assert one(spark, lambda c: morph.noun_class(c, F.lit("f"), F.lit(0)), "-ae") == "s. fem. 1ª (-ae)"
    assert one(spark, lambda c: morph.noun_class(c, F.lit("f"), F.lit(0)), "-ei") == "s. fem. 5ª (-ei)"
    assert one(spark, morph.verb_class, "habēre") == "v. 2ª (-ēre)"
    assert one(spark, morph.adjective_class, "-a, -um") == "adj. 1ª/2ª"
    vote = lambda *x: tuple(spark.createDataFrame([x], "g string, l string, d string").select(morph.vote(F.col("g"), F.col("l"), F.col("d")).alias("r")).first().r)
    assert vote("NOUN", None, "NOUN") == ("NOUN", 2) and vote("A", "B", "C") == ("A", 1) and vote("A", "B", "B") == ("B", 2)


def test_labels_of_other_dictionaries(spark):
    f = one(spark, morph.foreign_class, "2. Deklination, Subst.")
    assert (f.kind, f.cls, f.extra) == ("noun", "2ª (-i)", None)
    v = one(spark, morph.foreign_class, "Verb 3. Konjugation, Deponens")
    assert (v.kind, v.cls, v.extra) == ("verb", "3ª (-ere)", "dep.")
    h = one(spark, morph.foreign_hints, "navis, is f. Schiff; Infinitiv amare")
    assert (h.gender, h.infinitive, h.genitive, h.three_endings) == ("f", "amare", "is", False)
    assert one(spark, lambda c: morph.inflection_set(F.array(c, F.lit("are"))), "a, -um") == ["1", "a", "um"]
    assert one(spark, morph.pos_of_code, "Adj.") == "ADJ" and one(spark, morph.pos_of_code, "?") is None
    assert one(spark, lambda c: morph.pos_matches(c, F.lit("NOUN")), "s. fem.") and one(spark, lambda c: morph.pos_matches(c, F.lit(None).cast("string")), "x")
