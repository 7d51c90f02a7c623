import hashlib
import random

from lexispark.llm.truncation import break_off, features, field_limits, strict_prefixes, truncated, truncation_report

SCHEMA = "doc_id bigint, text string, source string, kind string, id bigint, norm string"
S = "O navio do rio leva a carta ao porto, e o vento guarda a neve do inverno. "


def run(spark, rows):
    df = spark.createDataFrame([(i, t, s, "clash", 0, "clash") for i, (t, s) in enumerate(rows)], SCHEMA)
    return {r.id: r for r in truncated(df).collect()}


def test_prose_lists_verse_and_closing_lines(spark):
    listed = "navira, -ae, s. f.\nporto, -are, v.\ncornus, -onis\nlitra, adj.\n"
    verse = "Cornus tirbas ad lumen\nGranus et flemus non dorsit\nPrulis vendam sine gurdo"
    rows = [
        (S * 3, "a"), (S * 2 + "O navio do ri", "a"), (S * 2 + "O navio do (Cald.", "a"), (S + "\n— Conselho de redação", "a"), (S + "\nCald. Or. 3, 38", "a"), (S + "\nFIM DO CADERNO", "a"),
        (listed + listed + "porto, -onis", "a"), (listed + listed + "porto, -", "a"), (listed + listed + "port", "a"), (verse, "a"), (S + "O vento da neve…", "a"), (S.strip() + "\r\n", "a"), (S + "o vento d\n", "a"),
    ]
    got = run(spark, rows)
    assert {i for i, r in got.items() if r.cut} == {1, 2, 7, 8, 12}
    assert got[9].kind == "verse" and got[6].kind == "list" and got[3].kind == "closing"


def test_copies_that_differ_in_case_spacing_and_marks(spark):
    verse = "Cornus tirbas ad lumen\nGranus et flemus non dorsit"
    rows = [("[2.ª via] " + verse, "a"), ("* " + verse, "a"), (S.upper() + "O NAVIO DO RI", "a"), (S + "\nCald. Or. 3 , 38", "a"), (S + "\nFIM  DO  CADERNO", "a"), ((S + "\n" + S).upper() + "\nO NAVIO DO", "a")]
    got = run(spark, rows)
    assert [got[i].cut for i in range(len(rows))] == [False, False, True, False, False, True]


def test_copies_of_one_cut_text_make_no_limit(spark):
    rows = [(S + "o vento d", "a")] * 20 + [(S + "x" * 7 * i + " ven", "a") for i in range(30)]
    df = spark.createDataFrame([(i, t, s, "", 0, "") for i, (t, s) in enumerate(rows)], SCHEMA)
    assert field_limits(features(df, "doc_id", "text", "source")).count() == 0


def test_limits_are_learned_and_complete_texts_of_that_length_stay(spark):
    long = S * 20
    rows = [(f"{i:03d} " + long[: 396], "w") for i in range(12)] + [("x" * 30 + " " + S * (1 + i % 7), "w") for i in range(60)]
    rows += [(f"9 {S}" + "x" * (400 - len(S) - 3) + ".", "w")]
    got = run(spark, rows)
    assert all(got[i].by_limit for i in range(12))
    assert not got[len(rows) - 1].cut
    df = spark.createDataFrame([(i, t, s, "", 0, "") for i, (t, s) in enumerate(rows)], SCHEMA)
    assert ("w", "chars", 400) in {(r.source, r.unit, r.n) for r in field_limits(features(df, "doc_id", "text", "source")).collect()}


def test_strict_prefixes_over_many_partitions(spark):
    base = ["%04d" % i + "palavra" * 10 for i in range(300)]
    texts = base + [t + "mais" for t in base[::3]] + base[:5] + [None, ""]
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.copy for r in strict_prefixes(spark.createDataFrame([(t, t) for t in texts], "form string, shown string")).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == {hashlib.md5(t.encode()).hexdigest() for t in base[::3]}


def test_prefix_of_a_longer_copy_is_cut_even_without_other_signs(spark):
    verse = "Cornus tirbas ad lumen flemus\nGranus et flemus non dorsit\nPrulis vendam sine"
    got = run(spark, [(verse, "a"), (verse + " gurdo lumen\nVentas flemus nec gurdo", "b"), (verse, "c")])
    assert [got[i].cut for i in range(3)] == [True, False, True]
    assert got[0].by_prefix and got[2].by_prefix


def test_where_a_text_breaks_off(spark):
    """The longer copy tells a cut from a text that ends where a sentence or line does; short texts count as well."""
    longer = "O navio leva a carta. Diz o juiz (Cald. Or. 1, 2) que o vento volta\nao porto da neve.\nVERSO LONGO DO MAR"
    ends = ["O navio lev", "O navio leva a carta.", "O navio leva a carta. Diz o juiz (Cald.", "O navio leva a carta. Diz o juiz (Cald. Or. 1, 2) que o vento volta", "O navio leva a"]
    assert [break_off(t, longer, sum(c.isalnum() for c in t)) for t in ends] == ["word", "end", "sentence", "line", "sentence"]
    assert break_off("O navio leva.", "O navio leva a carta", 10) == "end"
    got = run(spark, [(longer, "a"), (ends[0], "a"), (ends[1], "a"), (ends[2], "a"), (ends[3].upper(), "a"), ("* O  návio leva a", "b"), ("O navio leva.", "b")])
    assert [got[i].by_prefix for i in range(7)] == [False, False, False, True, True, False, False]


def test_planted_cuts_are_found_by_prefix_alone(spark):
    """Copies of whole texts, cut anywhere, written differently: the prefix join alone finds nearly all."""
    rng = random.Random(8)
    vocab = [a + b + c for a in ("na", "ve", "por", "lu") for b in ("vi", "ta", "mo") for c in ("o", "as", "em", "ndo")]
    docs, cuts = [], set()
    for i in range(400):
        text = " ".join(". ".join(" ".join(rng.choice(vocab) for _ in range(rng.randint(4, 12))).capitalize() for _ in range(rng.randint(1, 40))).split(" ")) + "."
        docs.append((text, "a"))
        if i % 4 == 0:
            spots = [k for k in range(20, len(text) - 2) if text[k - 1].isalpha() and text[k : k + 2] != ". " and text[k:] != "."]
            if not spots:
                continue
            part = text[: rng.choice(spots)]
            if rng.random() < 0.5:
                part = rng.choice(["[2.ª via] ", "* ", ""]) + rng.choice([part.upper(), part.replace(" ", "\n"), part.replace(" ", "  ")])
            cuts.add(len(docs))
            docs.append((part, "b"))
    got = run(spark, docs)
    found = {i for i, r in got.items() if r.by_prefix}
    assert found <= cuts and len(found) >= 0.95 * len(cuts)


def test_nulls_empty_junk_and_report(spark):
    rows = [(None, "a"), ("", "a"), ("—", "a"), ("s. d.", None), ("???", "a"), ("12 34", "a"), (S + "o vento d", None), (S + "o vento d", "a"), (S + "o vento d", "a")]
    got = run(spark, rows)
    assert {i for i, r in got.items() if r.cut} == {6, 7, 8} and len(got) == len(rows)
    df = spark.createDataFrame([(i, t, s, "", 0, "") for i, (t, s) in enumerate(rows)], SCHEMA)
    assert {(r.source, r.n_docs, r.n_cut) for r in truncation_report(truncated(df)).collect()} == {("a", 7, 2), (None, 2, 1)}
    assert truncated(df.limit(0)).count() == 0


def test_very_long_text(spark):
    got = run(spark, [(S * 5000, "a"), (S * 5000 + "o ven", "a")])
    assert [got[0].cut, got[1].cut] == [False, True]
