import json
import random

import numpy as np

from lexispark.llm.headwords import bare_form, clean_form, homograph, skeleton
from lexispark.llm.matching import FEATURES, candidate_forms, isotonic, left_side, matches, pair_features, possible_forms, right_side, train_logistic
from pyspark.sql import functions as F

LEFT = "entry_id bigint, lemma string, homograph_no int, pos string, verb_class string, decl_class string, adj_class string, morph_render string, head_raw string, definicao string, form string, number string"
RIGHT = "id string, orths string, itypes string, lemma string, pos string, definition string, ls_form string, quotes string"
SYLLABLES = ["cor", "gun", "tir", "ban", "dos", "fle", "pru", "mur", "ven", "lis", "gra", "con"]
NAMES = ["navio", "porto", "rio", "vento", "neve"]


def tables(n=60, seed=5):
    rng = random.Random(seed)
    left, right, truth = [], [], set()
    for i in range(n):
        stem = "".join(rng.choice(SYLLABLES) for _ in range(4))
        verb = i % 3 == 0
        word = stem + ("ao" if verb else "us")
        quote = " ".join("".join(rng.choice(SYLLABLES) for _ in range(3)) for _ in range(4))
        pt = f"1. {'levar o' if verb else 'navio do'} {rng.choice(NAMES)}: {quote} (Cald. Or. 1, 2)."
        en = f"{'To carry' if verb else 'Ship of'} the river: {quote}, Cald. 1, 2."
        copies = rng.randint(1, 3)
        for c in range(copies):
            seen = word if c == 0 else word.replace("n", "u", 1)
            left.append((i * 10 + c, seen, None, "VERB" if verb else "NOUN", None, None, None, None, None, pt, "clash", "clash"))
            truth.add((i * 10 + c, f"n{i}"))
        right.append((f"n{i}", json.dumps([word]), json.dumps(["are" if verb else "i"]), word.replace("u", "v", 1), rng.choice(["v. a." if verb else "n.", "", None]), en, "clash", "clash"))
        other = stem + ("osus" if verb else "arius")
        right.append((f"m{i}", json.dumps([other]), "[]", other, "adj.", "That sees the river, green.", "", ""))
    return left, right, truth


def test_finds_the_pairs_and_no_words_of_the_same_stem(spark):
    left, right, truth = tables()
    got = matches(spark.createDataFrame(left, LEFT), spark.createDataFrame([*right, right[0]], RIGHT))
    rows = got.collect()
    assert {(r.entry_id, r.ls_id) for r in rows} == truth
    assert len(rows) == len(truth)
    assert all(0 <= r.confidence <= 1 for r in rows)


def test_homographs_need_the_same_number(spark):
    left = [(1, "corguntirus", 1, "NOUN", None, None, None, None, None, None, "", ""), (2, "corguntirus", 2, "NOUN", None, None, None, None, None, None, "", "")]
    right = [("a", '["corguntirus"]', "[]", "corguntirus (II)", "n.", "Ship.", "", ""), ("b", '["corguntirus"]', "[]", "1. corguntirus", "n.", "Ship.", "", "")]
    got = matches(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT))
    assert {(r.entry_id, r.ls_id) for r in got.collect()} == {(2, "a"), (1, "b")}


def test_nulls_empty_and_repeated(spark):
    left, right = [(None, "x") + (None,) * 10, (1, None) + (None,) * 10, (2, "") + (None,) * 10], [(None,) * 8, ("a", None, None, None, None, None, None, None), ("b", "[", "{", "", "", "", "", "")]
    lf, rt = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)
    assert matches(lf, rt).count() == 0
    assert matches(lf.limit(0), rt.limit(0)).count() == 0


def test_features_are_one_row_per_pair(spark):
    left, right, _ = tables(20)
    p = pair_features(left_side(spark.createDataFrame(left, LEFT)), right_side(spark.createDataFrame(right, RIGHT)))
    assert p.count() == p.select("entry_id", "ls_id").distinct().count()


def test_skeletons_of_confusable_forms_agree(spark):
    pairs = [("cursorum", "cursorurn"), ("findinsincue", "findmsincue"), ("fucluterlerio", "fucluterleno"), ("londifirero", "lonclifirero"), ("bafenbircia", "bafenhircia"), ("rural", "riiral"), ("iuvenis", "juuenis")]
    df = spark.createDataFrame(pairs, "a string, b string").select(skeleton(F.col("a")).alias("x"), skeleton(F.col("b")).alias("y"))
    assert all(r.x == r.y for r in df.collect())


def test_headword_forms(spark):
    df = spark.createDataFrame([("2. Bānlancus",), ("clitus (II)",), ("vuncen2",), ("mur-lus vel murlis",), ("ｃｌａ‍ra ",)], "l string")
    got = [(r.b, r.n) for r in df.select(bare_form(clean_form(F.col("l"))).alias("b"), homograph(clean_form(F.col("l"))).alias("n")).collect()]
    assert got == [("banlancus", 2), ("clitus", 2), ("vuncen", 2), ("murlus", None), ("clara", None)]


def test_classifier_and_calibration():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 3))
    y = (x[:, 0] - 2 * x[:, 1] + rng.normal(size=2000) * 0.5 > 0).astype(float)
    w = train_logistic(x[:1500], y[:1500])
    p = 1 / (1 + np.exp(-(x[1500:] @ w[:3] + w[3])))
    assert ((p > 0.5) == y[1500:]).mean() > 0.9
    steps = isotonic(p, y[1500:])
    assert [s for s, _ in steps] == sorted(s for s, _ in steps)
    assert all(a[1] <= b[1] + 1e-9 for a, b in zip(steps, steps[1:]))


def misread(word, rng):
    swaps = [("n", "u"), ("m", "rn"), ("rn", "m"), ("c", "e"), ("e", "c"), ("b", "h"), ("d", "cl"), ("t", "f"), ("l", "i"), ("i", "l"), ("u", "ii")]
    fits = [(a, b) for a, b in swaps if a in word]
    a, b = rng.choice(fits)
    at = rng.choice([i for i in range(len(word)) if word.startswith(a, i)])
    return word[:at] + b + word[at + len(a) :]


def test_blocking_meets_misread_spellings(spark):
    """Candidates against all pairs: nearly every spelling with one or two misreadings meets its word."""
    rng = random.Random(12)
    words = sorted({"".join(rng.choice(SYLLABLES) for _ in range(rng.randint(3, 4))) + rng.choice(["us", "a", "um", "ere"]) for _ in range(300)})
    once, twice = [(misread(w, rng), w) for w in words], [(misread(misread(w, rng), rng), w) for w in words]
    side = lambda forms: spark.createDataFrame([(f, []) for f in forms], "form string, quotes array<string>")
    got = {(r.form, r.ls_form) for r in candidate_forms(side([f for f, _ in once + twice]), side(words)).collect()}
    assert sum(p in got for p in once) >= 0.9 * len(once)
    assert sum(p in got for p in twice) >= 0.82 * len(twice)
    assert len(got) < 0.1 * 600 * len(words)


def test_pairs_left_out_before_rows_are_formed_could_not_match(spark):
    left, right, _ = tables(40)
    a, b = left_side(spark.createDataFrame(left, LEFT)), right_side(spark.createDataFrame(right, RIGHT))
    forms = candidate_forms(a, b).cache()
    w = train_logistic(np.zeros((0, len(FEATURES))), np.zeros(0))
    kept = possible_forms(forms, w, 0.5)
    score = lambda df: {(r.entry_id, r.ls_id) for r in pair_features(a, b, df).collect() if sum(r[n] * v for n, v in zip(FEATURES, w)) + w[-1] >= 0}
    assert kept.count() < forms.count() and score(kept) == score(forms) != set()
