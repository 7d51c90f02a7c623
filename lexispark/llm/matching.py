"""Matching entries of two dictionaries that share no key.

Candidates come from MinHash bands over two attributes (the headword's stroke skeleton, the words of Latin quotations).
Distinct skeletons meet in the bands, then the spellings that have them; pairs of rows are formed last, so copies of an
article add no candidates. Pair features are computed in SQL. A logistic classifier is trained on weak labels: quotations
shared by both articles label pairs positive, quotations present on both sides without a common word label them negative;
the quotations themselves are not among its features. Every candidate is judged by the classifier: pairs of spellings
are left out only where no word class and no number could lift them to the threshold. Scores are calibrated on held-out
weak labels by isotonic regression.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.llm.headwords import bare_form, clean_form, homograph, single_consonants, skeleton
from lexispark.llm.survivor import MAX_MISREAD_DISTANCE, word_class
from lexispark.operators.skew import spread_join
from lexispark.session import cut, ship_package

BANDS = 20
BAND_ROWS = 5  # words of 60 % common trigrams (one foreign letter in ten) meet with 80 %, of 75 % with 99 %, of 20 % with half a percent
MIN_FRAME = 8
MOST_EDITS = 12  # more edits than these count as these: a feature that far pairs do not dominate
TRAIN_ROWS = 20_000  # weakly labelled pairs read to the driver for training: the bound of the sample
FAR_ROWS = 2_000  # of them pairs of spellings farther apart than
CLOSE_DISTANCE = 0.34
FAR_FORMS = 400_000  # distant pairs of spellings looked at for training, about
THRESHOLD = 0.5
LATIN_WORD = r"\p{L}{7,}"
# Abbreviations of word classes in the second dictionary.
CLASS_OF_ABBREVIATION = {"n": "N", "noun": "N", "subst": "N", "n pr": "N", "prop n": "N", "s": "N", "adj": "A", "a": "A", "p a": "A", "v": "V", "v a": "V", "v n": "V", "v dep": "V", "verb": "V", "adv": "D", "prep": "P", "conj": "C", "interj": "I"}
FORM_FEATURES = ("same_skeleton", "distance", "tail_distance", "edits")
FEATURES = (*FORM_FEATURES, "class_agree", "class_conflict", "guess_agree", "guess_conflict", "number_agree", "number_conflict", "number_missing")


def _runs(skel: Column) -> Column:
    """Skeleton with runs of strokes written as one character."""
    x = skel
    for n in range(9, 0, -1):
        x = F.replace(x, F.lit("|" * n), F.lit(str(n)))
    return x


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        return x ^ (x >> np.uint64(29))


def minhash_bands(texts: list[str]) -> np.ndarray:
    """Band keys (rows: texts) of the MinHash of character trigrams, BANDS bands of BAND_ROWS values."""
    framed = [f"^{t}$".encode("utf-32-le", "surrogatepass") for t in texts]
    size = np.array([len(x) // 4 for x in framed])
    codes = np.frombuffer(b"".join(framed), np.uint32).astype(np.uint64)
    first = np.r_[0, np.cumsum(size)]
    at = np.arange(len(codes) - 2)
    at = at[(np.searchsorted(first, at, "right") == np.searchsorted(first, at + 2, "right"))]
    grams, code = np.unique((codes[at] << np.uint64(42)) ^ (codes[at + 1] << np.uint64(21)) ^ codes[at + 2], return_inverse=True)
    k = np.arange(1, BANDS * BAND_ROWS + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        family = (_mixed(_mixed(grams)[:, None] ^ (k * np.uint64(0x9E3779B97F4A7C15))[None, :]) >> np.uint64(32)).astype(np.uint32)
    sig = np.minimum.reduceat(family[code], np.searchsorted(at, first[:-1]), axis=0)
    key = np.arange(BANDS, dtype=np.uint64)
    for r in range(BAND_ROWS):
        key = _mixed(key ^ (sig[:, r::BAND_ROWS].astype(np.uint64) + np.uint64(r << 32)))
    return key


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 4096):
            some = batch.slice(lo, 4096)
            keys = minhash_bands(some.column(1).to_pylist())
            yield pa.record_batch({"skel": some.column(0), "bands": pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel().view(np.int64)))})


def _skeleton_bands(skels: DataFrame) -> DataFrame:
    """``(skel, band)`` of distinct skeletons: MinHash bands, the skeleton itself, and the letters between its strokes."""
    runs = skels.select("skel", _runs(F.col("skel")).alias("runs")).mapInArrow(_banded, "skel string, bands array<bigint>")
    # the letters between runs of strokes: survives a doubled letter and a misreading at once
    frame = F.regexp_replace(F.regexp_replace("skel", r"\|+", "|"), r"([a-z])\1+", "$1")
    framed = F.when(F.length(frame) >= MIN_FRAME, F.xxhash64(F.lit(-2), frame))
    return runs.select("skel", F.explode(F.array_distinct(F.array_compact(F.concat("bands", F.array(F.xxhash64(F.lit(-1), "skel"), framed))))).alias("band"))


def _cited_bands(skel: Column, quotes: Column) -> Column:
    least = lambda seed: F.array_min(F.transform(quotes, lambda q: F.xxhash64(q, F.lit(seed))))
    cited = [F.when(F.size(quotes) >= 3, F.xxhash64(F.lit(100 + s), least(s), least(s + 50), F.substring(skel, 1, 2))) for s in range(2)]
    return F.array_distinct(F.array_compact(F.array(*cited)))


def _words(text: Column) -> Column:
    """Skeletons of the long words of a text: misread quotations still compare equal."""
    return F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(F.lower(text), F.lit("")), F.lit(f"({LATIN_WORD})"), 1), skeleton))


def _quoted(text: Column) -> Column:
    """The Latin quotations of a definition: between a colon and the citation in brackets."""
    return F.array_join(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r":([^():;.]*)\("), 1), " ")


def left_side(df: DataFrame) -> DataFrame:
    """Comparable attributes of the first dictionary; rows without id or headword are left out."""
    bare = bare_form(clean_form(F.col("lemma")))
    cls = word_class(F.col("pos"), F.col("morph_render"), F.col("verb_class"), F.col("decl_class"), F.col("adj_class"))
    head = F.nullif(bare_form(clean_form(F.regexp_extract("head_raw", r"^([^,]*)", 1))), F.lit(""))
    rows = df.where(F.col("entry_id").isNotNull()).dropDuplicates(["entry_id"])
    rows = rows.select("entry_id", bare.alias("bare"), head.alias("head"), F.col("homograph_no").cast("int").alias("number"), cls.alias("cls"), F.col("definicao").alias("gloss"))
    form = F.coalesce(F.when(skeleton(F.col("head")) == skeleton(F.col("bare")), F.col("head")), F.nullif("bare", F.lit("")), "head")
    rows = rows.withColumn("form", form).where(F.col("form").isNotNull())
    return rows.select("entry_id", "form", "number", "cls", F.lit(None).cast("string").alias("guess"), _words(_quoted(F.col("gloss"))).alias("quotes"))


def right_side(df: DataFrame) -> DataFrame:
    """Comparable attributes of the second dictionary; a row delivered twice counts once."""
    clean = clean_form(F.col("lemma"))
    orth = bare_form(clean_form(F.get(F.from_json("orths", "array<string>"), F.lit(0))))
    pos = F.trim(F.regexp_replace(F.lower("pos"), r"[.\s]+", " "))
    cls = F.coalesce(*[F.when(pos == k, F.lit(v)) for k, v in CLASS_OF_ABBREVIATION.items()])
    said = F.lower(F.coalesce(F.nullif(F.regexp_extract("definition", r'"gloss"\s*:\s*"([^"]*)"', 1), F.lit("")), F.col("definition")))
    ending = F.lower(F.trim(F.get(F.from_json("itypes", "array<string>"), F.lit(0))))
    guess = (
        F.when(said.rlike(r"^to \w"), "V").when(said.rlike(r"^in an? \w+ manner"), "D").when(ending.isin("are", "ere", "ire", "eri", "ari", "iri"), "V")
        .when(said.rlike(r"^that \w+s |^\w+, (?:of|that) "), "A").when(ending.isin("a, um", "e"), "A").when(ending != "", "N").when(said != "", "N")
    )
    rows = df.where(F.col("id").isNotNull()).dropDuplicates(["id"])
    rows = rows.select(F.col("id").alias("ls_id"), F.coalesce(F.nullif(bare_form(clean), F.lit("")), F.nullif(orth, F.lit(""))).alias("form"), homograph(clean).alias("number"), cls.alias("cls"), guess.alias("guess"), _words(F.col("definition")).alias("quotes"))
    return rows.where(F.col("form").isNotNull())


def candidate_forms(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of distinct spellings that share a band, with their string features; one row per pair.

    Every spelling is banded twice, as it stands and with doubled consonants written once.
    """

    def keyed(side: DataFrame, *more: str) -> DataFrame:
        """What pairs of spellings are compared by, made once a spelling."""
        single = single_consonants(F.col("form"))
        return side.select("form", *more, single.alias("single"), _runs(skeleton(F.col("form"))).alias("runs"), _runs(skeleton(single)).alias("single_runs"))

    def spellings(side: DataFrame) -> DataFrame:
        every = keyed(side.select("form").distinct())
        return cut(every.select("*", F.explode(F.array_distinct(F.array(skeleton(F.col("form")), skeleton(F.col("single"))))).alias("skel")).where("skel != ''"))

    def cited(side: DataFrame) -> DataFrame:
        rows = keyed(side.where(F.size("quotes") >= 3), "quotes")
        return rows.select("form", "single", "runs", "single_runs", F.explode(_cited_bands(skeleton(F.col("form")), F.col("quotes"))).alias("band")).distinct()

    def other(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c).alias(f"ls_{c}") if c in ("form", "single", "runs", "single_runs") else F.col(c) for c in df.columns])

    def compared(pairs: DataFrame) -> DataFrame:
        far = lambda x, y: F.levenshtein(x, y) / F.greatest(F.length(x), F.length(y), F.lit(1))
        tail = lambda x, y: F.levenshtein(F.substring(x, -5, 5), F.substring(y, -5, 5)) / 5.0
        edits = F.least(F.levenshtein("form", "ls_form"), F.levenshtein("single", "ls_single"), F.lit(MOST_EDITS)) / MAX_MISREAD_DISTANCE
        a, b, c, d = (F.col(x) for x in ("runs", "ls_runs", "single_runs", "ls_single_runs"))
        return pairs.select("form", "ls_form", ((a == b) | (c == d)).cast("double").alias("same_skeleton"), F.least(far(a, b), far(c, d)).alias("distance"), F.least(tail(a, b), tail(c, d)).alias("tail_distance"), edits.alias("edits"))

    ship_package(left.sparkSession)
    a, b = spellings(left), spellings(right)
    # skeletons travel as hashes until the pairs are known
    met = _skeleton_bands(a.select("skel").distinct()).select(F.xxhash64("skel").alias("s"), "band").join(_skeleton_bands(b.select("skel").distinct()).select(F.xxhash64("skel").alias("r"), "band"), "band").select("s", "r").distinct()
    near = met.join(a.withColumn("s", F.xxhash64("skel")).drop("skel"), "s").join(other(b.withColumn("r", F.xxhash64("skel")).drop("skel")), "r")
    return compared(near).unionByName(compared(cited(left).join(other(cited(right)), "band"))).distinct()


def pair_features(left: DataFrame, right: DataFrame, forms: DataFrame | None = None) -> DataFrame:
    """All candidate pairs of articles with features and the weak label (null where nothing labels the pair)."""
    forms = candidate_forms(left, right) if forms is None else forms
    r = right.select(F.col("ls_id"), F.col("form").alias("ls_form"), F.col("number").alias("ls_number"), F.col("cls").alias("ls_cls"), F.col("guess").alias("ls_guess"), F.col("quotes").alias("ls_quotes"))
    # the forms an article may match, as one row a form: a form many articles share is spread
    mine = forms.groupBy("form").agg(F.collect_list(F.struct("ls_form", *FORM_FEATURES)).alias("near"))
    rows = spread_join(left, mine, "form", "inner").select(*left.columns, F.explode("near").alias("n")).select(*left.columns, "n.*").join(r, "ls_form")
    known, other = F.col("cls").isNotNull() & F.col("ls_cls").isNotNull(), F.col("cls").isNotNull() & F.col("ls_guess").isNotNull()
    common = F.size(F.array_intersect("quotes", "ls_quotes"))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    label = F.when(common >= 2, 1.0).when((F.size("quotes") >= 3) & (F.size("ls_quotes") >= 3) & (common == 0), 0.0)
    return rows.select(
        "entry_id", "ls_id", "same_skeleton", "distance", "tail_distance", "edits",
        flag(known & (F.col("cls") == F.col("ls_cls"))).alias("class_agree"), flag(known & (F.col("cls") != F.col("ls_cls"))).alias("class_conflict"),
        flag(other & (F.col("cls") == F.col("ls_guess"))).alias("guess_agree"), flag(other & (F.col("cls") != F.col("ls_guess"))).alias("guess_conflict"),
        flag(F.col("number") == F.col("ls_number")).alias("number_agree"), flag(F.col("number") != F.col("ls_number")).alias("number_conflict"),
        (F.col("number").isNull() != F.col("ls_number").isNull()).cast("double").alias("number_missing"), label.alias("label"),
    )


def possible_forms(forms: DataFrame, w: np.ndarray, threshold: float) -> DataFrame:
    """Pairs of spellings that some word classes and numbers lift to the threshold; no match is lost.

    Of the flags of word class, guessed class and number at most one each holds, so their largest weights bound them.
    """
    weight = dict(zip(FEATURES, w[:-1].tolist()))
    most = sum(max(0.0, *(weight[n] for n in FEATURES if n.startswith(group))) for group in ("class", "guess", "number"))
    z = F.lit(float(w[-1]) + most)
    for name in FORM_FEATURES:
        z = z + F.col(name) * F.lit(weight[name])
    return forms.where(z >= math.log(threshold / (1 - threshold)) - 1e-4)


def train_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60, ridge: float = 1.0) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last weight is the intercept. Without both labels: None-like
    prior weights that trust the skeleton and distrust every conflict."""
    if not (len(y) and 0 < y.sum() < len(y)):
        return np.array([2.0, -6.0, -3.0, -1.0, 2.0, -4.0, 1.5, -2.0, 2.0, -8.0, -4.0, -1.0])
    z = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (y - p) - ridge * w
        hess = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def isotonic(score: np.ndarray, y: np.ndarray) -> list[tuple[float, float]]:
    """Pool-adjacent-violators: (upper score of a block, calibrated probability), ascending."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []
    for s, t in zip(score[order], y[order]):
        if blocks and blocks[-1][0] == s:
            blocks[-1][1] += t
            blocks[-1][2] += 1
        else:
            blocks.append([float(s), float(t), 1.0])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            s2, t2, n2 = blocks.pop()
            blocks[-1] = [s2, blocks[-1][1] + t2, blocks[-1][2] + n2]
    return [(b[0], (b[1] + 0.5) / (b[2] + 1.0)) for b in blocks]


def matches(left_table: DataFrame, right_table: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Matched pairs ``(entry_id, ls_id, score, confidence)`` of the two dictionaries.

    score is the classifier's probability, confidence the calibrated one; pairs with a score of ``threshold`` or more
    are matches. Null fields count as unknown, never as equal. Copies of an article match each on their own. Empty
    tables give no rows; without weak labels of both kinds fixed prior weights are used. Building the result runs jobs:
    candidates are formed and the classifier is trained at once.
    """
    left, right = cut(left_side(left_table)), cut(right_side(right_table))
    forms = cut(candidate_forms(left, right))
    cited = lambda side: side.where(F.size("quotes") >= 2)
    # distant spellings became candidates by their quotations, so shared quotations would be a circular label for them:
    # of those only negative ones are used, out of a part of them
    close = (F.col("distance") <= CLOSE_DISTANCE) & (F.col("edits") <= 1.0)
    part = max(1, forms.count() // FAR_FORMS)
    taught = forms.where(close | (F.pmod(F.xxhash64("form", "ls_form"), F.lit(part)) == 0))
    labelled = pair_features(cited(left), cited(right), taught).where(F.col("label").isNotNull()).withColumn("draw", F.xxhash64("entry_id", "ls_id"))
    labelled = cut(labelled.withColumn("close", close))
    drawn = lambda df, n: df.orderBy("draw").limit(n).select(*FEATURES, "label", "draw")
    sample = drawn(labelled.where("close"), TRAIN_ROWS - FAR_ROWS).unionByName(drawn(labelled.where("NOT close AND label = 0"), FAR_ROWS)).toPandas().sort_values("draw")
    x, y = sample[list(FEATURES)].to_numpy(float), sample["label"].to_numpy(float)
    held = np.arange(len(y)) % 5 == 0
    w = train_logistic(x[~held], y[~held])
    logit = F.lit(float(w[-1]))
    for name, value in zip(FEATURES, w[:-1]):
        logit = logit + F.col(name) * F.lit(float(value))
    probability = F.round(1 / (1 + F.exp(-logit)), 6)
    steps = isotonic(np.round(1 / (1 + np.exp(-(x[held] @ w[:-1] + w[-1]))), 6), y[held]) if held.any() and 0 < y.sum() < len(y) else []
    confidence = F.lit(steps[-1][1]) if steps else F.col("score")
    for upper, value in reversed(steps[:-1]):
        confidence = F.when(F.col("score") <= upper, F.lit(value)).otherwise(confidence)
    pairs = pair_features(left, right, possible_forms(forms, w, threshold))
    scored = pairs.select("entry_id", "ls_id", probability.alias("score")).where(F.col("score") >= threshold)
    return scored.select("entry_id", "ls_id", "score", F.round(confidence, 6).alias("confidence"))
