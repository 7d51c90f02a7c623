"""Fuzzy matching: bigram Jaccard, spelling variants, close matches, gates."""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.functions.fold import latin_key, unaccent_lower
from lexispark.session import ship_package

# Letters that scanning swaps, prefixes of compounds, and words that tell the name of a people or place.
SWAPS = (("o", "u"), ("u", "o"), ("rn", "m"), ("m", "rn"), ("cl", "d"), ("d", "cl"), ("æ", "ae"), ("œ", "oe"), ("j", "i"), ("v", "u"), ("ſ", "s"))
PREFIXES = ("ab", "ad", "con", "de", "dis", "ex", "in", "inter", "ob", "per", "post", "prae", "pro", "re", "sub", "super", "trans")
GENTILIC = ("people", "orum", "civitas", "urbs", "flumen", "gentilic", "populus", "povo", "cidade", "rio", "gentílico", "gentilício")
BLOCK = 512  # words in a block
SLACK = 1e-6  # bounds are rounded; the similarity itself is compared exactly


def bigrams(c: Column) -> Column:
    """Distinct pairs of neighbouring letters; a text of one letter or none gives itself."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 1, F.lit(1))), lambda i: F.substring(c, i, F.lit(2))))


def bigram_ratio(a: Column, b: Column) -> Column:
    """Jaccard similarity of bigram sets; two empty texts are equal."""
    common, every = F.size(F.array_intersect(bigrams(a), bigrams(b))), F.size(F.array_union(bigrams(a), bigrams(b)))
    return F.when((a == "") & (b == ""), 1.0).otherwise(common / every)


def bigram_matches(left: DataFrame, left_key: str, right: DataFrame, right_key: str, least: float) -> DataFrame:
    """Every pair of distinct words whose bigram sets have a Jaccard similarity of ``least`` or more: ``(word, match, ratio)``.

    Blocks of words whose set sizes allow the similarity meet, wherever the words differ; the common bigrams of all
    pairs of two blocks are one product of 0/1 matrices. Sets of bigrams overlap too much for prefixes of rare bigrams
    to leave few pairs. Memory in a task is one pair of blocks.
    """
    spark = left.sparkSession
    ship_package(spark)
    side = lambda df, key, name: df.select(F.col(key).alias(name)).where(F.col(name).isNotNull()).distinct().select(name, F.lit("").alias("k"), F.size(bigrams(F.col(name))).alias("len"))
    sizes = F.sequence(F.ceil(F.col("len") * least - SLACK).cast("int"), F.floor(F.col("len") / least + SLACK).cast("int"))
    a = _blocks(side(left, left_key, "word"), "word").select("k", F.col("len").alias("word_len"), F.col("block").alias("word_block"), "word", F.explode(sizes).alias("len"))
    pairs = a.join(_blocks(side(right, right_key, "match"), "match"), ["k", "len"])
    # all that meets a block of words is in one task, one block after the other
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = pairs.repartition(parts, "word_len", "word_block").sortWithinPartitions("word_len", "word_block").select("word", "match")
    grams = lambda w: {w[i : i + 2] for i in range(max(len(w) - 1, 1))}

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: list[str] = []
        for batch in batches:
            for xs, ys in zip(batch["word"], batch["match"]):
                xs, ys = xs.as_py(), ys.as_py()
                if xs != known:
                    known, x = xs, [grams(w) for w in xs]
                    spot = {g: i for i, g in enumerate(set().union(*x))}
                    one = np.zeros((len(x), len(spot)), np.float32)
                    one[np.repeat(np.arange(len(x)), len(x[0])), [spot[g] for s in x for g in s]] = 1
                y = [[spot[g] for g in grams(w) if g in spot] for w in ys]
                two = np.zeros((len(y), len(spot)), np.float32)
                two[np.repeat(np.arange(len(y)), [len(s) for s in y]), np.array([g for s in y for g in s], int)] = 1
                both = len(x[0]) + len(grams(ys[0]))  # set sizes are equal in a block
                common = one @ two.T
                i, j = np.nonzero(common >= np.float32(least * both / (1 + least) - 1e-3))
                ratio = common[i, j].astype(float) / (both - common[i, j])
                kept = ratio >= least
                i, j, ratio = i[kept], j[kept], ratio[kept]
                if len(i):
                    yield pa.record_batch([pa.array([xs[k] for k in i], pa.string()), pa.array([ys[k] for k in j], pa.string()), pa.array(ratio)], ["word", "match", "ratio"])

    return pairs.mapInArrow(score, "word string, match string, ratio double")


def swap_variants(c: Column, rounds: int = 1) -> Column:
    """The word and every form with a swap applied throughout; two rounds combine two swaps. Sorted, distinct."""
    acc = F.array(c)
    for _ in range(rounds):
        acc = F.array_distinct(F.flatten(F.transform(acc, lambda w: F.array(w, *[F.replace(w, F.lit(a), F.lit(b)) for a, b in SWAPS]))))
    return F.array_sort(acc)


def prefix_variants(c: Column) -> Column:
    """Forms with a hyphen after a known prefix, or without the hyphen that stands there."""
    made = [F.when(c.startswith(p + "-"), F.concat(F.lit(p), F.substring(c, len(p) + 2, 1 << 20))).when(c.startswith(p) & (F.length(c) > len(p)), F.concat(F.lit(p + "-"), F.substring(c, len(p) + 1, 1 << 20))) for p in PREFIXES]
    return F.array_sort(F.array_distinct(F.array_compact(F.array(c, *made))))


def spelling_variants(c: Column) -> Column:
    """All forms a headword may have been read from: prefix hyphens, each with up to two swaps. Sorted, distinct, none
    left out."""
    return F.array_sort(F.array_distinct(F.flatten(F.transform(prefix_variants(c), lambda x: swap_variants(x, 2)))))


def variant_matches(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Rows of both sides whose words meet after spelling variants: ``(left word, right word, ratio, distance)``."""
    l = left.select(F.col(left_key).alias("word")).where(F.col("word") != "").distinct().select("word", F.explode(spelling_variants(F.col("word"))).alias("variant"))  # noqa: E741
    r = right.select(F.col(right_key).alias("match")).where(F.col("match") != "").distinct()
    j = l.join(r, l["variant"] == r["match"]).select("word", "match").distinct()
    return j.select("word", "match", F.round(bigram_ratio(F.col("word"), F.col("match")), 6).alias("ratio"), F.levenshtein("word", "match").alias("distance"))


def best_match(pairs: DataFrame, group: str) -> DataFrame:
    """Best pair per word: largest ratio, then smallest distance, then the smaller match."""
    best = pairs.groupBy(group).agg(F.min(F.struct((-F.col("ratio")).alias("r"), "distance", "match")).alias("b"))
    return best.select(group, F.col("b.match").alias("match"), (-F.col("b.r")).alias("ratio"), F.col("b.distance").alias("distance"))


def _blocks(df: DataFrame, name: str) -> DataFrame:
    """Words of equal ``k`` and ``len`` in lists of about BLOCK: ``(k, len, block, words)``."""
    sizes = df.groupBy("k", "len").agg(F.count("*").alias("n"))
    block = F.pmod(F.xxhash64(name), F.ceil(F.col("n") / BLOCK))
    return df.join(sizes, ["k", "len"]).groupBy("k", "len", block.alias("block")).agg(F.collect_list(name).alias(name))


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the word, place in it and code point of every letter."""
    size = np.array([len(x) for x in words])
    word = np.repeat(np.arange(len(words)), size)
    code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    return word, np.arange(len(word)) - np.repeat(np.cumsum(size) - size, size), code


def _counted(word: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and letters sorted by both; a letter's n-th time in its word counts as a letter of its own."""
    order = np.lexsort((code, word))
    word, code = word[order], code[order]
    first = np.r_[True, (word[1:] != word[:-1]) | (code[1:] != code[:-1])]
    start = np.flatnonzero(first)
    return word, (code << 32) + np.arange(len(word)) - start[np.cumsum(first) - 1]


def likely_pairs(queries: list[str], words: list[str], least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs whose similarity may reach ``least`` of the query: (query, word, bound), indices and an upper bound.

    Matching letters are common to both words, and in the same order: they are no more than the common letters counted
    with repetition, and no more than the longest common subsequence (up to 63 letters). Both bounds lose nothing.
    """
    qw, qat, qcode = _letters(queries)
    ww, wat, wcode = _letters(words)
    total = np.array([len(x) for x in queries])[:, None] + np.array([len(x) for x in words])[None, :]
    (qi, qkey), (wi, wkey) = _counted(qw, qcode), _counted(ww, wcode)
    keys = np.unique(qkey)
    spot = np.minimum(np.searchsorted(keys, wkey), len(keys) - 1)
    known = keys[spot] == wkey
    left, right = np.zeros((len(queries), len(keys)), np.float32), np.zeros((len(words), len(keys)), np.float32)
    left[qi, np.searchsorted(keys, qkey)] = 1
    right[wi[known], spot[known]] = 1
    bound = 2.0 * (left @ right.T) / total
    i, j = np.nonzero(bound >= least[:, None] - SLACK)
    longest = int(qat.max()) + 1
    if longest > 63 or not len(i):
        return i, j, bound[i, j]
    codes = np.unique(qcode)
    masks = np.zeros((len(queries), len(codes) + 1), np.uint64)  # the last column is for letters no query has
    np.bitwise_or.at(masks, (qw, np.searchsorted(codes, qcode)), np.uint64(1) << qat.astype(np.uint64))
    place = np.minimum(np.searchsorted(codes, wcode), len(codes) - 1)
    text = np.full((len(words), int(wat.max()) + 1), len(codes))
    text[ww, wat] = np.where(codes[place] == wcode, place, len(codes))
    v = np.full(len(i), ~np.uint64(0))
    for at in range(text.shape[1]):  # bit-parallel: a zero in v is a letter of the common subsequence
        m = masks[i, text[j, at]]
        v = (v + (v & m)) | (v & ~m)
    own = (np.uint64(1) << np.array([len(x) for x in queries], np.uint64)) - np.uint64(1)
    bound = 2.0 * np.bitwise_count(~v & own[i]) / total[i, j]
    kept = bound >= least[i] - SLACK
    return i[kept], j[kept], bound[kept]


def close_matches(queries: DataFrame, query: str, words: DataFrame, word: str, n: int = 3, cutoff: float = 0.7) -> DataFrame:
    """Ratcliff-Obershelp matches of ``cutoff`` or more, the best ``n`` per query.

    Every word of a length class that the cutoff allows is a candidate. Blocks of words meet; bounds that lose nothing leave few pairs (``likely_pairs``), and those
    are compared from the highest bound down until no other can be among the best ``n``. All this runs over Arrow
    batches, as Spark has no such function. A task holds the best matches of its queries.
    """
    spark = queries.sparkSession
    ship_package(spark)
    span = 2.0 / cutoff - 1  # a longer word is at most this many times as long
    q = queries.select(F.col(query).alias("q")).where(F.col("q") != "").distinct().select("q", F.lit("").alias("k"), F.length("q").alias("len"))
    w = words.select(F.col(word).alias("w")).where(F.col("w") != "").distinct().select("w", F.lit("").alias("k"), F.length("w").alias("len"))
    lengths = F.sequence(F.ceil(F.col("len") / span - SLACK).cast("int"), F.floor(F.col("len") * span + SLACK).cast("int"))
    q = _blocks(q, "q").select("k", F.col("len").alias("q_len"), F.col("block").alias("q_block"), "q", F.explode(lengths).alias("len"))
    pairs = q.join(_blocks(w, "w"), ["k", "len"])
    # all that meets a block of queries is in one task, nearest lengths first
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = pairs.repartition(parts, "k", "q_len", "q_block").sortWithinPartitions(F.abs(F.col("len") - F.col("q_len"))).select("q", "w")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[str, list[tuple[float, str]]] = {}
        m = SequenceMatcher()
        for batch in batches:
            for qs, ws in zip(batch["q"], batch["w"]):
                qs, ws = qs.as_py(), ws.as_py()
                least = np.array([-best[x][-1][0] if len(best.get(x, ())) == n else cutoff for x in qs])
                i, j, bound = likely_pairs(qs, ws, least)
                at = -1
                for k in np.lexsort((-bound, i)):
                    if i[k] != at:
                        at = i[k]
                        m.set_seq2(qs[at])
                        top = best.setdefault(qs[at], [])
                    if len(top) == n and bound[k] < -top[-1][0] - SLACK:
                        continue
                    m.set_seq1(ws[j[k]])
                    ratio = m.ratio()
                    if ratio >= cutoff:
                        insort(top, (-ratio, ws[j[k]]))
                        del top[n:]
        out = [(x, rank, w, -r) for x, top in best.items() for rank, (r, w) in enumerate(top, 1)]
        if out:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int32(), pa.string(), pa.float64()))], ["q", "rank", "w", "ratio"])

    return pairs.mapInArrow(score, "q string, rank int, w string, ratio double").select("q", "rank", "w", F.round("ratio", 6).alias("ratio"))


def gentilic(*texts: Column) -> Column:
    """Whether definitions tell the name of a people or place."""
    blob = F.lower(F.concat_ws(" ", *texts))
    return F.exists(F.array(*[F.lit(x) for x in GENTILIC]), lambda x: F.contains(blob, x))


def gates(pairs: DataFrame, old: str, new: str, conf: str, prev: Column, nxt: Column, old_pos: Column, new_pos: Column, name: Column | None = None) -> DataFrame:
    """Gate results of suggested corrections: affix parity, similarity, alphabetical span, word class, final verdict.

    An affix becomes no word, nor a word an affix, unless both have one strict key. The span is open where a neighbour
    is missing. Unknown classes pass; noun and adjective interchange where ``name`` is true (see gentilic).
    """
    a, b = F.col(old), F.col(new)
    affix = lambda c: c.startswith("-") | c.endswith("-")
    parity = (affix(a) == affix(b)) | (latin_key(a) == latin_key(b))
    close = bigram_ratio(a, b) >= F.when(F.col(conf) == "high", 0.35).otherwise(0.5)
    span = prev.isNull() | nxt.isNull() | unaccent_lower(b).between(unaccent_lower(prev), unaccent_lower(nxt))
    nominal = old_pos.isin("NOUN", "ADJ") & new_pos.isin("NOUN", "ADJ")
    pos = (old_pos == "UNK") | (new_pos == "UNK") | (old_pos == new_pos) | (nominal & (F.lit(False) if name is None else name))
    out = pairs.withColumn("ok_affix", parity).withColumn("ok_similar", close).withColumn("ok_span", span).withColumn("ok_pos", pos)
    passed = F.col("ok_affix") & F.col("ok_similar") & F.col("ok_span")
    return out.withColumn("verdict", F.when(passed & F.col("ok_pos"), F.col(conf)).when(passed, F.when(F.col(conf) == "high", "med").otherwise("low")).otherwise("reject"))


def morph_guard(conf: Column, reason: Column, suggested: Column, own: Column, note: str = "conflito morfológico (LS vs entrada)") -> Column:
    """``(conf, reason)`` of a suggestion: where both word classes are known and differ, high falls to med with a note."""
    conflict = F.coalesce((suggested != "UNK") & (own != "UNK") & (suggested != own), F.lit(False)) & (conf == "high")
    return F.struct(F.when(conflict, "med").otherwise(conf).alias("conf"), F.when(conflict, F.concat_ws("; ", reason, F.lit(note))).otherwise(reason).alias("reason"))
