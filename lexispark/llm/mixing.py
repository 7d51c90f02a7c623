"""Mixing sources to target weights, measured in tokens of a public tokenizer.

Method: soft memberships. A naive Bayes classifier over hashed words and signs of form (punctuation, lengths of lines and
text), fitted on a bounded sample of the documents with a known source, gives the documents without one a posterior over
the sources; which kinds of features count is chosen on a held-out fifth of the sample. Labelled documents belong to
their source. Projected
gradient least squares then finds a nonnegative rate per document (its expected number of uses, capped by the source's
repeats) such that the expected tokens of every source match the targets. Documents with equal membership share one
rate, so labelled documents enter as one aggregate per source; documents with a soft membership are summed distributed
in every step. Rates become whole numbers of copies by a hash of the document id;
for labelled documents the hashes are cut where their tokens add up to the rate, not merely their number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.functions.fold import unaccent_lower
from lexispark.session import cut, ship_package

BUCKETS = 4096  # of each kind of features: words, and signs of form
FIT_ROWS = 20_000  # labelled documents the classifier is fitted on, about: the bound of the sample
HELD_OUT = 5
DRAW_BINS = 4096
MAX_SOURCES = 1000  # sources and targets are read to the driver; more targets are an error, other sources are pooled
OTHERS = "(other sources)"
STEPS = 40
TOLERANCE = 1e-5
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"


def with_tokens(df: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """``doc_id, source, n_tokens, words`` of ``(doc_id, source, text)``: whole texts counted in tokens, each once; words
    are the hashed words of documents without a source, null for others."""
    spark = df.sparkSession
    ship_package(spark)
    model = spark.sparkContext.broadcast(Path(tokenizer).read_text())  # one vocabulary file, 1.6 MB

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        t = Tokenizer.from_str(model.value)
        t.encode_special_tokens = True
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sizes = [len(e.ids) for i in range(0, len(texts), 256) for e in t.encode_batch(texts[i : i + 256], add_special_tokens=False)]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "source": batch.column("source"), "n_tokens": pa.array(sizes, pa.int64()), "words": batch.column("words")})

    words = F.when(F.col("source").isNull(), _hashed_words(F.col("text")))
    return df.select("doc_id", "source", "text", words.alias("words")).mapInArrow(count, "doc_id bigint, source string, n_tokens bigint, words array<int>")


def _hashed_words(text: Column) -> Column:
    """Buckets of a document's features: its words, then (from BUCKETS on) its signs of form."""
    bucket = lambda x: F.pmod(F.xxhash64(x), F.lit(BUCKETS)).cast("int")
    words = F.transform(F.filter(F.split(unaccent_lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != ""), bucket)
    lines = F.split(text, "\n")
    signs = F.regexp_extract_all(F.regexp_replace(F.regexp_replace(text, r"\p{Ll}+", "a"), r"\d+", "9"), F.lit(r"([^\p{L}\p{N}\s].?|9)"), 1)
    size = lambda n, name: F.concat(F.lit(name), F.floor(F.log2(n + 1) * 2).cast("string"))
    form = F.concat(F.array(size(F.size(lines), "lines"), size(F.length(text), "chars")), F.transform(lines, lambda x: F.concat(F.lit("line"), F.floor(F.length(x) / 10).cast("string"))), signs)
    return F.concat(words, F.transform(form, lambda x: bucket(x) + BUCKETS))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents and feature buckets per source, summed over a whole partition before anything is sent; bucket -1 counts
    the documents."""
    names: list[str] = []
    place: dict[str, int] = {}
    total = np.zeros((0, 2 * BUCKETS + 1), np.int64)
    width = total.shape[1]
    for batch in batches:
        lists = batch.column("words")
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        owner = pa.compute.list_parent_indices(lists).to_numpy(zero_copy_only=False)
        source = batch.column("source").dictionary_encode()
        for name in source.dictionary.to_pylist():
            if name not in place:
                place[name] = len(names)
                names.append(name)
        if len(names) > len(total):
            total = np.vstack([total, np.zeros((len(names) - len(total), width), np.int64)])
        code = np.array([place[n] for n in source.dictionary.to_pylist()], np.int64)[source.indices.to_numpy(zero_copy_only=False)]
        total += np.bincount(np.r_[code[owner] * width + flat + 1, code * width], minlength=total.size).reshape(total.shape)
    for name, c in zip(names, total):
        at = np.flatnonzero(c)
        yield pa.record_batch({"source": pa.array([name] * len(at), pa.string()), "bucket": pa.array(at - 1, pa.int32()), "n": pa.array(c[at], pa.int64())})


KINDS = ((1.0, 0.0), (0.0, 1.0), (1.0, 1.0))  # weights of words and form


def fitted(labelled: DataFrame, names: list[str], weights: tuple[float, float]) -> tuple[np.ndarray, np.ndarray]:
    """Naive Bayes over ``(source, words)``: log feature weights and log priors of ``names``."""
    counted = labelled.mapInArrow(_word_counts, "source string, bucket int, n bigint").groupBy("source", "bucket").agg(F.sum("n").alias("n")).toArrow()  # at most sources x buckets rows
    table, docs = np.ones((len(names), 2 * BUCKETS)), np.zeros(len(names))
    spot = {n: i for i, n in enumerate(names)}
    row, at, n = np.array([spot[x] for x in counted["source"].to_pylist()], int), counted["bucket"].to_numpy(), counted["n"].to_numpy()
    docs[row[at < 0]] = n[at < 0]
    table[row[at >= 0], at[at >= 0]] += n[at >= 0]
    for kind, weight in enumerate(weights):
        part = slice(kind * BUCKETS, (kind + 1) * BUCKETS)
        table[:, part] = weight * np.log(table[:, part] / table[:, part].sum(axis=1, keepdims=True))
    # a source without documents gets no membership
    return table, np.where(docs > 0, np.log(np.maximum(docs, 1) / max(docs.sum(), 1)), -1e9)


def with_posteriors(df: DataFrame, model: tuple[np.ndarray, np.ndarray], keep: str) -> DataFrame:
    """``keep`` columns (a schema) of ``df`` with ``p``, the posterior over the model's sources by its column ``words``."""
    sent = df.sparkSession.sparkContext.broadcast(model)
    columns = [c.split()[0] for c in keep.split(", ")]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_given, base = sent.value
        for batch in batches:
            lists = batch.column("words")
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            owner = pa.compute.list_parent_indices(lists).to_numpy(zero_copy_only=False)
            n = batch.num_rows
            z = base + np.stack([np.bincount(owner, weights=words_given[k, flat], minlength=n) for k in range(len(base))], axis=1)
            z = np.exp(z - z.max(axis=1, keepdims=True))
            p = z / z.sum(axis=1, keepdims=True)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * len(base), pa.int32()), pa.array(p.ravel()))
            yield pa.record_batch({**{c: batch.column(c) for c in columns}, "p": lists})

    return df.select(*columns, "words").mapInArrow(score, f"{keep}, p array<double>")


def held_out_quality(sample: DataFrame, names: list[str], weights: tuple[float, float]) -> tuple[int, float, float]:
    """How a classifier of these features does on the fifth of ``sample`` (source, words, held) it has not seen: number of
    documents, share whose likeliest source is theirs, mean posterior of their source."""
    scored = with_posteriors(sample.where("held"), fitted(sample.where("NOT held").select("source", "words"), names, weights), "source string")
    own = F.get("p", F.array_position(F.array(*[F.lit(n) for n in names]), F.col("source")).cast("int") - 1)
    r = scored.select(own.alias("own"), F.array_max("p").alias("top")).agg(F.count("*").alias("n"), F.avg((F.col("own") == F.col("top")).cast("double")).alias("hit"), F.avg("own").alias("own")).first()
    return r["n"], r["hit"] or 0.0, r["own"] or 0.0


def source_model(rows: DataFrame, names: list[str], n_rows: int) -> tuple[tuple[np.ndarray, np.ndarray], tuple[int, float, float]]:
    """The classifier of the sources ``names``, and its quality on held-out documents.

    ``rows`` (doc_id, source, text), ``n_rows`` their number. About FIT_ROWS of them, drawn by a hash of their ids, are
    used; the kinds of features are those with the largest mean posterior of the true source on the held-out fifth.
    """
    draw = lambda seed: F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 20))
    some = rows.where(F.col("source").isin(names) & (draw("fit") < max(1, math.ceil((1 << 20) * min(1.0, FIT_ROWS / max(n_rows, 1))))))
    sample = cut(some.select("source", _hashed_words(F.col("text")).alias("words"), (F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(HELD_OUT)) == 0).alias("held")))
    quality = {w: held_out_quality(sample, names, w) for w in KINDS}
    best = max(KINDS, key=lambda w: quality[w][2])
    return fitted(sample.select("source", "words"), names, best), quality[best]


def _draw() -> Column:
    """A number from 0 to 1 that belongs to a document."""
    return F.pmod(F.xxhash64("doc_id", F.lit("mix")), F.lit(1 << 30)) / F.lit(float(1 << 30))


class Mix:
    """Rates that bring the sources to their target shares, and what comes of them.

    ``documents`` (doc_id, text, source) are mixed to ``targets`` (source, target_share, max_repeat). Sources without a
    target are not drawn; where there are more than MAX_SOURCES sources, the smallest without a target are summed as
    one, "(other sources)". A target without documents cannot be reached and stays in the report with share 0. Documents
    without tokens are never drawn; null ids are ignored. ``total_tokens`` defaults to the largest total at which every
    target with documents can be met. ``quality`` is that of the classifier on held-out documents, see held_out_quality.
    Building a mix runs jobs: counts, the classifier, and one per gradient step.
    """

    quality: tuple[int, float, float] | None = None

    def __init__(self, documents: DataFrame, targets: DataFrame, total_tokens: float | None = None, tokenizer: str = TOKENIZER, key: str = "doc_id", text: str = "text", source: str = "source"):
        wanted = targets.where(F.col("source").isNotNull()).groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeat").alias("max_repeat")).orderBy("source").limit(MAX_SOURCES + 1).collect()
        if len(wanted) > MAX_SOURCES:
            raise ValueError(f"more than {MAX_SOURCES} targets")
        rows = documents.select(F.col(key).cast("bigint").alias("doc_id"), F.col(source).cast("string").alias("source"), F.coalesce(F.col(text), F.lit("")).alias("text")).where(F.col("doc_id").isNotNull())
        self.tokens = cut(with_tokens(rows, tokenizer))
        mine = F.col("source").isNull() | F.col("source").isin([r["source"] for r in wanted])
        count = lambda df: df.groupBy("source").agg(F.count("*").alias("n"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("t"))
        top = count(self.tokens).withColumn("mine", mine).orderBy(F.desc("mine"), F.desc("t"), "source").limit(len(wanted) + MAX_SOURCES + 2).collect()
        others, room = [r["source"] for r in top if not r["mine"]], MAX_SOURCES - len(wanted)
        if len(others) > room:  # targets and unlabelled documents stay as they are
            pool = OTHERS
            while any(pool == r["source"] for r in wanted):
                pool += "*"
            named = F.when(mine | F.col("source").isin(others[:room]), F.col("source")).otherwise(pool)
            rows, self.tokens = rows.withColumn("source", named), self.tokens.withColumn("source", named)
            top = count(self.tokens).collect()  # at most MAX_SOURCES, the pool and null
        supply = {r["source"]: (r["n"], r["t"]) for r in top}
        self.names = sorted({r["source"] for r in wanted} | {s for s in supply if s is not None})
        k = len(self.names)
        self.share, self.repeat = np.zeros(k), np.zeros(k)
        for r in wanted:
            self.share[self.names.index(r["source"])], self.repeat[self.names.index(r["source"])] = r["target_share"] or 0.0, r["max_repeat"] or 0
        self.docs = np.array([supply.get(s, (0, 0))[0] for s in self.names], float)
        self.supply = np.array([supply.get(s, (0, 0))[1] for s in self.names], float)
        self.soft = None
        if None in supply and k:
            model, self.quality = source_model(rows, self.names, int(self.docs.sum()))
            self.soft = cut(with_posteriors(self.tokens.where(F.col("source").isNull()), model, "doc_id bigint, n_tokens bigint"))
        can = (self.share > 0) & (self.supply > 0) & (self.repeat > 0)
        self.total = float(total_tokens) if total_tokens else float(min((self.supply * self.repeat / np.where(self.share > 0, self.share, 1))[can], default=0.0))
        self._fit()

    def _soft_rate(self) -> Column:
        """Rate of a softly labelled document: the history of gradient steps replayed on its membership."""
        cap = self.repeat
        best = F.array_position("p", F.array_max("p"))
        limit = F.element_at(F.array(*[F.lit(float(x)) for x in cap]), best.cast("int"))
        steps = F.array(*[F.array(*[F.lit(float(v)) for v in g]) for g in self.steps]) if self.steps else F.array().cast("array<array<double>>")
        pull = lambda g: F.aggregate(F.zip_with("p", g, lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
        return F.aggregate(steps, F.lit(0.0), lambda r, g: F.least(F.greatest(r - pull(g), F.lit(0.0)), limit))

    def _soft_tokens(self) -> np.ndarray:
        if self.soft is None or not self.steps:
            return np.zeros(len(self.names))
        drawn = self.soft.select((self._soft_rate() * F.col("n_tokens")).alias("t"), "p").select(*[F.sum(F.col("t") * F.get("p", F.lit(i))).alias(f"s{i}") for i in range(len(self.names))]).first()
        return np.array([float(x or 0.0) for x in drawn])

    def _fit(self) -> None:
        """Projected gradient on sum_k ((tokens_k - target_k) / supply_k)^2, every source scaled by its own supply."""
        target = self.total * self.share
        self.rate = np.zeros(len(self.names))
        self.steps: list[np.ndarray] = []
        scale = np.maximum(self.supply, 1.0)
        for _ in range(STEPS if self.total else 0):
            residual = (self.rate * self.supply + self._soft_tokens() - target) / scale
            step = 0.7 * residual
            moved = np.clip(self.rate - step, 0.0, self.repeat)
            done = np.abs(moved - self.rate).max() < TOLERANCE
            self.rate = moved
            if self.soft is not None:
                self.steps.append(np.where((self.share > 0) & (self.repeat > 0), step, 0.0))
            if done:
                break

    def _thresholds(self) -> dict[str, float]:
        """Draws below which a source's documents get one more copy, so that their tokens add up to the fraction of its rate."""
        part = self.rate - np.floor(self.rate)
        known = self.tokens.where(F.col("source").isNotNull() & (F.col("n_tokens") > 0))
        # one row a source and bin of draws, at most MAX_SOURCES x DRAW_BINS
        bins = known.groupBy("source", F.floor(_draw() * DRAW_BINS).cast("int").alias("bin")).agg(F.sum("n_tokens").alias("t")).toArrow()
        spot = {n: i for i, n in enumerate(self.names)}
        held = np.zeros((len(self.names), DRAW_BINS))
        for name, at, t in zip(bins["source"].to_pylist(), bins["bin"].to_pylist(), bins["t"].to_pylist()):
            held[spot[name], at] = t
        out = {}
        for i, name in enumerate(self.names):
            upto = np.r_[0.0, np.cumsum(held[i])]
            want = part[i] * upto[-1]
            at = min(int(np.searchsorted(upto, want, "right")) - 1, DRAW_BINS - 1)
            inside = (want - upto[at]) / held[i, at] if held[i, at] else 0.0
            out[name] = (at + min(inside, 1.0)) / DRAW_BINS
        return out

    def copies(self) -> DataFrame:
        """``(doc_id, source, n_tokens, copies)`` of the documents drawn; source is null for soft memberships."""
        numbers = lambda values: F.create_map(*[F.lit(x) for n, v in values for x in (n, float(v))]) if self.names else F.create_map().cast("map<string,double>")
        whole, more = numbers(zip(self.names, np.floor(self.rate))), numbers(self._thresholds().items())
        pick = lambda table: F.coalesce(table[F.col("source")], F.lit(0.0))
        both = self.tokens.where(F.col("source").isNotNull()).select("doc_id", "source", "n_tokens", pick(whole).alias("whole"), pick(more).alias("more"))
        if self.soft is not None:
            rate = self.soft.select("doc_id", "n_tokens", self._soft_rate().alias("rate"))
            both = both.unionByName(rate.select("doc_id", F.lit(None).cast("string").alias("source"), "n_tokens", F.floor("rate").cast("double").alias("whole"), (F.col("rate") - F.floor("rate")).alias("more")))
        copies = (F.col("whole") + F.when(_draw() < F.col("more"), 1).otherwise(0)).cast("int")
        return both.select("doc_id", "source", "n_tokens", copies.alias("copies")).where((F.col("copies") > 0) & (F.col("n_tokens") > 0))

    def report(self) -> DataFrame:
        """Per source: documents, tokens, target and actual share of the tokens drawn, and whether the target can be met."""
        drawn = self.copies().select("doc_id", "source", (F.col("n_tokens") * F.col("copies")).alias("t"), "copies")
        hard = drawn.where(F.col("source").isNotNull()).select("source", F.col("t").cast("double").alias("t"), F.lit(1.0).alias("w"), "copies")
        parts = hard
        if self.soft is not None:
            member = self.soft.select("doc_id", F.posexplode("p").alias("i", "w"))
            names = F.array(*[F.lit(n) for n in self.names])
            soft = drawn.where(F.col("source").isNull()).drop("source").join(member, "doc_id").select(F.get(names, F.col("i")).alias("source"), (F.col("t") * F.col("w")).alias("t"), "w", "copies")
            parts = hard.unionByName(soft)
        sums = parts.groupBy("source").agg(F.sum("t").alias("tokens_drawn"), F.sum("w").alias("docs_drawn"), F.coalesce(F.max(F.when(F.col("w") >= 0.5, F.col("copies"))), F.lit(0)).alias("most_copies"))
        base = self.tokens.sparkSession.createDataFrame(
            [(n, int(d), int(s), float(sh), int(rp), bool(s * rp + 1e-6 >= self.total * sh and (s > 0 or sh == 0))) for n, d, s, sh, rp in zip(self.names, self.docs, self.supply, self.share, self.repeat)],
            "source string, docs_available bigint, tokens_available bigint, target_share double, max_repeat int, reachable boolean",
        )
        all_tokens = parts.agg(F.sum("t").alias("all_tokens"))
        out = base.join(sums, "source", "left").crossJoin(F.broadcast(all_tokens))  # one row
        share = F.round(F.coalesce(F.col("tokens_drawn") / F.col("all_tokens"), F.lit(0.0)), 6)
        return out.select("source", "docs_available", "tokens_available", "max_repeat", "reachable", F.round(F.coalesce("docs_drawn", F.lit(0.0)), 3).alias("docs_drawn"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"), F.round(F.coalesce("tokens_drawn", F.lit(0.0)), 1).alias("tokens_drawn"), "target_share", share.alias("actual_share"))
