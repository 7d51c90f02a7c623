"""Listings and point lookups: filters, orders, samples, form vocabularies, prefix tiers, corrections of entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.functions.fold import fold, letters_only, unaccent_lower
from lexispark.functions.strings import case_like, is_proper
from lexispark.operators.dictionary import all_of, with_children
from lexispark.operators.patch import append_note, apply_patch, raise_confidence

ASCII_CAPITALS, ASCII_SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def nocase(c: Column) -> Column:
    """Sort key that ignores the case of ASCII letters only."""
    return F.translate(c, ASCII_CAPITALS, ASCII_SMALL)


def conf_level(c: Column) -> Column:
    """high, med, low or none out of the spellings of a rating ('conf:high', ' HIGH '); null when empty."""
    return F.nullif(F.regexp_replace(F.lower(F.trim(c)), r"^conf:\s*", ""), F.lit(""))


def entry_with_children(entries: DataFrame, key: str, value: object, children: DataFrame, ref: str, order: str, fields: list[str], keep: dict[str, object] | None = None) -> DataFrame:
    """One entry with its children in order, those that meet the equalities in ``keep``; no row for an unknown key."""
    wanted = children.where((F.col(ref) == value) & all_of(keep or {}))
    return with_children(entries.where(F.col(key) == value), key, wanted, ref, order, fields)


def of_source(entries: DataFrame, lemma: str, value: str, sources: DataFrame, source: str, name: str, label: str) -> DataFrame:
    """Entries with a headword in one source, named by ``label`` of ``sources``."""
    mine = sources.where(F.col(name) == label).select(source)
    return entries.where(F.col(lemma) == value).join(F.broadcast(mine.limit(1)), source)


def rated(entries: DataFrame, conf: str, level: str | None, key: str, limit: int) -> DataFrame:
    """Entries of a rating (any without ``level``), the first ``limit`` by key."""
    return (entries if level is None else entries.where(conf_level(F.col(conf)) == level)).orderBy(key).limit(limit)


def random_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """``n`` rows drawn by a hash of key and seed: the same rows for the same seed, whatever the partitions."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), key).limit(n)


def any_of(column: Column, values: list[str]) -> Column:
    """Whether a text is one of the values, case ignored."""
    return F.lower(column).isin([v.lower() for v in values])


def in_fields(fields: list[str], text: str) -> Column:
    """Whether one of the fields contains the text, case ignored."""
    hit = F.lit(False)
    for f in fields:
        hit = hit | F.coalesce(F.contains(F.lower(f), F.lit(text.lower())), F.lit(False))
    return hit


def quoted_term(column: Column, term: str, quote: str = "'") -> Column:
    """Whether a text has the term in quotes, accents and case ignored."""
    return F.contains(unaccent_lower(column), F.concat(F.lit(quote), unaccent_lower(F.lit(term)), F.lit(quote)))


def exact_or_listed(column: Column, value: str) -> Column:
    """Whether a text is the value or begins with it and a comma."""
    return (F.lower(column) == value.lower()) | F.startswith(F.lower(column), F.lit(value.lower() + ","))


def best_with_prefixes(words: DataFrame, key: str, word: str, entries: DataFrame, exact: list[str], prefix: str, order: list[str], least: int = 3) -> DataFrame:
    """Best entry of every word: ``(key, tier, *order)``, by equality with the columns of ``exact`` in turn, then as a
    prefix (of ``least`` letters or more) of ``prefix``; within a tier the smallest of ``order``.

    Prefixes are looked up by an equi-join: every entry offers the beginnings of its headword that are as long as some
    open word, and has been reduced to the best entry per beginning before.
    """
    w = words.select(key, F.col(word).alias("__w")).where("__w IS NOT NULL").distinct()
    best, left = None, w
    for tier, column in enumerate(exact):
        offer = entries.groupBy(F.col(column).alias("__w")).agg(F.min(F.struct(*order)).alias("__b"))
        found = left.join(offer, "__w").select(key, F.lit(tier).alias("tier"), "__b")
        best = found if best is None else best.unionByName(found)
        left = left.join(offer.select("__w"), "__w", "left_anti")
    sizes = F.broadcast(left.where(F.length("__w") >= least).agg(F.collect_set(F.length("__w")).alias("__n")))  # one row: the lengths of words
    cut = entries.crossJoin(sizes).select(*order, F.explode(F.transform(F.filter("__n", lambda n: n <= F.length(prefix)), lambda n: F.substring(F.col(prefix), F.lit(1), n))).alias("__w"))
    offer = cut.groupBy("__w").agg(F.min(F.struct(*order)).alias("__b"))
    best = best.unionByName(left.where(F.length("__w") >= least).join(offer, "__w").select(key, F.lit(len(exact)).alias("tier"), "__b"))
    chosen = best.groupBy(key).agg(F.min(F.struct("tier", "__b")).alias("__c"))
    return chosen.select(key, "__c.tier", "__c.__b.*")


def form_hits(forms: DataFrame, entries: DataFrame, key: str, norm: str, form: str, wanted: list[str], limit: int) -> DataFrame:
    """Forms of the wanted spellings with their entries, by entry and form, the first ``limit``."""
    return forms.where(F.col(norm).isin(wanted)).join(entries, key).orderBy(key, form).limit(limit)


def vocabulary(entries: DataFrame, forms: DataFrame, key: str, lemma: str, norm: str, form: str) -> DataFrame:
    """Folded forms of entries (their headword where they have none) with the entries that have them: ``(form_key, n_entries,
    only)``; only is the entry of a form that is one entry's alone."""
    j = entries.select(key, F.col(lemma).alias("__l")).join(forms.select(key, F.coalesce(F.nullif(norm, F.lit("")), F.col(form)).alias("__f")), key, "left")
    pairs = j.select(unaccent_lower(F.coalesce("__f", "__l")).alias("form_key"), key).where("form_key != ''").distinct()
    g = pairs.groupBy("form_key").agg(F.count("*").alias("n_entries"), F.min(key).alias("only"))
    return g.select("form_key", "n_entries", F.when(F.col("n_entries") == 1, F.col("only")).alias("only"))


def headword_union(frames: list[DataFrame]) -> DataFrame:
    """Distinct headwords of one-column tables, in order of their lower case."""
    every = frames[0].toDF("lemma")
    for f in frames[1:]:
        every = every.unionByName(f.toDF("lemma"))
    return every.where("lemma IS NOT NULL").distinct().orderBy(F.lower("lemma"), "lemma")


def result_page(df: DataFrame, order: list[str], page: int, size: int, within: Column) -> DataFrame:
    """Rows of a page, pages counted from 1 and clamped to those there are, sorted by ``within`` inside the page."""
    from lexispark.operators.windows import numbered

    rn = numbered(df, order)
    last = rn.agg(F.greatest(F.lit(1), F.ceil(F.count("*") / size)).alias("__last"))
    at = F.least(F.greatest(F.lit(page), F.lit(1)), F.col("__last"))
    return rn.crossJoin(F.broadcast(last)).where(F.col("rn").between((at - 1) * size + 1, at * size)).select(*df.columns, "rn", at.cast("int").alias("page")).orderBy(within, *order)


def shown(df: DataFrame, term: str | None, size: int) -> DataFrame:
    """Results of a search: without a term only the first page, with one all of them."""
    return df.limit(size) if term is None else df


def assembled(pages: DataFrame, doc: str, page: str, text: str) -> DataFrame:
    """Documents of their pages in order, blank lines between; null texts and a page delivered twice add nothing."""
    p = pages.where(F.col(text).isNotNull() & F.col(page).isNotNull()).groupBy(doc, page).agg(F.min(text).alias("__t"))
    return p.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct(page, "__t"))).alias("__p")).select(doc, F.array_join(F.transform("__p", lambda x: x["__t"]), "\n\n").alias("body"))


def ocr_fix(df: DataFrame, fixes: DataFrame, key: str, stamp: str) -> DataFrame:
    """Entries with corrected headwords: ``fixes`` (key, new_lemma, reason, conf) holds a key once.

    The note keeps both spellings, time and reason; the rating becomes that of the fix unless it is high.
    """
    note = F.concat(F.lit(f"[ocr_fix {stamp}] "), F.coalesce("p_reason", F.lit("auto")), F.lit(" | lemma_in='"), F.col("lemma"), F.lit("' → '"), F.col("p_new_lemma"), F.lit("'"))
    high = conf_level(F.col("conf")) == "high"
    return apply_patch(df, fixes, key, {"lemma": F.col("p_new_lemma"), "notas": append_note(F.col("notas"), note, " | "), "conf": F.when(F.coalesce(high, F.lit(False)), F.col("conf")).otherwise(F.col("p_conf"))})


def mark_review(df: DataFrame, keys: DataFrame, key: str, flag: str = "needs_review") -> DataFrame:
    """Entries with the flag set for the given keys."""
    return apply_patch(df, keys.select(key).distinct(), key, {flag: F.lit(1).cast(dict(df.dtypes)[flag])})


def suggestion_updates(taken: DataFrame, entries: DataFrame, stamp: str) -> DataFrame:
    """Update payloads of chosen suggestions: ``(entry_id, status, old_lemma, new_lemma, payload)``.

    ``taken`` (suggestion_id, entry_id, lemma_in, new_lemma, reason, conf, by_id), ``entries`` (entry_id, lemma, label,
    conf). The new headword takes the case of the old one. Of several entries without a given id, a proper name whose
    letters would change is left to a person (REVIEW, no payload).
    """
    many = taken.groupBy("suggestion_id").agg(F.count("*").alias("__n"))
    j = taken.join(many, "suggestion_id").join(entries.select("entry_id", "lemma", "label", F.col("conf").alias("old_conf")), "entry_id")
    proper = is_proper(F.col("lemma")) | F.coalesce(F.lower("label").rlike(r"\bpropn|\bpróp|\bprop\."), F.lit(False))
    review = ~F.col("by_id") & (F.col("__n") > 1) & proper & (letters_only(F.col("lemma")) != letters_only(F.col("new_lemma")))
    new = case_like(F.col("lemma"), F.col("new_lemma"))
    note = F.concat(F.lit(f"[ocr_fix {stamp}] "), F.coalesce(F.nullif("reason", F.lit("")), F.lit("auto")), F.lit(" | lemma_in='"), F.col("lemma_in"), F.lit("' → '"), F.col("new_lemma"), F.lit("'"))
    conf = F.coalesce(F.when(F.col("conf").isin("conf:high", "conf:med", "conf:low"), F.col("conf")), F.col("old_conf"))
    payload = F.to_json(F.struct(F.lit("UPDATE").alias("action"), F.col("entry_id").alias("id"), F.col("lemma").alias("old_lemma"), new.alias("new_lemma"), conf.alias("conf_set"), F.lit(False).alias("def_changed"), note.alias("note")))
    return j.select("suggestion_id", "entry_id", F.when(review, "REVIEW").otherwise("UPDATE").alias("status"), F.col("lemma").alias("old_lemma"), F.when(~review, new).alias("new_lemma"), F.when(~review, payload).alias("payload"))


def lower_confidence(conf: Column, conflict: Column) -> Column:
    """Rating of a suggestion whose word class conflicts with the entry: high falls to med."""
    return F.when(F.coalesce(conflict, F.lit(False)) & (conf == "high"), "med").otherwise(conf)


def raised(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Entries whose rating is at least med for the given keys."""
    return apply_patch(df, keys.select(key).distinct(), key, {"conf": raise_confidence(F.col("conf"))})


def delete_vowel_marks(c: Column) -> Column:
    """Vowels with a macron or breve are left out, not folded."""
    return F.regexp_replace(c, "[āēīōūȳăĕĭŏŭĀĒĪŌŪȲĂĔĬŎŬ]", "")


def transliterated(c: Column) -> Column:
    """Lower-case ASCII: accents folded, ligatures and special letters written out, other letters dropped."""
    x = F.translate(F.lower(fold(c)), "łıđħŧ", "lidht")
    for sign, plain in (("æ", "ae"), ("œ", "oe"), ("ß", "ss"), ("ø", "o"), ("þ", "th"), ("ð", "d"), ("…", "..."), ("—", "--"), ("–", "-"), ("’", "'"), ("‘", "'"), ("“", '"'), ("”", '"'), ("«", "<<"), ("»", ">>")):
        x = F.replace(x, F.lit(sign), F.lit(plain))
    return F.regexp_replace(x, r"[^\x00-\x7F]", "")


def csv_ids(text: str) -> list[int]:
    """Numbers of a list such as '1,2;3'; blanks and empty places are skipped."""
    return [int(x) for x in text.replace(";", ",").split(",") if x.strip()]
