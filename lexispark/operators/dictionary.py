"""Assembling dictionaries: examples, star joins, canonical entries, corrections, review payloads, links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.functions.citation import split_reference
from lexispark.functions.fold import dictionary_key, words_only
from lexispark.operators import fuzzy
from lexispark.operators.search import search


def all_of(conditions: dict[str, object]) -> Column:
    """Conjunction of the equalities whose value is given; without any, true."""
    out = F.lit(True)
    for name, value in conditions.items():
        if value is not None:
            out = out & (F.col(name) == value)
    return out


def examples(entries: DataFrame, key: str, text: str) -> DataFrame:
    """Citations in brackets of a definition with their parts: one row each, numbered within the entry."""
    refs = entries.select(F.col(key).alias("entry_id"), F.posexplode(F.regexp_extract_all(text, F.lit(r"\(([^()]+)\)"), 1)).alias("n", "raw_ref"))
    return refs.select("entry_id", (F.col("n") + 1).alias("n"), "raw_ref", split_reference(F.col("raw_ref")).alias("r")).select("entry_id", "n", "raw_ref", "r.*")


def search_examples(table: DataFrame, query: str | None = None, status: str | None = None, fonte: str | None = None, obra: str | None = None, least: float | None = None, limit: int = 20) -> DataFrame:
    """Examples by status, parts of author and work (case ignored), confidence and full text, best first."""
    keep = F.lit(True)
    if status is not None:
        keep = keep & (F.coalesce("status", F.lit("invalido")) == status)
    if fonte is not None:
        keep = keep & F.contains(F.lower("fonte"), F.lit(fonte.lower()))
    if obra is not None:
        keep = keep & F.contains(F.lower("obra"), F.lit(obra.lower()))
    if least is not None:
        keep = keep & (F.coalesce("confidence", F.lit(0.0)) >= least)
    rows = table.where(keep)
    if query is None:
        return rows.withColumn("score", F.lit(0.0)).orderBy("entry_id", "n").limit(limit)
    return search(rows, query, ["raw_ref"], table.columns).orderBy("score", "entry_id", "n").limit(limit)


def with_children(parents: DataFrame, key: str, children: DataFrame, ref: str, order: str, fields: list[str], name: str = "children") -> DataFrame:
    """Parents with their children as an ordered array; parents without any get an empty one."""
    lists = children.where(F.col(ref).isNotNull()).groupBy(F.col(ref).alias(key)).agg(F.array_sort(F.collect_list(F.struct(order, *[f for f in fields if f != order]))).alias(name))
    out = parents.join(lists, key, "left")
    return out.withColumn(name, F.coalesce(name, F.array().cast(dict(lists.dtypes)[name])))


def first_children(children: DataFrame, group: str, order: list[str], k: int) -> DataFrame:
    """At most ``k`` children per parent in a total order."""
    from lexispark.operators.publish import first_per_group

    return first_per_group(children, [group], [F.col(c) for c in order], k)


def canonical_entries(sources: dict[str, DataFrame]) -> DataFrame:
    """Entries of several dictionaries in one shape: source, id, lemma, key, pos, gloss (the first non-blank one), notes.

    Each source has columns id, lemma, pos, notes and gloss columns gloss_1, gloss_2, … in order of preference.
    """
    out = None
    for name, df in sources.items():
        glosses = sorted(c for c in df.columns if c.startswith("gloss_"))
        gloss = F.coalesce(*[F.when(F.trim(c) != "", F.col(c)) for c in glosses])
        part = df.select(F.lit(name).alias("source"), F.col("id").cast("string").alias("id"), "lemma", dictionary_key(F.col("lemma")).alias("key"), "pos", gloss.alias("gloss"), "notes")
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no sources")
    return out


def embedding_text(entry: dict[str, Column]) -> Column:
    """Text that stands for an entry in a vector index: its non-blank parts joined by ' | '."""
    return F.concat_ws(" | ", *[F.nullif(F.trim(c), F.lit("")) for c in entry.values()])


def suggest_fixes(entries: DataFrame, key: str, lemma: str, trusted: DataFrame, trusted_lemma: str, second: DataFrame, second_lemma: str, accept: float = 0.58, high: float = 0.85) -> DataFrame:
    """Corrections of headwords: (key, lemma, suggestion, ratio, distance, conf, reason).

    A headword found in the trusted dictionary needs none. Its spelling variants are looked up there; the best by ratio,
    then distance, is accepted from ``accept`` on, with high confidence from ``high`` on or where a second dictionary
    knows the suggestion too. Headwords only the second dictionary knows are left as they are.
    """
    own = entries.select(F.col(key).alias("key"), words_only(F.col(lemma)).alias("word")).where("word != ''")
    known = trusted.select(words_only(F.col(trusted_lemma)).alias("word")).where("word != ''").distinct()
    other = second.select(words_only(F.col(second_lemma)).alias("word")).where("word != ''").distinct()
    open_words = own.join(known, "word", "left_anti").join(other, "word", "left_anti")
    best = fuzzy.best_match(fuzzy.variant_matches(open_words, "word", known, "word"), "word").where(F.col("ratio") >= accept)
    backed = best.join(other.select(F.col("word").alias("match"), F.lit(True).alias("backed")), "match", "left")
    conf = F.when((F.col("ratio") >= high) | F.col("backed"), "high").otherwise("med")
    reason = F.when(F.col("backed"), "variant+second").otherwise("variant")
    return open_words.join(backed.select("word", F.col("match").alias("suggestion"), "ratio", "distance", conf.alias("conf"), reason.alias("reason")), "word").select("key", F.col("word").alias("lemma"), "suggestion", "ratio", "distance", "conf", "reason")


def group_payload(rows: DataFrame, group: str, order: str, fields: list[str], evidence: DataFrame) -> DataFrame:
    """One review payload per group: its rows in order and its evidence lines, as JSON; evidence only where there is any."""
    items = rows.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(order, *[f for f in fields if f != order]))).alias("items"))
    lines = evidence.groupBy(group).agg(F.array_join(F.array_sort(F.collect_set("line")), "\n").alias("evidence"))
    joined = items.join(lines, group, "left")
    return joined.select(group, F.to_json(F.struct(F.col(group).alias("group"), "items", "evidence")).alias("payload"))


def evidence_line(source: str, lemma: Column, text: Column, size: int = 160) -> Column:
    """One line of evidence: source, headword and the beginning of its text."""
    cut = F.when(F.length(text) > size, F.concat(F.substring(text, 1, size), F.lit("…"))).otherwise(F.coalesce(text, F.lit("")))
    return F.concat_ws(" — ", F.lit(source), lemma, F.nullif(cut, F.lit("")))


DECISION = "struct<id:string,action:string,redirect_to:string,canonical_group:string,reasons:array<string>>"


def parse_decisions(lines: DataFrame, column: str, prefix: str = "dedupe::") -> DataFrame:
    """Decisions out of response lines: (group_id, id, action, redirect_to, error); an unreadable line gives its error."""
    r = F.from_json(column, f"struct<custom_id:string,parsed:struct<results:array<{DECISION}>>,content:string>")
    inner = F.from_json("r.content", f"struct<results:array<{DECISION}>>")
    x = lines.select(r.alias("r")).select("r", F.coalesce(F.col("r.parsed.results"), inner["results"]).alias("results"))
    error = F.when(F.col("r.custom_id").isNull() | ~F.startswith("r.custom_id", F.lit(prefix)), "bad_custom_id").when(F.col("results").isNull(), "no_results")
    flat = x.select(F.regexp_replace("r.custom_id", f"^{prefix}", "").alias("group_id"), error.alias("error"), F.explode_outer("results").alias("d"))
    return flat.select("group_id", F.col("d.id").alias("id"), F.col("d.action").alias("action"), F.col("d.redirect_to").alias("redirect_to"), "error")


def link_rows(queries: DataFrame, key: str, hits: DataFrame, hit_key: str) -> DataFrame:
    """Every query with its ranked hits; a query without hits keeps one blank row."""
    return queries.join(hits.withColumnRenamed(hit_key, key), key, "left")


def narrowed(rows: DataFrame, group: str, hit: Column) -> DataFrame:
    """Rows of a group that pass ``hit``; where none does, all of them."""
    flags = rows.withColumn("__hit", F.coalesce(hit, F.lit(False)))
    some = flags.groupBy(group).agg(F.max("__hit").alias("__some"))
    return flags.join(some, group).where(F.col("__hit") | ~F.col("__some")).drop("__hit", "__some")


def best_overlap(rows: DataFrame, group: str, wanted: Column, have: Column) -> DataFrame:
    """Rows of a group with equal sets; where none is, those with the largest overlap."""
    scored = rows.withColumn("__s", F.when(F.array_sort(F.array_distinct(wanted)) == F.array_sort(F.array_distinct(have)), 1 << 20).otherwise(F.size(F.array_intersect(wanted, have))))
    top = scored.groupBy(group).agg(F.max("__s").alias("__top"))
    return scored.join(top, group).where(F.col("__s") == F.col("__top")).drop("__s", "__top")
