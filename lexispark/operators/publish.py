"""Publication: flattening, shards, blocks, lookup, facets, rendered exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark.functions.fold import first_letter
from lexispark.operators.windows import numbered


def flatten_items(df: DataFrame, items: str, doc: str, redirect: str = "redirect_only") -> DataFrame:
    """One row per kept item with id '{doc}-e{i}'; i counts from 1 before redirects are dropped."""
    e = df.select(*[c for c in df.columns if c != items], F.posexplode(items).alias("__i", "item"))
    return e.withColumn("id", F.concat(F.col(doc), F.lit("-e"), (F.col("__i") + 1).cast("string"))).where(F.coalesce(F.col(f"item.{redirect}"), F.lit(0)) == 0).drop("__i")


def shards(df: DataFrame, order: list[str], size: int = 1000) -> DataFrame:
    """Rows with ``ordinal`` (from 0), ``shard`` and ``idx`` within the shard."""
    rn = numbered(df, order)
    ordinal = F.col("rn") - 1
    return rn.select(*df.columns, ordinal.alias("ordinal"), F.floor(ordinal / size).cast("int").alias("shard"), F.pmod(ordinal, F.lit(size)).cast("int").alias("idx"))


def shard_index(sharded: DataFrame, key: str, page: str) -> DataFrame:
    """Index of the shards: count, first and last id, page range (null pages are skipped)."""
    return sharded.groupBy("shard").agg(F.count("*").alias("count"), F.min_by(key, "ordinal").alias("first_id"), F.max_by(key, "ordinal").alias("last_id"), F.min(page).alias("page_min"), F.max(page).alias("page_max"))


def block_index(sharded: DataFrame) -> DataFrame:
    """Blocks with 1-based start and end of their rows."""
    return sharded.groupBy(F.col("shard").alias("block")).agg((F.min("ordinal") + 1).alias("start_idx"), (F.max("ordinal") + 1).alias("end_idx"), F.count("*").alias("count"))


def lookup(sharded: DataFrame, key: str) -> DataFrame:
    return sharded.select(key, F.format_string("block-%04d.json", F.col("shard") + 1).alias("block_file"), F.col("idx").alias("idx_in_block"))


def first_letters(df: DataFrame, column: str, letters: bool = False) -> DataFrame:
    return df.groupBy(first_letter(F.col(column), letters=letters).alias("letter")).agg(F.count("*").alias("n"))


def top_values(df: DataFrame, value: Column, place: Column, n: int) -> DataFrame:
    """Most frequent values; ties go to the value seen first."""
    counted = df.select(value.alias("value"), place.alias("__p")).where(F.col("value").isNotNull()).groupBy("value").agg(F.count("*").alias("n"), F.min("__p").alias("__p"))
    return counted.orderBy(F.desc("n"), "__p", "value").limit(n).select("value", "n")


def facet_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Counts of every value of every facet column in one pass (grouping sets by explode)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.explode(pairs).alias("p")).where(F.col("p.value").isNotNull()).groupBy("p.facet", "p.value").agg(F.count("*").alias("n"))


def with_headings(df: DataFrame, order: list[str], letter: Column) -> DataFrame:
    """Rows with their letter and whether a new letter heading begins."""
    rn = numbered(df.withColumn("letter", letter), order)
    before = rn.select((F.col("rn") + 1).alias("rn"), F.col("letter").alias("__before"))
    return rn.join(before, "rn", "left").withColumn("is_heading", F.col("__before").isNull() | (F.col("__before") != F.col("letter"))).drop("__before")


def markdown(df: DataFrame, order: list[str], head: str, label: str, body: str, conf: Column) -> DataFrame:
    """Markdown lines of a dictionary: letter headings, bold headword, label, confidence badge, definition."""
    h = with_headings(df, order, first_letter(F.col(head), letters=True))
    badge = F.when(conf == "high", "●").when(conf == "med", "◐").when(conf == "low", "○").otherwise("")
    line = F.concat_ws(" ", F.concat(F.lit("**"), F.col(head), F.lit("**")), F.when(F.col(label) != "", F.concat(F.lit("*"), F.col(label), F.lit("*"))), F.nullif(badge, F.lit("")), F.col(body))
    return h.select("rn", F.when(F.col("is_heading"), F.concat(F.lit("## "), F.col("letter"), F.lit("\n\n"), line)).otherwise(line).alias("text"))


def export_header(df: DataFrame, title: str, conf: Column, stamp: str) -> DataFrame:
    """Header lines of an export ``(rn, text)``: title, number of entries, entries by confidence, time; rn is negative."""
    one = df.agg(F.count("*").alias("n"), *[F.count_if(conf == c).alias(c) for c in ("high", "med", "low")])
    lines = F.array(
        F.lit(f"# {title}"), F.concat(F.lit("**Total de entradas:** "), F.col("n").cast("string")),
        F.concat(F.lit("**Confiança:** high "), F.col("high").cast("string"), F.lit(", med "), F.col("med").cast("string"), F.lit(", low "), F.col("low").cast("string")), F.lit(f"**Exportado em:** {stamp}"), F.lit("---"),
    )
    return one.select(F.posexplode(lines).alias("i", "text")).select((F.col("i") - 5).cast("bigint").alias("rn"), "text")


def unified(sources: dict[str, DataFrame]) -> DataFrame:
    """All headwords of several dictionaries in one list ``(rn, text)``, case ignored: a headword with the text of every
    dictionary that has it, in the order of the sources. Each source has columns lemma and body."""
    every = None
    for i, (name, df) in enumerate(sources.items()):
        part = df.where(F.col("lemma").isNotNull()).groupBy("lemma").agg(F.array_sort(F.collect_set(F.coalesce("body", F.lit("")))).alias("b")).select("lemma", F.lit(i).alias("i"), F.concat(F.lit(f"- *{name}*: "), F.array_join("b", " / ")).alias("line"))
        every = part if every is None else every.unionByName(part)
    g = every.groupBy("lemma").agg(F.array_sort(F.collect_list(F.struct("i", "line"))).alias("x"))
    rn = numbered(g.withColumn("__low", F.lower("lemma")), ["__low", "lemma"])
    return rn.select("rn", F.concat(F.lit("**"), F.col("lemma"), F.lit("**\n"), F.array_join(F.transform("x", lambda x: x["line"]), "\n")).alias("text"))


def first_per_group(df: DataFrame, group: list[str], order: list[Column], k: int = 1) -> DataFrame:
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("__rn") <= k).drop("__rn")
