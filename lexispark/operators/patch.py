"""Updates as patches: rows are never changed in place, a patched version is written; dry runs return the patch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def append_note(old: Column, note: Column, sep: str) -> Column:
    """Note added to what is there; an empty note changes nothing."""
    return F.when(F.coalesce(note, F.lit("")) == "", old).when(F.coalesce(old, F.lit("")) == "", note).otherwise(F.concat(old, F.lit(sep), note))


def raise_confidence(old: Column, new: str = "med") -> Column:
    """Confidence never falls: high stays, everything else becomes ``new``."""
    return F.when(F.lower(F.trim(old)).isin("high", "conf:high"), old).otherwise(F.lit(new))


def apply_patch(df: DataFrame, patch: DataFrame, key: str, updates: dict[str, Column]) -> DataFrame:
    """All rows of ``df``; where ``patch`` has the key, the columns in ``updates`` are replaced.

    Columns of the patch are named p_* in the expressions. The patch must hold a key once.
    """
    p = patch.select(F.col(key), *[F.col(c).alias(f"p_{c}") for c in patch.columns if c != key], F.lit(True).alias("p__hit"))
    j = df.join(p, key, "left")
    return j.select(*[F.when(F.col("p__hit"), updates[c]).otherwise(F.col(c)).alias(c) if c in updates else F.col(c) for c in df.columns])


def changed(df: DataFrame, patched: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Dry run: key, column, old and new value of everything a patch would change."""
    a = df.select(key, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("old")) for c in columns])).alias("x")).select(key, "x.*")
    b = patched.select(key, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("new")) for c in columns])).alias("x")).select(key, "x.*")
    return a.join(b, [key, "column"]).where(~F.col("old").eqNullSafe(F.col("new")))


def choose_targets(suggestions: DataFrame, entries: DataFrame, mode: str = "pos") -> DataFrame:
    """Rows a suggestion applies to: ``(suggestion_id, entry_id, status)``.

    ``suggestions`` (suggestion_id, entry_id, norm, pos, letters), ``entries`` (entry_id, norm, pos, letters). A given
    entry_id is authoritative; else entries with the normalised headword are candidates: one is taken; of several those
    of the wanted word class if that narrows them; else mode decides (one: the smallest id; all; safe: letters equal;
    pos: only the class filter). Nothing left gives MISS, an open choice REVIEW.
    """
    by_id = suggestions.where(F.col("entry_id").isNotNull()).join(entries.select("entry_id", F.lit(1).alias("hit")), "entry_id", "left")
    by_id = by_id.select("suggestion_id", F.when(F.col("hit").isNotNull(), F.col("entry_id")).alias("entry_id"), F.when(F.col("hit").isNotNull(), "TAKE").otherwise("MISS").alias("status"))
    e = entries.select(F.col("entry_id").alias("e_id"), "norm", F.col("pos").alias("e_pos"), F.col("letters").alias("e_letters"))
    cand = suggestions.where(F.col("entry_id").isNull()).join(e, "norm", "left")
    per = cand.groupBy("suggestion_id").agg(F.count("e_id").alias("n"), F.count_if(F.col("e_pos") == F.col("pos")).alias("n_pos"), F.min("e_id").alias("smallest"))
    c = cand.join(per, "suggestion_id")
    narrowed = (F.col("n_pos") > 0) & (F.col("n_pos") < F.col("n"))
    open_choice = {"one": F.col("e_id") == F.col("smallest"), "all": F.lit(True), "safe": F.col("letters") == F.col("e_letters"), "pos": F.lit(False)}[mode]
    take = F.when(F.col("n") == 1, True).when(narrowed, F.col("e_pos") == F.col("pos")).otherwise(open_choice)
    taken = c.where(F.col("e_id").isNotNull() & F.coalesce(take, F.lit(False))).select("suggestion_id", F.col("e_id").alias("entry_id"), F.lit("TAKE").alias("status"))
    left = per.join(taken.select("suggestion_id").distinct(), "suggestion_id", "left_anti").select("suggestion_id", F.lit(None).cast("bigint").alias("entry_id"), F.when(F.col("n") == 0, "MISS").otherwise("REVIEW").alias("status"))
    return by_id.unionByName(taken).unionByName(left)
