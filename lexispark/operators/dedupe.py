"""Duplicate clusters, deterministic gates, and validation of decisions made elsewhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.operators.windows import numbered

ROMAN = ("I", "II", "III", "IV", "V")


def clusters(df: DataFrame, key: Column, least: int = 2) -> DataFrame:
    """Groups of ``least`` or more rows with one key: ``(key, n)``; null and empty keys are left out."""
    return df.select(key.alias("key")).where(F.coalesce("key", F.lit("")) != "").groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def cluster_gates(df: DataFrame, key: Column, same: list[str], bucket: Column, evidence: DataFrame) -> DataFrame:
    """Gate of every cluster: AUTO_KEEP_ALL where all rows agree null-safely in ``same``, AUTO_HOMONYMS_KEEP where several
    known word classes meet and another dictionary knows the headword (``evidence``: one column of keys), REVIEW otherwise."""
    sign = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in same])
    g = df.select(key.alias("key"), sign.alias("s"), F.nullif(bucket, F.lit("UNK")).alias("b")).where(F.coalesce("key", F.lit("")) != "")
    agg = g.groupBy("key").agg(F.count("*").alias("n"), F.min("s").alias("lo"), F.max("s").alias("hi"), F.size(F.collect_set("b")).alias("n_buckets")).where("n > 1")
    known = evidence.toDF("key").where("key IS NOT NULL").distinct().withColumn("known", F.lit(True))
    gate = F.when(F.col("lo") == F.col("hi"), "AUTO_KEEP_ALL").when((F.col("n_buckets") > 1) & F.col("known").isNotNull(), "AUTO_HOMONYMS_KEEP").otherwise("REVIEW")
    return agg.join(known, "key", "left").select("key", "n", "n_buckets", gate.alias("gate"))


def homonyms(df: DataFrame, key: str, order: str, gated: DataFrame) -> DataFrame:
    """Rows of clusters that hold homonyms, with their label I to V by ``order``; from the fifth on all are V.

    Ordinals come from the global numbering, so a cluster of any size is spread.
    """
    rows = df.select(F.col(key).alias("key"), order).join(gated.where("gate = 'AUTO_HOMONYMS_KEEP'").select("key"), "key")
    rn = numbered(rows, ["key", order])
    first = rn.groupBy("key").agg(F.min("rn").alias("first"))
    return rn.join(first, "key").select("key", order, homonym_label((F.col("rn") - F.col("first") + 1).cast("int")).alias("canonical_group"))


def decision_counts(validated: DataFrame) -> DataFrame:
    """One row: decisions kept, redirected, left to a person, refused, and groups without a refused decision."""
    n = lambda c: F.count_if(c)
    ok = F.col("valid")
    per = validated.groupBy("group_id").agg(n(ok & (F.col("action") == "keep")).alias("kept"), n(ok & (F.col("action") == "redirect")).alias("redirects"), n(F.col("reason") == "manual_skipped").alias("manual"), n(~ok & (F.col("reason") != "manual_skipped")).alias("refused"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return per.agg(total("kept"), total("redirects"), total("manual"), total("refused"), n(F.col("refused") == 0).alias("groups_ok"))


def homonym_label(rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(r) for r in ROMAN]), F.least(rank, F.lit(len(ROMAN))))


def validate_decisions(decisions: DataFrame, members: DataFrame, min_group: int = 2, strict: bool = True) -> DataFrame:
    """Every decision with its verdict: ``(group_id, id, action, redirect_to, reason, valid, keep)``.

    ``decisions`` (group_id, id, action, redirect_to), ``members`` (group_id, id) as stored. Group checks come first
    (unknown group, too small, in strict mode a set of ids that differs), then item checks in a fixed order.
    """
    size = members.groupBy("group_id").agg(F.countDistinct("id").alias("n_db"))
    known = members.select("group_id", "id").distinct()
    told = decisions.groupBy("group_id").agg(F.count("*").alias("n_out"), F.countDistinct("id").alias("n_ids"))
    inside = decisions.join(known, ["group_id", "id"], "left_semi").groupBy("group_id").agg(F.countDistinct("id").alias("n_known"))
    d = decisions.join(size, "group_id", "left").join(told, "group_id").join(inside, "group_id", "left")
    here = known.withColumn("in_group", F.lit(True))
    there = known.select("group_id", F.col("id").alias("redirect_to"), F.lit(True).alias("target_in_group"))
    d = d.join(here, ["group_id", "id"], "left").join(there, ["group_id", "redirect_to"], "left")
    mismatch = (F.col("n_out") != F.col("n_db")) | (F.col("n_ids") != F.col("n_db")) | (F.coalesce("n_known", F.lit(0)) != F.col("n_db"))
    group = F.when(F.col("n_db").isNull(), "group_not_in_db").when(F.col("n_db") < min_group, "group_below_min_size")
    if strict:
        group = group.when(mismatch, "id_set_mismatch")
    item = (
        F.when(F.coalesce("id", F.lit("")) == "", "missing_id").when(F.col("in_group").isNull(), "id_not_in_group").when(F.col("action") == "manual", "manual_skipped")
        .when(F.col("action").isNull() | ~F.col("action").isin("keep", "redirect"), F.concat(F.lit("unknown_action:"), F.coalesce("action", F.lit(""))))
        .when(F.col("action") == "keep", None).when(F.coalesce("redirect_to", F.lit("")) == "", "redirect_missing_target")
        .when(F.col("target_in_group").isNull(), "redirect_cross_group_or_invalid").when(F.col("redirect_to") == F.col("id"), "redirect_to_self")
    )
    reason = F.coalesce(group, item)
    return d.select("group_id", "id", "action", "redirect_to", reason.alias("reason"), reason.isNull().alias("valid"), (reason.isNull() & (F.col("action") == "keep")).alias("keep"))
