"""Joins between dictionaries: unique keys, evidence, orphans, consensus, prefixes, best definitions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark.operators.skew import spread_join


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def unique_rows(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not null and occurs once; counted with a groupBy, so a hot key costs no large window."""
    once = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__n")).where("__n = 1").select(key)
    return df.join(once, key)


def unique_key_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join on keys that are unique on both sides."""
    return unique_rows(left, key).join(unique_rows(right, key), key, how)


def proofs(entries: DataFrame, key: str, sources: dict[str, DataFrame]) -> DataFrame:
    """Where the keys of ``entries`` are found: found_count, found_where (sorted, comma separated), note.

    ``sources`` maps a name to a one-column DataFrame of keys. Two or more proofs are strong, one is weak, none makes
    the row an orphan.
    """
    found = union_all([s.toDF("__k").where(F.col("__k").isNotNull()).distinct().withColumn("__w", F.lit(n)) for n, s in sources.items()])
    sets = found.groupBy("__k").agg(F.array_sort(F.collect_set("__w")).alias("__set"))
    out = spread_join(entries, sets.withColumnRenamed("__k", key), key, "left")
    n = F.size(F.coalesce("__set", F.array().cast("array<string>")))
    return out.withColumn("found_count", n).withColumn("found_where", F.array_join(F.coalesce("__set", F.array().cast("array<string>")), ",")).withColumn("consensus_note", F.when(n >= 2, "strong").when(n == 1, "weak").otherwise("none")).drop("__set")


def either_key_join(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Join where any of the column pairs is equal: a union of equi-joins, one row per pair of rows."""
    joined = [left.join(right, left[a] == right[b]) for a, b in pairs]
    return reduce(lambda a, b: a.union(b), joined).distinct()


def capped(df: DataFrame, group: list[str], order: list[Column], cap: int) -> DataFrame:
    """First ``cap`` rows per group in a total order (evidence lists)."""
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("__rn") <= cap).drop("__rn")


def first_matches(left: DataFrame, left_key: str, right: DataFrame, right_key: str, pairs: list[tuple[str, str]], cap: int) -> DataFrame:
    """At most ``cap`` rows of ``right`` per row of ``left`` where any of the column pairs is equal: ``(left_key, right_key)``,
    the smallest right keys.

    No more than ``cap`` rows of a key are joined at all, so a key that a large part of the rows has costs no more than
    any other.
    """
    found = None
    for a, b in pairs:
        few = capped(right.where(F.col(b).isNotNull()).select(F.col(b).alias(a), right_key).distinct(), [a], [F.col(right_key)], cap)
        met = left.select(left_key, a).join(few, a).select(left_key, right_key)
        found = met if found is None else found.unionByName(met)
    return capped(found.distinct(), [left_key], [F.col(right_key)], cap)


def best_by_tier(tiers: list[DataFrame], group: str, order: list[str]) -> DataFrame:
    """Cascading lookup: the first tier that answers wins, within a tier the smallest of ``order``.

    Uses min over a struct, so the choice is made before the shuffle.
    """
    every = union_all([t.withColumn("tier", F.lit(i)) for i, t in enumerate(tiers)])
    rest = [c for c in every.columns if c not in (group, "tier", *order)]
    best = every.groupBy(group).agg(F.min(F.struct("tier", *order, *rest)).alias("__b"))
    return best.select(group, "__b.*")


def three_way_consensus(parts: list[DataFrame], key: str, gates: list[str]) -> DataFrame:
    """Rows of three dictionaries joined by a folded key whose gate columns agree wherever all are known."""
    a, b, c = parts
    b = b.select(F.col(key), *[F.col(g).alias(f"b_{g}") for g in gates])
    c = c.select(F.col(key), *[F.col(g).alias(f"c_{g}") for g in gates])
    j = a.join(b, key).join(c, key)
    ok = F.lit(True)
    for g in gates:
        ok = ok & (F.col(g).isNull() | F.col(f"b_{g}").isNull() | (F.col(g) == F.col(f"b_{g}"))) & (F.col(g).isNull() | F.col(f"c_{g}").isNull() | (F.col(g) == F.col(f"c_{g}")))
    return j.where(ok)


def require_columns(df: DataFrame, candidates: dict[str, list[str]]) -> dict[str, str]:
    """First existing candidate for every wanted column; raises when one has none."""
    have = {c.lower(): c for c in df.columns}
    out = {}
    for name, options in candidates.items():
        match = next((have[o.lower()] for o in options if o.lower() in have), None)
        if match is None:
            raise ValueError(f"none of {options} is a column")
        out[name] = match
    return out


def require_all(wanted: DataFrame, found: DataFrame, key: str) -> None:
    """Raise when keys of ``wanted`` are missing in ``found``."""
    missing = [r[0] for r in wanted.join(found, key, "left_anti").select(key).limit(10).collect()]
    if missing:
        raise ValueError(f"missing: {missing}")
