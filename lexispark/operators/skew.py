"""Joins that stay spread when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 10_000  # a key with fewer rows is no burden for one task
MOST_KEYS = 200  # at most so many keys are treated apart; any other key has less than a 200th of the rows


def hot_keys(df: DataFrame, key: str) -> list:
    """The most frequent keys of HOT_ROWS rows or more, at most MOST_KEYS; counted with partial sums."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") >= HOT_ROWS)
    return [r[0] for r in counts.orderBy(F.desc("n"), key).limit(MOST_KEYS).collect()]


def spread_join(big: DataFrame, small: DataFrame, key: str, how: str = "left") -> DataFrame:
    """``big`` joined to ``small``, which holds a key at most once, on a column both have.

    how is left, inner, left_semi or left_anti. Rows of hot keys meet the few rows of ``small`` with those keys by
    broadcast (at most MOST_KEYS rows); rows without a key are not shuffled at all; all others are joined as usual.
    """
    known = big.where(F.col(key).isNotNull())
    hot = hot_keys(big, key)
    if hot:
        some = F.col(key).isin(hot)
        out = known.where(some).join(F.broadcast(small.where(some)), key, how).unionByName(known.where(~some).join(small, key, how))
    else:
        out = known.join(small, key, how)
    if how == "left":
        extra = [c for c in small.columns if c != key]
        kinds = dict(small.dtypes)
        rest = big.where(F.col(key).isNull()).select("*", *[F.lit(None).cast(kinds[c]).alias(c) for c in extra])
        out = out.unionByName(rest)
    elif how == "left_anti":
        out = out.unionByName(big.where(F.col(key).isNull()))
    return out
