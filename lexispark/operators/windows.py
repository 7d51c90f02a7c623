"""Window-like operators: neighbours, gaps, order violations, ordinals without one big task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark.session import cut


def numbered(df: DataFrame, order: list[str], name: str = "rn") -> DataFrame:
    """Global row number from 1 in a total order, without a single-partition window.

    Rows are range partitioned and numbered within their partition; the sizes of the partitions (one row each) give the
    offsets.
    """
    part = df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    part = cut(part)
    local = part.withColumn("__local", F.row_number().over(Window.partitionBy("__part").orderBy(*order)))
    sizes = part.groupBy("__part").agg(F.count("*").alias("__size"))
    offsets = sizes.withColumn("__offset", F.sum("__size").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))).select("__part", F.coalesce("__offset", F.lit(0)).alias("__offset"))
    return local.join(F.broadcast(offsets), "__part").withColumn(name, (F.col("__local") + F.col("__offset")).cast("bigint")).drop("__part", "__local", "__offset")


def neighbours(df: DataFrame, order: list[str], value: str, width: int = 2) -> DataFrame:
    """Lists of the ``width`` values before and after every row in global order, by self-join on row numbers."""
    rn = numbered(df, order)
    around = rn.select(F.col("rn").alias("__rn"), F.col(value).alias("__v"))
    shifted = around.select("__v", F.explode(F.array(*[F.lit(k) for k in range(-width, width + 1) if k])).alias("__k"), "__rn").select("__v", "__k", (F.col("__rn") + F.col("__k")).alias("rn"))
    near = shifted.groupBy("rn").agg(F.array_sort(F.collect_list(F.struct((-F.col("__k")).alias("k"), F.col("__v").alias("v")))).alias("__near"))
    pick = lambda test: F.transform(F.filter("__near", test), lambda x: x["v"])
    out = rn.join(near, "rn", "left")
    empty = F.array().cast("array<string>")
    return out.withColumn("prev", F.coalesce(pick(lambda x: x["k"] < 0), empty)).withColumn("next", F.coalesce(pick(lambda x: x["k"] > 0), empty)).drop("__near")


def group_neighbours(df: DataFrame, group: str, order: list[str], value: str) -> DataFrame:
    """Value before and after within the group, ``prev`` and ``next``.

    Rows are numbered over range partitions and joined to the rows beside them, so a group of any size is spread.
    """
    rn = numbered(df, [group, *order])
    side = lambda k, name: rn.select((F.col("rn") + k).alias("rn"), F.col(group).alias(f"__g_{name}"), F.col(value).alias(f"__v_{name}"))
    j = rn.join(side(1, "p"), "rn", "left").join(side(-1, "n"), "rn", "left")
    return j.withColumn("prev", F.when(F.col("__g_p") == F.col(group), F.col("__v_p"))).withColumn("next", F.when(F.col("__g_n") == F.col(group), F.col("__v_n"))).drop("__g_p", "__g_n", "__v_p", "__v_n", "rn")


def page_gaps(df: DataFrame, group: str, page: str, start: int = 1) -> DataFrame:
    """Missing pages of every group: before its first page and between its pages."""
    pages = df.where(F.col(page).isNotNull() & (F.col(page) >= start)).select(group, F.col(page).cast("int").alias("__p")).distinct()
    last = pages.groupBy(group).agg(F.max("__p").alias("__max"))
    wanted = last.select(group, F.explode(F.sequence(F.lit(start), "__max")).alias("__p"))
    return wanted.join(pages, [group, "__p"], "left_anti").withColumnRenamed("__p", page)


def order_violations(df: DataFrame, order: list[str], key: Column) -> DataFrame:
    """Adjacent rows (by ``order``) whose keys fall, or whose initials jump by more than one letter."""
    rn = numbered(df.withColumn("__key", key), order)
    nxt = rn.select((F.col("rn") - 1).alias("rn"), F.col("__key").alias("__next"))
    j = rn.join(nxt, "rn")
    jump = F.ascii(F.substring("__next", 1, 1)) - F.ascii(F.substring("__key", 1, 1))
    reason = F.when(F.col("__key") > F.col("__next"), "order").when(jump > 1, "jump")
    return j.withColumn("reason", reason).where(F.col("reason").isNotNull()).withColumnRenamed("__key", "key").withColumnRenamed("__next", "next_key")
