"""References to records that do not exist: orphan detection with a Bloom filter and one exact join.

The parent keys are folded into a Bloom filter of a bounded number of bits. A key the filter rejects is certainly
absent, so those references never reach the exact join; only filter-positive references are joined to the parents.
The filter's size is capped, never its content: with more parents than the cap was sized for, more references pass the
filter and are settled by the exact join, so the result is the same.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexispark.operators.skew import spread_join
from lexispark.session import cut, ship_package

MAX_BLOOM_BITS = 1 << 26
HASHES = 4
BITS_PER_KEY = 12


@dataclass(frozen=True)
class Reference:
    """One reference: child rows with a key, parents with the key, optional times and optional deletion signs.

    ``child_time`` and ``parent_time`` are compared for late parents; ``parent_removed`` marks parents withdrawn in
    place; ``deleted`` holds keys (column ``key_id``) of parents deleted for good.
    """

    tab: str
    child: DataFrame
    row_id: str
    ref: str
    parent: DataFrame
    parent_key: str
    child_time: Column | None = None
    parent_time: Column | None = None
    parent_removed: Column | None = None
    deleted: DataFrame | None = None
    period: Column | None = None


def _positions(key: Column, bits: int) -> Column:
    """Bit positions of a key; ``bits`` is a power of two."""
    return F.array(*[F.xxhash64(key, F.lit(seed)).bitwiseAND(F.lit(bits - 1).cast("bigint")) for seed in range(HASHES)])


def bloom_filter(keys: DataFrame, column: str, max_bits: int = MAX_BLOOM_BITS) -> tuple[int, np.ndarray] | None:
    """Bloom filter of a BIGINT column: (bits, words of 64 bits), at most ``max_bits`` / 8 bytes.

    Words are combined in the executors; the driver receives one row per word that is set. ``None`` for a table without
    keys.
    """
    known = keys.where(F.col(column).isNotNull()).select(F.col(column).cast("bigint").alias("k"))
    n = known.select(F.approx_count_distinct("k", 0.05)).first()[0]
    if not n:
        return None
    bits = 1 << max(10, min(max_bits.bit_length() - 1, math.ceil(math.log2(n * BITS_PER_KEY))))
    at = known.select(F.explode(_positions(F.col("k"), bits)).alias("p"))
    words = at.groupBy(F.shiftrightunsigned("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(p & 63 AS INT))")).alias("b")).toArrow()
    table = np.zeros(max(1, bits // 64), np.int64)
    table[words["w"].to_numpy()] = words["b"].to_numpy()
    return bits, table


def with_membership(df: DataFrame, key: str, bloom: tuple[int, np.ndarray] | None, name: str = "maybe") -> DataFrame:
    """``df`` with a flag: false means that the key is certainly not among those of the filter."""
    if bloom is None:
        return df.withColumn(name, F.lit(False))
    ship_package(df.sparkSession)
    bits, table = bloom
    sent = df.sparkSession.sparkContext.broadcast(table)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(batch.schema.get_field_index("__at"))
            p = at.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, HASHES)
            hit = ((sent.value[p >> 6] >> (p & 63)) & 1).all(axis=1)
            kept = [c for c in batch.schema.names if c != "__at"]
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(c)) for c in kept], pa.array(hit)], [*kept, name])

    schema = T.StructType([*df.schema.fields, T.StructField(name, T.BooleanType())])
    return df.withColumn("__at", _positions(F.col(key), bits)).mapInArrow(probe, schema)


def orphans(ref: Reference) -> DataFrame:
    """Broken references of one kind: rows ``(tab, row_id, kind, period)``.

    kind ``deleted``: the parent is absent and its key is among the deleted keys, or the parent is marked removed;
    ``missing``: absent otherwise; ``late``: the parent exists but its own time is later than the child's, both known.
    A null reference is no case. Equal child rows delivered twice give one row. An empty parent table makes every
    reference an orphan; an empty child table gives no rows. Other columns of the inputs play no part.
    """
    period = ref.period if ref.period is not None else F.lit(None).cast("string")
    when = ref.child_time if ref.child_time is not None else F.lit(None).cast("timestamp")
    child = ref.child.select(F.col(ref.row_id).cast("bigint").alias("row_id"), F.col(ref.ref).cast("bigint").alias("k"), when.alias("c_time"), period.alias("period"))
    child = cut(with_membership(child.where(F.col("k").isNotNull()), "k", bloom_filter(ref.parent, ref.parent_key)))

    own = ref.parent_time if ref.parent_time is not None else F.lit(None).cast("timestamp")
    removed = ref.parent_removed if ref.parent_removed is not None else F.lit(False)
    parent = ref.parent.select(F.col(ref.parent_key).cast("bigint").alias("k"), own.alias("p_time"), removed.alias("p_removed")).where(F.col("k").isNotNull())
    parent = parent.groupBy("k").agg(F.min("p_time").alias("p_time"), F.max("p_removed").alias("p_removed"), F.lit(True).alias("known"))

    definite = child.where("NOT maybe").select("row_id", "k", "period", F.lit("missing").alias("kind"))
    verified = spread_join(child.where("maybe").drop("maybe"), parent, "k")
    verdict = (
        F.when(F.col("known").isNull(), F.lit("missing"))
        .when(F.col("p_removed"), F.lit("deleted"))
        .when(F.col("p_time") > F.col("c_time"), F.lit("late"))
    )
    checked = verified.select("row_id", "k", "period", verdict.alias("kind")).where(F.col("kind").isNotNull())
    found = definite.unionByName(checked).distinct()
    if ref.deleted is not None:
        gone = ref.deleted.select(F.col("key_id").cast("bigint").alias("k")).where("k IS NOT NULL").distinct().withColumn("gone", F.lit(True))
        found = spread_join(found, gone, "k")
        kind = F.when((F.col("kind") == "missing") & F.col("gone").isNotNull(), F.lit("deleted")).otherwise(F.col("kind"))
        found = found.withColumn("kind", kind)
    return found.select(F.lit(ref.tab).alias("tab"), "row_id", "kind", "period")


def orphan_report(found: DataFrame) -> DataFrame:
    """Orphans per table, kind and period; an unknown period stays null."""
    return found.groupBy("tab", "period", "kind").agg(F.count("*").alias("n_rows"))
