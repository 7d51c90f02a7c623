from datetime import datetime

from pyspark.sql import functions as F

from lexispark.operators import references
from lexispark.operators.references import Reference, orphan_report, orphans

CHILD = "id bigint, parent bigint, at timestamp_ntz, k string, row_id string"
PARENT = "key bigint, at timestamp_ntz, gone timestamp_ntz"
T = [datetime(2024, m, 1) for m in range(1, 13)]


def make(spark, child, parent, deleted=((50,),)):
    return Reference(
        "t", spark.createDataFrame(child, CHILD), "id", "parent", spark.createDataFrame(parent, PARENT), "key", F.col("at"), F.col("at"), F.col("gone").isNotNull(),
        spark.createDataFrame(list(deleted), "key_id bigint"), F.date_format("at", "yyyy-MM"),
    )


def test_kinds(spark):
    child = [(1, 10, T[3], "x", "y"), (2, 10, T[0], "x", "y"), (3, 99, T[0], "", ""), (4, 50, None, None, None), (5, None, T[0], "", ""), (6, 20, T[5], "", ""), (7, 30, None, "", ""), (1, 10, T[3], "x", "y"), (3, 99, T[0], "", "")]
    parent = [(10, T[1], None), (20, T[0], T[2]), (30, None, None), (None, T[0], None), (10, T[1], None)]
    got = {(r.row_id, r.kind, r.period) for r in orphans(make(spark, child, parent)).collect()}
    assert got == {(2, "late", "2024-01"), (3, "missing", "2024-01"), (4, "deleted", None), (6, "deleted", "2024-06")}
    assert orphans(make(spark, child, parent)).count() == 4


def test_empty_tables(spark):
    assert orphans(make(spark, [], [(1, None, None)])).count() == 0
    got = orphans(make(spark, [(1, 5, None, "", "")], []))
    assert [(r.row_id, r.kind) for r in got.collect()] == [(1, "missing")]


def test_filter_too_small_for_the_parents_changes_nothing(spark, monkeypatch):
    child = [(i, i % 700, None, "", "") for i in range(1500)]
    parent = [(i, None, None) for i in range(0, 700, 2)]
    whole = {(r.row_id, r.kind) for r in orphans(make(spark, child, parent)).collect()}
    real = references.bloom_filter
    monkeypatch.setattr(references, "bloom_filter", lambda keys, column: real(keys, column, 1024))
    assert {(r.row_id, r.kind) for r in orphans(make(spark, child, parent)).collect()} == whole
    assert len(whole) == sum(1 for i in range(1500) if (i % 700) % 2)


def test_report_counts_a_hot_key(spark):
    child = [(i, 7, T[0], "", "") for i in range(300)] + [(1000, 8, T[1], "", "")]
    got = {(r.period, r.kind): r.n_rows for r in orphan_report(orphans(make(spark, child, [(8, T[0], None)]))).collect()}
    assert got == {("2024-01", "missing"): 300}


def test_filter_never_denies_a_key(spark):
    keys = spark.range(0, 5000, 3).withColumnRenamed("id", "k")
    bloom = references.bloom_filter(keys, "k")
    flags = {r.id: r.maybe for r in references.with_membership(spark.range(5000), "id", bloom).collect()}
    assert all(flags[i] for i in range(0, 5000, 3))
    assert sum(flags.values()) < 1667 + 200
