import random

import pytest

from lexispark.operators import hierarchy as module
from lexispark.operators.hierarchy import ancestors, conflicting_links, descendants, hierarchy, resolve


def brute(parent):
    out = {}
    for k in parent:
        path, seen, x = [], {}, k
        while True:
            if x in seen:
                out[k] = (min(path[seen[x]:]), -1)
                break
            seen[x] = len(path)
            path.append(x)
            p = parent[x]
            if p is None or p not in parent:
                out[k] = (x, len(path))
                break
            x = p
    return out


def check(spark, parent, parts):
    rows = [(k, p, "clash") for k, p in parent.items()]
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.id: (r.root_id, r.depth) for r in resolve(spark.createDataFrame(rows, "s bigint, p bigint, root_id string"), "s", "p").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == brute(parent)


@pytest.fixture(params=["one merge", "many merges", "doubling"], autouse=True)
def way(request, monkeypatch):
    """Results are the same however the partitions are merged."""
    if request.param == "many merges":
        monkeypatch.setattr(module, "FAN_IN", 2)
    if request.param == "doubling":
        monkeypatch.setattr(module, "NODES_PER_TASK", 20)


def test_random_graphs_over_many_partitions(spark):
    rng = random.Random(3)
    for n in (1, 40, 400):
        check(spark, {i: rng.choice([None, rng.randrange(n), rng.randrange(n), n + 5]) for i in range(n)}, 7)


def test_long_chain_long_loop_and_tails_across_partitions(spark):
    parent = {i: i - 1 if i else None for i in range(300)}
    parent |= {1000 + i: 1000 + (i + 37) % 101 for i in range(101)}
    parent |= {2000 + i: 2001 + i for i in range(150)} | {2150: 1003}
    parent |= {1: 0, 5000: 5000, 5001: 5000}
    parent |= {6005: 6003, 6003: 6009, 6009: 9000, 9000: 6005}  # the smallest id of the loop lies between two partitions' ends
    check(spark, parent, 9)


def test_nulls_repeated_rows_and_empty(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 1), (2, 1), (None, 1), (3, 77)], "s bigint, p bigint")
    assert {(r.id, r.root_id, r.depth) for r in resolve(df, "s", "p").collect()} == {(1, 1, 1), (2, 1, 2), (3, 3, 1)}
    assert resolve(df.limit(0), "s", "p").count() == 0


def test_conflicting_parents_are_reported(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (2, 3), (2, 3), (3, None), (4, 1), (4, None), (None, 1)], "s bigint, p bigint")
    assert {tuple(r) for r in conflicting_links(df, "s", "p").collect()} == {(2, 1, True), (2, 3, False)}
    assert {(r.id, r.root_id, r.depth) for r in resolve(df, "s", "p").collect()} == {(1, 1, 1), (2, 1, 2), (3, 3, 1), (4, 1, 2)}


def test_paths_and_descendants(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 2), (5, 6), (6, 5)], "s bigint, p bigint")
    got = {r.id: (r.path, r.n_below) for r in hierarchy(df, "s", "p").collect()}
    assert got == {1: ("1", 3), 2: ("1/2", 2), 3: ("1/2/3", 0), 4: ("1/2/4", 0), 5: (None, None), 6: (None, None)}


def test_pairs_reach_up_to_the_loop(spark):
    rng = random.Random(5)
    parent = {i: rng.choice([None, rng.randrange(120), rng.randrange(120), 500]) for i in range(120)}
    parent |= {1000 + i: 1001 + i for i in range(20)} | {1020: 1030, 1030: 1031, 1031: 1030, 1040: 1040, 1041: 1040, 1042: 1041}
    want = set()
    for k in parent:
        reached = lambda x: x in parent and parent[x] in parent
        looped = lambda x: brute(parent)[x][1] < 0 and x in walk(x)

        def walk(x):
            seen = []
            while reached(x) and parent[x] not in seen:
                x = parent[x]
                seen.append(x)
            return seen

        x, d = k, 0
        while reached(x) and not looped(x):
            x, d = parent[x], d + 1
            want.add((x, k, d))
    df = spark.createDataFrame([(k, p) for k, p in parent.items()], "s bigint, p bigint")
    got = [tuple(r) for r in descendants(df, "s", "p").collect()]
    assert len(got) == len(want) and set(got) == want and {(1030, 1000, 21), (1041, 1042, 1), (1040, 1042, 2)} <= want
    assert ancestors(df.limit(0), "s", "p").count() == 0
