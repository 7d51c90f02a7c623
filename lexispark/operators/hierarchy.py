"""Parent-child links to full hierarchies.

Weighted disjoint-set forests, merged hierarchically. Every node starts with a pointer to its parent (weight: one
step). A range partition of ids contracts its own pointers to the root they reach or to the node of another partition
where they leave it, adding the weights (root offsets). Only nodes that something outside points to take part in the next merge, in
which a few neighbouring partitions become one; the last merge sees all that is left in one partition, where loops close.
Results flow back merge by merge with one join each. Where the pointers left are too many for one task, they are settled
by pointer doubling with joins instead. Paths are materialised along the way: a contraction walks its parent index from
all nodes at once and writes the pieces of path between a node and its pointer's end.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.operators.skew import spread_join
from lexispark.session import cut, ship_package

NODES_PER_TASK = 2_000_000  # about 100 bytes a node
FAN_IN = 8
POINTER = ("to", "steps", "low", "state", "path")
POINTER_SCHEMA = "id bigint, to bigint, steps bigint, low bigint, state string, path array<bigint>"


def contract(ids: np.ndarray, to: np.ndarray, steps: np.ndarray, low: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
    """Contract the pointers of one partition: (to, steps, low, state, next row, rows to the end) of each.

    state ``r``: ``to`` is a root and steps its distance; ``l``: ``to`` leads to a loop whose smallest id is low; ``x``:
    ``to`` lies in another partition, and low is the smallest id on the way there.
    """
    order = np.argsort(ids, kind="stable")
    known = ids[order]
    slot = np.minimum(np.searchsorted(known, to), len(known) - 1)
    local = (state == "x") & (known[slot] == to)
    parent = np.where(local, order[slot], np.arange(len(ids)))
    nxt, way, hops, least = parent, np.where(local, steps, 0), local.astype(np.int64), low.copy()
    for _ in range(max(1, len(ids).bit_length())):
        least = np.minimum(least, least[nxt])
        way, hops = way + way[nxt], hops + hops[nxt]
        again = nxt[nxt]
        if np.array_equal(again, nxt):
            break
        nxt = again
    end = nxt
    stuck = local[end]  # an end that still has a local parent runs round a loop
    out = np.where(stuck, "l", state[end])
    least = np.where(stuck, least[end], np.where(out == "x", least, low[end]))
    return to[end], way + np.where(stuck, 0, steps[end]), least, out, parent, np.where(out == "l", 0, hops)


def joined_paths(paths: pa.ListArray, parent: np.ndarray, hops: np.ndarray) -> pa.ListArray:
    """Pieces of path from each row's end down to it: all rows walk up the parent index at once."""
    edge = np.r_[0, np.cumsum(hops + 1)]
    chain = np.empty(edge[-1], np.int64)
    at, row = np.arange(len(parent)), np.arange(len(parent))
    for k in range(int(hops.max()) + 1 if len(hops) else 0):
        chain[edge[row + 1] - 1 - k] = at
        on = hops[row] > k
        row, at = row[on], parent[at[on]]
    size = np.diff(paths.offsets.to_numpy())[chain]
    pieces = paths.take(pa.array(chain)).flatten()
    total = np.r_[0, np.cumsum(size)][edge]
    return pa.ListArray.from_arrays(pa.array(total.astype(np.int32)), pieces)


def _contractor(with_path: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        if not table.num_rows:
            return
        get = lambda name: table[name].combine_chunks()
        ids = get("id").to_numpy()
        to, steps, low, state, parent, hops = contract(ids, get("to").to_numpy(), get("steps").to_numpy(), get("low").to_numpy(), get("state").to_numpy(zero_copy_only=False).astype("U1"))
        paths = joined_paths(get("path"), parent, hops) if with_path else pa.nulls(len(ids), pa.list_(pa.int64()))
        whole = pa.table({"id": ids, "to": to, "steps": steps, "low": low, "state": pa.array(state.tolist(), pa.string()), "path": paths})
        yield from whole.to_batches(max_chunksize=50_000)

    return run


def links(df: DataFrame, key: str, parent: str) -> DataFrame:
    """One row ``(id, parent, is_root)`` per distinct key; a null or absent parent makes a root.

    Rows without a key are ignored. A key delivered twice counts once; should its parents differ, the smallest holds
    and ``conflicting_links`` names the others.
    """
    nodes = df.select(F.col(key).cast("bigint").alias("id"), F.col(parent).cast("bigint").alias("parent")).where(F.col("id").isNotNull())
    nodes = cut(nodes.groupBy("id").agg(F.min("parent").alias("parent")))
    present = nodes.select(F.col("id").alias("parent"), F.lit(True).alias("known"))
    joined = spread_join(nodes, present, "parent")
    return joined.select("id", F.coalesce("parent", F.lit(-1)).alias("parent"), F.col("known").isNull().alias("is_root"))


def conflicting_links(df: DataFrame, key: str, parent: str) -> DataFrame:
    """Every parent ``(id, parent, used)`` of keys delivered with several different ones; used marks the link that holds.

    A null beside one parent is no conflict.
    """
    pairs = df.select(F.col(key).cast("bigint").alias("id"), F.col(parent).cast("bigint").alias("parent")).dropna().distinct()
    many = pairs.groupBy("id").agg(F.collect_set("parent").alias("all")).where(F.size("all") > 1)
    return many.select("id", F.array_min("all").alias("first"), F.explode("all").alias("parent")).select("id", "parent", (F.col("parent") == F.col("first")).alias("used"))


def _followed(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Open pointers moved on to where the pointers of their targets lead; a target many point to is spread."""
    t = targets.select(F.col("id").alias("to"), *[F.col(c).alias(f"t_{c}") for c in POINTER])
    low = F.when(F.col("t_state") == "x", F.least("low", "t_low")).otherwise(F.col("t_low"))
    return spread_join(rows, t, "to").select(
        "id", F.coalesce("t_to", "to").alias("to"), (F.col("steps") + F.coalesce("t_steps", F.lit(0))).alias("steps"), F.coalesce(low, "low").alias("low"), F.coalesce("t_state", "state").alias("state"),
        F.when(F.col("t_path").isNotNull(), F.concat("t_path", "path")).otherwise(F.col("path")).alias("path"),
    )


def _doubled(table: DataFrame) -> DataFrame:
    """Pointers settled by doubling: a pointer that still moves after as many steps as there are pointers can only run
    round a loop, whose smallest id the place it has reached has met by then."""
    reach = 1
    while True:
        open_rows = table.where("state = 'x'")
        left = open_rows.count()
        if left == 0 or reach > 2 * left:
            break
        table = cut(table.where("state != 'x'").unionByName(_followed(open_rows, table)))
        reach *= 2
    spot = table.where("state = 'x'").select(F.col("id").alias("to"), F.col("low").alias("s_low"))
    looped = spread_join(table.where("state = 'x'"), spot, "to").select("id", "to", "steps", F.coalesce("s_low", "low").alias("low"), F.lit("l").alias("state"), "path")
    return table.where("state != 'x'").unionByName(looped)


def forest(all_links: DataFrame, with_path: bool = False) -> DataFrame:
    """``(id, to, steps, low, state, path)`` of every link ``(id, parent, is_root)``: state ``r`` with the root, the
    steps to it and the path from it, or ``l`` with the smallest id of the loop the node is on or below."""
    spark = all_links.sparkSession
    ship_package(spark)
    root = F.col("is_root")
    start = all_links.select("id", F.when(root, F.col("id")).otherwise(F.col("parent")).alias("to"), F.when(root, 0).otherwise(1).cast("bigint").alias("steps"), F.col("id").alias("low"), F.when(root, "r").otherwise("x").alias("state"), F.array("id").alias("path"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(all_links.count() / NODES_PER_TASK))
    levels = [cut(start.repartitionByRange(parts, "id").mapInArrow(_contractor(with_path), POINTER_SCHEMA))]
    while True:
        ends = levels[-1].where("state = 'x'").select(F.col("to").alias("id")).distinct()
        table = cut(ends.join(levels[-1], "id"))
        left = table.count()
        if not left:
            break
        parts = math.ceil(parts / FAN_IN)
        if parts < math.ceil(left / NODES_PER_TASK):
            levels.append(cut(_doubled(table)))
            break
        levels.append(cut(table.repartitionByRange(parts, "id").mapInArrow(_contractor(with_path), POINTER_SCHEMA)))
        if parts == 1:
            break
    settled = levels.pop()
    for level in reversed(levels):
        settled = level.where("state != 'x'").unionByName(_followed(level.where("state = 'x'"), settled))
    return settled


def resolve(df: DataFrame, key: str, parent: str) -> DataFrame:
    """Root and depth of every node: ``(id, root_id, depth)``.

    A root has depth 1. A node on a loop, or below one, has depth -1 and the smallest id on that loop as root. Empty
    input gives no rows; self-references are loops of one; loops and chains may cross any number of partitions. A task
    holds one range of at most NODES_PER_TASK ids. Building the result runs jobs (the merges).
    """
    looping = F.col("state") == "l"
    f = forest(cut(links(df, key, parent)))
    return f.select("id", F.when(looping, F.col("low")).otherwise(F.col("to")).alias("root_id"), F.when(looping, F.lit(-1)).otherwise(F.col("steps") + 1).cast("int").alias("depth"))


def on_loops(tied: DataFrame) -> DataFrame:
    """Ids of the nodes on loops, out of ``(id, parent)`` of all nodes on or below loops.

    Steps are doubled until the places reached no longer become fewer: those are the nodes on loops.
    """
    step = cut(tied.select("id", F.col("parent").alias("to")))
    places = step.count()
    while True:
        nxt = step.select(F.col("id").alias("to"), F.col("to").alias("far"))
        step = cut(spread_join(step, nxt, "to", "inner").select("id", F.col("far").alias("to")))
        left = step.select("to").distinct().count()
        if left == places:
            return step.select(F.col("to").alias("id")).distinct()
        places = left


def paths(df: DataFrame, key: str, parent: str) -> DataFrame:
    """``(id, root_id, depth, path)``: as ``resolve``, with the keys from the root down to the node.

    Below a loop the path begins at the node of the loop where the tree hangs; nodes on loops have themselves as path.
    The paths are as long together as the depths of all nodes.
    """
    all_links = cut(links(df, key, parent))
    f = cut(forest(all_links, True))
    free = f.where("state = 'r'").select("id", F.col("to").alias("root_id"), (F.col("steps") + 1).cast("int").alias("depth"), "path")
    tied = all_links.join(f.where("state = 'l'").select("id", "low"), "id")
    if tied.isEmpty():
        return free
    tied = cut(tied)
    loop = on_loops(tied).withColumn("on_loop", F.lit(True))
    hung = tied.join(loop, "id", "left").select("id", "parent", F.col("on_loop").isNotNull().alias("is_root"))
    below = forest(cut(hung), True).select("id", "path").join(tied.select("id", F.col("low").alias("root_id")), "id")
    return free.unionByName(below.select("id", "root_id", F.lit(-1).alias("depth"), "path"))


def _above(p: DataFrame) -> DataFrame:
    """Pairs ``(id, ancestor, distance)`` out of paths."""
    line = p.where(F.size("path") > 1).select("id", F.size("path").alias("n"), F.posexplode("path").alias("i", "ancestor"))
    return line.where(F.col("i") < F.col("n") - 1).select("id", "ancestor", (F.col("n") - 1 - F.col("i")).alias("distance"))


def ancestors(df: DataFrame, key: str, parent: str) -> DataFrame:
    """Every pair of a node and a node above it: ``(id, ancestor, distance)``.

    Below a loop, the nodes above reach up to the node of the loop where the tree hangs; nodes on loops have no rows
    of their own. The result has as many rows as the trees have ancestor pairs, which is what was asked for.
    """
    return _above(paths(df, key, parent))


def descendants(df: DataFrame, key: str, parent: str) -> DataFrame:
    """Every node with each node below it: ``(id, descendant, distance)``; a loop is not followed round."""
    return ancestors(df, key, parent).select(F.col("ancestor").alias("id"), F.col("id").alias("descendant"), "distance")


def hierarchy(df: DataFrame, key: str, parent: str) -> DataFrame:
    """Root, depth, path from the root and number of nodes below, for every node.

    ``path`` lists the keys from the root to the node joined by '/'; it is null for nodes caught by loops, whose
    ``n_below`` is null as well. Nodes below are counted from the paths, summed up before anything is shuffled.
    """
    p = cut(paths(df, key, parent))
    below = _above(p.where("depth > 0")).groupBy(F.col("ancestor").alias("id")).agg(F.count("*").alias("n_below"))
    free = F.col("depth") > 0
    line = F.array_join(F.transform("path", lambda x: x.cast("string")), "/")
    return p.join(below, "id", "left").select("id", "root_id", "depth", F.when(free, line).alias("path"), F.when(free, F.coalesce("n_below", F.lit(0))).alias("n_below"))
