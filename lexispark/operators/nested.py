"""Flatten deeply nested JSON records into related flat tables.

Method: the Arrow string buffers are scanned as bytes. Quotes, brackets, commas and colons become token arrays, nesting
depth is a running sum, and the parent of every token comes from one sorted search per depth level (list offsets and
parent indices instead of a parser walking records). Child rows are emitted level by level; keys and paths travel to
them by vectorised ``take``. No Python loop runs over records.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.functions.strings import let
from lexispark.session import ship_package

NODE_SCHEMA = "rec_key string, node_kind string, node_path string, parent_path string, depth int, position int, body string"


@dataclass(frozen=True)
class TreeSpec:
    """Names that make up the tree: record-level lists, nested lists, and leaf lists of a node."""

    roots: tuple[str, ...]
    children: tuple[str, ...]
    leaves: tuple[str, ...]


@dataclass
class Tokens:
    """Values of a batch of documents: byte spans, container parents, key spans and ordinals."""

    start: np.ndarray
    end: np.ndarray
    kind: np.ndarray
    parent: np.ndarray
    key_start: np.ndarray
    key_end: np.ndarray
    ordinal: np.ndarray
    row: np.ndarray
    readable: np.ndarray


def _escaped(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each position, whether an odd run of backslashes stands before it."""
    other = np.flatnonzero(buf != 0x5C)
    before = np.searchsorted(other, at) - 1
    last = np.where(before >= 0, other[np.maximum(before, 0)], -1)
    return (at - 1 - last) % 2 == 1


def _scan(buf: np.ndarray, offsets: np.ndarray) -> Tokens:
    n_rows = len(offsets) - 1
    quotes = np.flatnonzero(buf == 0x22)
    if (buf == 0x5C).any():
        quotes = quotes[~_escaped(buf, quotes)]
    row_of_quote = np.searchsorted(offsets, quotes, side="right") - 1
    first = np.searchsorted(row_of_quote, np.arange(n_rows))
    rank = np.arange(len(quotes)) - first[row_of_quote]
    opening = rank % 2 == 0
    count = np.bincount(row_of_quote, minlength=n_rows)
    readable = count % 2 == 0

    marks = np.flatnonzero(np.isin(buf, np.frombuffer(b"{}[]:,", dtype=np.uint8)))
    row_of_mark = np.searchsorted(offsets, marks, side="right") - 1
    seen = np.searchsorted(quotes, marks)
    inside = (seen - first[row_of_mark]) % 2 == 1
    marks, row_of_mark = marks[~inside], row_of_mark[~inside]
    byte = buf[marks]
    opens, closes = (byte == 0x7B) | (byte == 0x5B), (byte == 0x7D) | (byte == 0x5D)
    step = opens.astype(np.int64) - closes
    run = np.cumsum(step)
    row_first = np.searchsorted(row_of_mark, np.arange(n_rows))
    base = np.where(row_first > 0, run[np.maximum(row_first, 1) - 1], 0) if len(run) else np.zeros(n_rows, np.int64)
    total = np.bincount(row_of_mark, weights=step, minlength=n_rows)
    depth_after = run - base[row_of_mark] if len(run) else run
    lowest = np.zeros(n_rows, np.int64)
    np.minimum.at(lowest, row_of_mark, depth_after)
    readable &= (total == 0) & (lowest >= 0)

    ok = readable[row_of_mark]
    marks, row_of_mark, byte, opens, closes, depth_after = (x[ok] for x in (marks, row_of_mark, byte, opens, closes, depth_after))
    ok = readable[row_of_quote]
    q_open, q_close = quotes[ok & opening], quotes[ok & ~opening]
    q_row = row_of_quote[ok & opening]

    # values: containers and strings (numbers, true, false and null hold no nodes)
    box = marks[opens]
    at = np.concatenate([box, q_open])
    order = np.argsort(at, kind="stable")
    is_box = np.concatenate([np.ones(len(box), bool), np.zeros(len(q_open), bool)])[order]
    start = at[order]
    row = np.concatenate([row_of_mark[opens], q_row])[order]
    kind = np.where(is_box, buf[start] if len(start) else np.zeros(0, np.uint8), 0x22).astype(np.uint8)
    end = np.empty(len(start), np.int64)
    end[~is_box] = q_close + 1
    # depth in which a value stands: depth after the last mark before it
    last_mark = np.searchsorted(marks, start) - 1
    depth = np.where(last_mark >= 0, depth_after[np.maximum(last_mark, 0)], 0) if len(marks) else np.zeros(len(start), np.int64)
    same = last_mark >= 0
    if len(marks):
        same &= row_of_mark[np.maximum(last_mark, 0)] == row
    depth = np.where(same, depth, 0)
    index_of_box = np.flatnonzero(is_box)
    parent = np.full(len(start), -1, np.int64)
    ordinal = np.ones(len(start), np.int64)
    box_depth = depth[index_of_box]
    for level in range(int(depth.max()) + 1 if len(depth) else 0):
        here = np.flatnonzero(depth == level)
        boxes = index_of_box[box_depth == level]
        shut = marks[closes & (depth_after == level)]
        end[boxes] = shut + 1  # at one depth, openings and closings alternate
        if level:
            above = index_of_box[box_depth == level - 1]
            k = np.searchsorted(start[above], start[here], side="right") - 1
            parent[here] = above[k]
            commas = marks[(byte == 0x2C) & (depth_after == level)]
            ordinal[here] = np.searchsorted(commas, start[here]) - np.searchsorted(commas, start[parent[here]]) + 1
    # a string followed by a colon is a key; the value behind the colon takes its span
    colon = marks[byte == 0x3A]
    next_value = np.searchsorted(start, colon)
    owner = next_value - 1
    key_start, key_end = np.full(len(start), -1, np.int64), np.full(len(start), -1, np.int64)
    is_key = np.zeros(len(start), bool)
    is_key[owner] = True
    nxt = np.minimum(next_value, max(len(start) - 1, 0))
    comma_between = np.searchsorted(marks, start[nxt]) - 1 if len(start) else nxt
    fits = (next_value < len(start)) & (marks[np.maximum(comma_between, 0)] == colon) if len(start) else np.zeros(0, bool)
    key_start[nxt[fits]] = start[owner[fits]] + 1
    key_end[nxt[fits]] = end[owner[fits]] - 1
    keep = ~is_key
    new_index = np.cumsum(keep) - 1
    parent = np.where(parent >= 0, new_index[np.maximum(parent, 0)], -1)
    return Tokens(start[keep], end[keep], kind[keep], parent[keep], key_start[keep], key_end[keep], ordinal[keep], row[keep], readable)


def _named(buf: np.ndarray, t: Tokens, names: Iterable[str]) -> np.ndarray:
    """Whether the key of each value is one of ``names``."""
    hit = np.zeros(len(t.start), bool)
    for name in names:
        raw = np.frombuffer(name.encode(), dtype=np.uint8)
        some = np.flatnonzero((t.key_start >= 0) & (t.key_end - t.key_start == len(raw)))
        for i, b in enumerate(raw):
            some = some[buf[t.key_start[some] + i] == b]
        hit[some] = True
    return hit


def _items(t: Tokens, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Items of the given list values: (item, its list, position); a lone object or text is a list of one."""
    is_array = t.kind[lists] == 0x5B
    lone = lists[~is_array & (t.end[lists] - t.start[lists] > 2)]
    slot = np.full(len(t.start) + 1, -1, np.int64)
    slot[lists[is_array]] = lists[is_array]
    inside = np.flatnonzero(slot[t.parent] >= 0)  # parent -1 reads the spare last slot
    inside = inside[(t.kind[inside] == 0x7B) | (t.kind[inside] == 0x22)]
    item = np.concatenate([inside, lone])
    owner = np.concatenate([t.parent[inside], lone])
    position = np.concatenate([t.ordinal[inside], np.ones(len(lone), np.int64)])
    return item, owner, position


def flatten_batch(batch: pa.RecordBatch, spec: TreeSpec, bodies: bool = True) -> pa.Table:
    """Flatten one batch with columns ``rec_key`` and ``doc`` (no nulls) into node rows."""
    docs = batch.column("doc").cast(pa.large_string())
    docs = pa.concat_arrays([docs])
    _, off_buf, data = docs.buffers()
    offsets = np.frombuffer(off_buf, dtype=np.int64, count=len(docs) + 1, offset=docs.offset * 8)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    buf = whole[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    out: list[pa.Table] = []
    if len(buf):
        t = _scan(buf, offsets)
        root_list, child_list, leaf_list = (_named(buf, t, names) for names in (spec.roots, spec.children, spec.leaves))
        top = np.flatnonzero((t.parent < 0) & (t.kind != 0x22))
        wrapped = np.zeros(len(t.start) + 1, bool)
        wrapped[top[t.kind[top] == 0x5B]] = True
        record = np.concatenate([top[t.kind[top] == 0x7B], np.flatnonzero(wrapped[t.parent] & (t.kind == 0x7B) & (t.parent >= 0))])
        def emit(kind: str, item: np.ndarray, path: pa.Array, above: pa.Array, depth: int, position: np.ndarray) -> None:
            slices = pa.nulls(len(item), pa.large_string())
            if bodies:
                sizes = np.concatenate([[0], np.cumsum(t.end[item] - t.start[item])]).astype(np.int64)
                body = np.repeat(t.start[item] - sizes[:-1], t.end[item] - t.start[item]) + np.arange(sizes[-1])
                slices = pa.LargeStringArray.from_buffers(len(item), pa.py_buffer(sizes), pa.py_buffer(buf[body].tobytes()))
            keys = batch.column("rec_key").take(pa.array(t.row[item]))
            n = len(item)
            out.append(pa.table({"rec_key": keys, "node_kind": pa.array([kind]).take(pa.array(np.zeros(n, np.int64))), "node_path": path, "parent_path": above, "depth": pa.array(np.full(n, depth, np.int32)), "position": pa.array(position.astype(np.int32)), "body": slices.cast(pa.string())}))

        frontier, lists_named, paths, depth = record, root_list, None, 1
        while len(frontier):
            row_of = np.full(len(t.start) + 1, -1, np.int64)
            row_of[frontier] = np.arange(len(frontier))
            lists = np.flatnonzero(lists_named & (row_of[t.parent] >= 0) & (t.parent >= 0))
            item, owner, position = _items(t, lists)
            order = np.lexsort((position, t.parent[owner]))
            item, owner, position = item[order], owner[order], position[order]
            here = pc.cast(pa.array(position), pa.string())
            if paths is None:
                above = pa.nulls(len(item), pa.string())
                path = here
            else:
                above = paths.take(pa.array(row_of[t.parent[owner]]))
                path = pc.binary_join_element_wise(above, here, ".")
            if len(item):
                emit("sense", item, path, above, depth, position)
            node_row = np.full(len(t.start) + 1, -1, np.int64)
            node_row[item] = np.arange(len(item))
            leaves = np.flatnonzero(leaf_list & (node_row[t.parent] >= 0) & (t.parent >= 0))
            leaf, leaf_owner, leaf_pos = _items(t, leaves)
            if len(leaf):
                up = path.take(pa.array(node_row[t.parent[leaf_owner]]))
                emit("example", leaf, pc.binary_join_element_wise(up, pc.cast(pa.array(leaf_pos), pa.string()), "#"), up, depth, leaf_pos)
            frontier, lists_named, paths, depth = item, child_list, path, depth + 1
    empty = {"rec_key": pa.string(), "node_kind": pa.string(), "node_path": pa.string(), "parent_path": pa.string(), "depth": pa.int32(), "position": pa.int32(), "body": pa.string()}
    return pa.concat_tables([x.cast(pa.schema(list(empty.items()))) for x in out]) if out else pa.schema(list(empty.items())).empty_table()


def unwrap(c, rounds: int = 2):
    """Take JSON out of its wrappings: code fences around it, and JSON text stored inside a JSON string."""
    def once(x):
        bare = F.regexp_replace(F.regexp_replace(x, r"^\s*```[A-Za-z]*\s*|\s*```\s*$", ""), r"^\s+|\s+$", "")
        inner = lambda t: F.coalesce(F.get(F.from_json(F.concat(F.lit("["), t, F.lit("]")), "array<string>"), 0), t)
        return let(bare, lambda t: F.when(t.startswith('"') & t.endswith('"'), inner(t)).otherwise(t))

    for _ in range(rounds):
        c = once(c)
    return c


def unwrap_all(texts: pa.Array) -> pa.Array:
    """Documents that are still wrapped after the rounds of ``unwrap``, taken out however often they are wrapped."""
    wrapped = np.flatnonzero(pc.fill_null(pc.match_substring_regex(texts, r'^\s*["`]'), False).to_numpy(zero_copy_only=False))
    if not len(wrapped):
        return texts
    out = texts.to_pylist()
    for i in wrapped.tolist():
        t = out[i]
        while True:
            inner = re.sub(r"^\s*```[A-Za-z]*\s*|\s*```\s*$", "", t).strip()
            if inner.startswith('"') and inner.endswith('"'):
                try:
                    inner = json.loads(inner)
                except ValueError:
                    pass
            if inner == t:
                break
            t = inner
        out[i] = t
    return pa.array(out, pa.string())


def flatten_tree(df: DataFrame, key: str, doc: str, spec: TreeSpec, bodies: bool = True) -> DataFrame:
    """Flat node rows of the JSON documents in column ``doc``.

    One row per item of a list named in ``spec.roots`` (record level), ``spec.children`` (inside a node, any depth) or
    ``spec.leaves`` (examples of a node). ``node_path`` holds the 1-based positions from the top, ``parent_path`` the
    path of the node above, ``body`` the JSON text of the node with all below it (null without ``bodies``). A lone object or text where a list is usual counts as
    a list of one; null and empty text hold no node. Null, empty, plain-text and unreadable (cut) documents give no
    rows; equal rows delivered twice are flattened once; other columns of ``df`` are ignored whatever their names.
    """
    ship_package(df.sparkSession)
    source = df.select(F.col(key).cast("string").alias("rec_key"), unwrap(F.col(doc)).alias("doc"))
    source = source.where(F.col("doc").rlike(r'^[\{\["`]') & F.col("rec_key").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = unwrap_all(batch.column(1))
            some = pc.fill_null(pc.match_substring_regex(texts, r"^[\{\[]"), False)
            batch = pa.RecordBatch.from_arrays([batch.column(0).filter(some), texts.filter(some)], ["rec_key", "doc"])
            yield from flatten_batch(batch, spec, bodies).combine_chunks().to_batches()

    return source.mapInArrow(run, NODE_SCHEMA)
