"""Evaluation texts inside training texts: size-partitioned MinHash containment search, verified by exact shingles.

Test items of equal words form one class. Classes are partitioned by size, and every partition has its own banded
MinHash index: rows (band key, class). Documents are read once, whatever the number of items. For each partition a
document is cut into overlapping windows of three quarters of the partition's upper size, so a short item meets windows
of its own size inside a long document. A window's signature is taken over those of its shingles that a Bloom filter
does not rule out for the partition (foreign shingles cannot change how much of an item a window holds), and only bands
that a second filter does not rule out leave the scan. Those meet the index in one join; windows that agree with a class
in enough bands are read once more, only from the documents they stand in, and verified word by word: shared shingles
are chained in order on neighbouring diagonals.

Both filters have a bounded size; beyond it they let more through, which the joins and the verification settle. Neither
items nor documents are read to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.functions.fold import unaccent_lower
from lexispark.session import cut, ship_package

SHINGLE_WORDS = 3  # an item may be held by half and with changed words: five-word shingles would lose such cases
SHORT_ITEM = 8  # items of so many words or fewer have shingles of two words, items of one or two words single words
ONE_ROW_LEVEL = 16  # up to this size 64 bands of one row, one of which must agree: few shingles are shared there
BANDS = (64, 1, 1)  # bands, rows of a band, bands that must agree
LARGE_BANDS = (128, 2, 3)  # half of an item with three changed words (Jaccard 0.24) is met with 98 %
MIN_SHARE = 0.48
DIAGONAL_SLACK = 16
MAX_GAP = 3
MAX_FILTER_BITS = 1 << 26
FILTER_HASHES = 4
BITS_PER_KEY = 16
SLICE = 1024  # documents hashed at a time
CHUNK = 1 << 14  # shingles whose hash family is held at a time
_MIX = np.uint64(0x9E3779B97F4A7C15)


def plain_words(c: Column) -> Column:
    """Lower-case accent-free words separated by single blanks; words broken at a line end are joined."""
    # the look back stands behind the mark: it is taken only where there is one
    joined = F.regexp_replace(c, r"[-­¬‐](?<=\p{L}.) *\r?\n *(?=\p{L})|­(?<=\p{L}.)(?=\p{L})", "")
    return F.trim(F.regexp_replace(unaccent_lower(joined), r"[^\p{L}\p{N}]+", " "))


def level_of(size: int) -> int:
    """Upper size of an item's partition: 2, 3, 4, 6, 8, 12, 16, 24, ..."""
    level = 2
    while level < size:
        level = level * 3 // 2 if level & (level - 1) == 0 else level * 4 // 3
    return level


def shingle_words(level: int) -> int:
    return 1 if level <= 2 else 2 if level <= SHORT_ITEM else SHINGLE_WORDS


def allowed_gap(size: int) -> int:
    """Changed words between two shared shingles that count as held: one in eight words of the item, at most MAX_GAP."""
    return min(MAX_GAP, size // 8)


def least_shared(level: int, smallest: int) -> int:
    """Shared shingles without which no window can hold half of an item: a shingle covers its words and a gap, and at
    least half of them stand in one window."""
    return max(1, math.ceil(MIN_SHARE * smallest / (shingle_words(level) + allowed_gap(level)) / 2))


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(29))


def hash_words(words: pa.Array) -> np.ndarray:
    """64-bit hashes of a string array (FNV over padded bytes, vectorised over the distinct words)."""
    enc = words.dictionary_encode()
    d = enc.dictionary.cast(pa.large_binary())
    if not len(d):
        return np.zeros(0, np.uint64)
    off = np.frombuffer(d.buffers()[1], np.int64, len(d) + 1, d.offset * 8)
    raw = np.frombuffer(d.buffers()[2], np.uint8) if d.buffers()[2] is not None else np.zeros(0, np.uint8)
    size = np.diff(off)
    h = np.full(len(d), 0xCBF29CE484222325, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(int(size.max())):
            live = np.flatnonzero(size > i)
            h[live] = (h[live] ^ raw[off[live] + i]) * np.uint64(0x100000001B3)
    return _mixed(h)[enc.indices.to_numpy(zero_copy_only=False)]


def shingles(h: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of shingles of ``n`` words and the place of their first word; shingles never cross two texts."""
    if len(h) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    s = h[: len(h) - n + 1].copy()
    with np.errstate(over="ignore"):
        for i in range(1, n):
            s = (s ^ (s >> np.uint64(31))) * _MIX + h[i : len(h) - n + 1 + i]
    at = np.flatnonzero(owner[: len(h) - n + 1] == owner[n - 1 :])
    return s[at], at


def at_level(s: np.ndarray, level: int) -> np.ndarray:
    """Shingle hashes of one partition: the same shingle differs between partitions."""
    return _mixed(s ^ np.uint64((level * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF))


def bands_of(level: int) -> tuple[int, int, int]:
    return BANDS if level <= ONE_ROW_LEVEL else LARGE_BANDS


def band_keys(s: np.ndarray, edge: np.ndarray, level: int) -> np.ndarray:
    """Band keys (rows: groups) of groups of shingles ``s[edge[i]:edge[i + 1]]``, none of them empty."""
    n, height, _ = bands_of(level)
    k = np.arange(1, n * height + 1, dtype=np.uint64) * _MIX
    rows = []
    first = 0
    while first < len(edge) - 1:  # whole groups, about CHUNK shingles at a time
        last = max(first + 1, int(np.searchsorted(edge, edge[first] + CHUNK, "right")) - 1)
        part, code = np.unique(s[edge[first] : edge[last]], return_inverse=True)
        family = (_mixed(part[:, None] ^ k[None, :]) >> np.uint64(32)).astype(np.uint32)
        rows.append(np.minimum.reduceat(family[code], edge[first:last] - edge[first], axis=0))
        first = last
    sig = np.concatenate(rows) if rows else np.zeros((0, n * height), np.uint32)
    key = np.arange(n, dtype=np.uint64) + np.uint64(level << 8)
    for r in range(height):
        key = _mixed(key ^ (sig[:, r::height].astype(np.uint64) + np.uint64(r << 32)))
    return key


# ---- filters -------------------------------------------------------------------------------------------------------
def _spots(keys: np.ndarray, bits: int) -> np.ndarray:
    step = _mixed(keys) | np.uint64(1)
    with np.errstate(over="ignore"):
        return np.stack([((keys + step * np.uint64(i)) >> np.uint64(7)) & np.uint64(bits - 1) for i in range(FILTER_HASHES)]).astype(np.int64)


def maybe_in(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    """False where a key is certainly not in the filter."""
    bits = len(table) * 64
    step = _mixed(keys) | np.uint64(1)
    ok = np.arange(len(keys))
    for i in range(FILTER_HASHES):  # later probes only for what is left
        with np.errstate(over="ignore"):
            p = (((keys[ok] + step[ok] * np.uint64(i)) >> np.uint64(7)) & np.uint64(bits - 1)).astype(np.int64)
        ok = ok[(table[p >> 6] >> (p & 63)) & 1 == 1]
    hit = np.zeros(len(keys), bool)
    hit[ok] = True
    return hit


def key_filter(rows: DataFrame, column: str, n: int) -> np.ndarray:
    """Bloom filter of the keys in an array column: words of 64 bits, combined in the executors, at most
    MAX_FILTER_BITS; the driver receives one row per word that is set."""
    bits = 1 << max(10, min(MAX_FILTER_BITS.bit_length() - 1, math.ceil(math.log2(max(n, 1) * BITS_PER_KEY))))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            p = np.unique(_spots(keys, bits).ravel())
            w, first = np.unique(p >> 6, return_index=True)
            one = np.left_shift(np.int64(1), p & 63)
            yield pa.record_batch({"w": pa.array(w), "b": pa.array(np.bitwise_or.reduceat(one, first) if len(w) else np.zeros(0, np.int64))})

    words = rows.select(column).mapInArrow(fold, "w bigint, b bigint").groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    table = np.zeros(bits // 64, np.int64)
    table[words["w"].to_numpy()] = words["b"].to_numpy()
    return table


# ---- items ---------------------------------------------------------------------------------------------------------
def _text_lists(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words of the texts, the text each belongs to, and where each text begins."""
    lists = pc.split_pattern(texts, " ")
    words = lists.flatten()
    first = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    return words, pc.list_parent_indices(lists).to_numpy(zero_copy_only=False), first


def _lists(flat: np.ndarray, edge: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(flat, kind))


ITEM_SCHEMA = "class string, size int, level int, keys array<bigint>, places array<int>, bands array<bigint>"


def _index_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, owner, first = _text_lists(batch.column("words"))
        h = hash_words(words)
        size = np.diff(first)
        levels = np.array([level_of(int(n)) for n in size])
        for level in np.unique(levels).tolist():
            some = np.flatnonzero(levels == level)
            s, at = shingles(h, owner, shingle_words(level))
            mine = np.isin(owner[at], some)
            s, at = at_level(s[mine], level), at[mine]
            edge = np.searchsorted(owner[at], np.r_[some, len(size)])
            edge[-1] = len(at)
            places = at - first[owner[at]]
            bands = band_keys(s, edge, level)
            yield pa.record_batch(
                {
                    "class": batch.column("class").take(pa.array(some)), "size": pa.array(size[some], pa.int32()), "level": pa.array(np.full(len(some), level), pa.int32()),
                    "keys": _lists(s.view(np.int64), edge, pa.int64()), "places": _lists(places, edge, pa.int32()),
                    "bands": _lists(bands.ravel().view(np.int64), np.arange(len(some) + 1) * bands.shape[1], pa.int64()),
                }
            )


# ---- documents -----------------------------------------------------------------------------------------------------
WINDOW_SCHEMA = "doc_id bigint, level int, at int, bands array<bigint>"
REGION_SCHEMA = "doc_id bigint, level int, at int, keys array<bigint>, places array<int>"


@dataclass(frozen=True)
class Index:
    """What a scan of documents needs of the items: partitions ``(level, least shared shingles)`` and both filters."""

    partitions: tuple[tuple[int, int], ...]
    known: np.ndarray
    bands: np.ndarray


def stride_of(level: int) -> int:
    """Words between two windows; a window has three times as many."""
    return max(1, round(level / 4))


def windows_at(s: np.ndarray, at: np.ndarray, owner: np.ndarray, first: np.ndarray, level: int, least: int, bands: np.ndarray):
    """Windows of one partition with bands of the index: (text, first word of the window, band lists)."""
    stride = stride_of(level)
    doc = owner[at].astype(np.int64)
    strip = (at - first[doc]) // stride
    # windows of three strips; a window's number is that of its first strip, from -2 on
    key = np.concatenate([(doc << 34) + (strip - j + 2) for j in range(3)])
    order = np.lexsort((np.tile(s, 3), key))
    key, flat = key[order], np.tile(s, 3)[order]
    fresh = np.r_[True, (key[1:] != key[:-1]) | (flat[1:] != flat[:-1])][: len(key)]
    key, flat = key[fresh], flat[fresh]
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
    count = np.diff(np.r_[start, len(key)])
    # of neighbouring windows with the same shingles one is enough
    with np.errstate(over="ignore"):
        total = np.add.reduceat(_mixed(flat), start)
    again = np.r_[False, (total[1:] == total[:-1]) & (key[start[1:]] >> 34 == key[start[:-1]] >> 34)]
    enough = (count >= least) & ~again
    kept = np.repeat(enough, count)
    key, flat, count = key[kept], flat[kept], count[enough]
    if not len(key):
        return None
    edge = np.r_[0, np.cumsum(count)]
    sig = band_keys(flat, edge, level)
    hit = maybe_in(sig.ravel(), bands).reshape(sig.shape)
    found = hit.sum(axis=1)
    win = np.flatnonzero(found >= bands_of(level)[2])
    group = key[edge[win]]
    begin = ((group & ((1 << 34) - 1)) - 2) * stride
    return group >> 34, begin, _lists(sig[win][hit[win]].view(np.int64), np.r_[0, np.cumsum(found[win])], pa.int64())


def _known(h: np.ndarray, owner: np.ndarray, level: int, table: np.ndarray, made: dict) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of the texts that may belong to items of a partition, and where they stand."""
    n = shingle_words(level)
    if n not in made:
        s, at = shingles(h, owner, n)
        seen = maybe_in(s, table)
        made[n] = s[seen], at[seen]
    s, at = made[n]
    s = at_level(s, level)
    seen = maybe_in(s, table)
    return s[seen], at[seen]


def scan_texts(ids: pa.Array, texts: pa.Array, index: Index) -> Iterator[pa.RecordBatch]:
    words, owner, first = _text_lists(texts)
    h = hash_words(words)
    made: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for level, least in index.partitions:
        s, at = _known(h, owner, level, index.known, made)
        found = windows_at(s, at, owner, first, level, least, index.bands) if len(s) else None
        if found:
            d, begin, bands = found
            yield pa.record_batch({"doc_id": ids.take(pa.array(d)), "level": pa.array(np.full(len(d), level), pa.int32()), "at": pa.array(begin, pa.int32()), "bands": bands})


def read_regions(ids: pa.Array, texts: pa.Array, wanted: pa.Array, known: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Shingles in and around the wanted windows ``(level, at)`` of every text."""
    words, owner, first = _text_lists(texts)
    h = hash_words(words)
    flat, of = wanted.flatten(), pc.list_parent_indices(wanted).to_numpy(zero_copy_only=False).astype(np.int64)
    levels, starts = flat.field("level").to_numpy(zero_copy_only=False), flat.field("at").to_numpy(zero_copy_only=False).astype(np.int64)
    made: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for level in np.unique(levels).tolist():
        s, at = _known(h, owner, level, known, made)
        some = levels == level
        d, start = of[some], starts[some]
        reach = level + DIAGONAL_SLACK
        lo = np.searchsorted(at, np.maximum(first[d], first[d] + start - reach))
        hi = np.searchsorted(at, np.minimum(first[d + 1], first[d] + start + 3 * stride_of(level) + reach))
        span = np.maximum(hi - lo, 0)
        edge = np.r_[0, np.cumsum(span)]
        around = np.repeat(lo - edge[:-1], span) + np.arange(edge[-1])
        places = at[around] - np.repeat(first[d], span)
        yield pa.record_batch({"doc_id": ids.take(pa.array(d)), "level": pa.array(np.full(len(d), level), pa.int32()), "at": pa.array(start, pa.int32()), "keys": _lists(s[around].view(np.int64), edge, pa.int64()), "places": _lists(places, edge, pa.int32())})


# ---- verification --------------------------------------------------------------------------------------------------
def held_share(pairs: list[tuple[int, int]], size: int, words: int = SHINGLE_WORDS) -> float:
    """Largest share of an item's words held in one place: shared shingles of ``words`` words (place in text, place in
    item) are chained on diagonals at most DIAGONAL_SLACK apart (a stray line shifts the diagonal); a few changed words
    between two shingles of one diagonal count as held."""
    best = 0.0
    gap = allowed_gap(size)
    by_diagonal: dict[int, list[int]] = {}
    for t, i in sorted(set(pairs)):
        by_diagonal.setdefault(t - i, []).append(i)
    spans: dict[int, list[tuple[int, int]]] = {}
    for d, starts in by_diagonal.items():
        out: list[tuple[int, int]] = []
        for i in sorted(starts):
            if out and i <= out[-1][1] + gap:
                out[-1] = (out[-1][0], i + words)
            else:
                out.append((i, i + words))
        spans[d] = out
    order = sorted(spans)
    for d0 in order:
        chain = sorted(((a, b, d) for d in order if d0 <= d <= d0 + DIAGONAL_SLACK for a, b in spans[d]), key=lambda x: (x[0] + x[2], x[0]))
        # longest in-order chain: spans in text order must also advance in the item
        held = [0] * len(chain)
        for x, (a, b, d) in enumerate(chain):
            held[x] = b - a
            for y in range(x):
                ya, yb, yd = chain[y]
                if ya < a and yb + yd <= b + d:
                    held[x] = max(held[x], held[y] + b - max(a, yb))
        if held:
            best = max(best, max(held) / size)
    return best


def _shared(text: pa.ListArray, item: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal shingles of the two lists of every row: (row, place in the flat text list, place in the flat item list)."""
    flat = lambda x: (x.flatten().to_numpy(zero_copy_only=False).view(np.uint64), pc.list_parent_indices(x).to_numpy(zero_copy_only=False).astype(np.uint64))
    (t, t_row), (i, i_row) = flat(text), flat(item)
    with np.errstate(over="ignore"):
        t, i = t ^ _mixed(t_row * _MIX), i ^ _mixed(i_row * _MIX)
    order = np.argsort(i, kind="stable")
    lo, hi = np.searchsorted(i[order], t), np.searchsorted(i[order], t, "right")
    n = hi - lo
    at = np.repeat(np.arange(len(t)), n)
    to = order[np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]][: len(n)], n) + np.arange(int(n.sum()))]
    same = t_row[at] == i_row[to]
    return t_row[at[same]].astype(np.int64), at[same], to[same]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates that hold enough. Every shared place of the item accounts for its shingle and a gap at most, so rows
    with too few are left out before any chain is built."""
    for batch in batches:
        col = lambda name: batch.column(batch.schema.get_field_index(name))
        row, at, to = _shared(col("keys"), col("i_keys"))
        t_at, i_at = (col(x).flatten().to_numpy(zero_copy_only=False) for x in ("places", "i_places"))
        size, level = col("size").to_numpy(), col("level").to_numpy()
        reach = np.array([shingle_words(x) + allowed_gap(x) for x in level.tolist()])
        places = np.bincount(np.unique(row << 32 | to) >> 32, minlength=len(size))
        edge = np.searchsorted(row, np.arange(len(size) + 1))
        share = np.zeros(len(size))
        for r in np.flatnonzero(places * reach >= MIN_SHARE * size).tolist():
            some = slice(edge[r], edge[r + 1])
            share[r] = held_share(list(zip(t_at[at[some]].tolist(), i_at[to[some]].tolist())), int(size[r]), shingle_words(int(level[r])))
        kept = np.flatnonzero(share >= MIN_SHARE)
        yield pa.record_batch({"doc_id": col("doc_id").take(pa.array(kept)), "class": col("class").take(pa.array(kept)), "share": pa.array(share[kept])})


def leaked_items(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Leaks ``(doc_id, item_id, share)``: documents that hold at least half of an item's words in order in one place.

    Letter case, accents, punctuation, line breaks, a stray line between and a few changed words do not matter (of items
    under eight words no word may be changed within the held part). Items of any length are searched; a single word is
    held by every document with that word. Null ids, null texts and texts without a word match nothing; an id delivered
    twice is reported once with its largest share; empty tables give no rows. Building the result runs jobs: items are
    indexed and the two filters built at once.
    """
    spark = documents.sparkSession
    ship_package(spark)
    wanted = items.select(F.col(item_id).cast("bigint").alias("item_id"), plain_words(F.col(item_text)).alias("words")).where(F.col("item_id").isNotNull() & (F.col("words") != "")).withColumn("class", F.md5("words"))
    members = wanted.select("class", "item_id").distinct()
    index = cut(wanted.groupBy("class").agg(F.first("words").alias("words")).mapInArrow(_index_items, ITEM_SCHEMA))
    sizes = index.groupBy("level").agg(F.min("size").alias("smallest"), F.sum(F.size("keys")).alias("n_keys"), F.sum(F.size("bands")).alias("n_bands")).orderBy("level").collect()  # one row a size partition
    schema = "doc_id bigint, item_id bigint, share double"
    if not sizes:
        return spark.createDataFrame([], schema)
    # both the shingle as it is and the shingle of its partition: most shingles of texts are ruled out by one probe
    bare = wanted.groupBy("class").agg(F.first("words").alias("words")).mapInArrow(_bare_shingles, "keys array<bigint>")
    known = key_filter(index.select("keys").unionByName(bare), "keys", 2 * sum(r["n_keys"] for r in sizes))
    bands = key_filter(index.select("bands"), "bands", sum(r["n_bands"] for r in sizes))
    sent = spark.sparkContext.broadcast((tuple((r["level"], least_shared(r["level"], r["smallest"])) for r in sizes), known, bands))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(*sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                some = batch.slice(at, SLICE)
                yield from scan_texts(some.column(0), some.column(1), index)

    def regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value[1]
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                some = batch.slice(at, SLICE)
                yield from read_regions(some.column(0), some.column(1), some.column(2), known)

    source = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("body")).where(F.col("doc_id").isNotNull() & (F.col("body") != ""))
    windows = source.select("doc_id", plain_words(F.col("body")).alias("words")).where("words != ''").mapInArrow(scan, WINDOW_SCHEMA)
    entries = index.select("class", "level", F.explode("bands").alias("band"))
    least = F.when(F.col("level") <= ONE_ROW_LEVEL, BANDS[2]).otherwise(LARGE_BANDS[2])
    pairs = windows.select("doc_id", "at", F.explode("bands").alias("band")).join(entries, "band").groupBy("doc_id", "level", "at", "class").agg(F.count("*").alias("n"))
    pairs = cut(pairs.where(F.col("n") >= least).drop("n"))
    wanted = pairs.groupBy("doc_id").agg(F.collect_set(F.struct("level", "at")).alias("windows"))  # bounded by the length of the text
    again = source.join(wanted, "doc_id").select("doc_id", plain_words(F.col("body")).alias("words"), "windows").mapInArrow(regions, REGION_SCHEMA)
    item = index.select("class", "size", F.col("keys").alias("i_keys"), F.col("places").alias("i_places"))
    ready = again.join(pairs, ["doc_id", "level", "at"]).join(item, "class")
    verified = ready.select("doc_id", "class", "size", "level", "keys", "places", "i_keys", "i_places").mapInArrow(_verify, "doc_id bigint, class string, share double")
    held = verified.groupBy("doc_id", "class").agg(F.max("share").alias("share"))
    return held.join(members, "class").groupBy("doc_id", "item_id").agg(F.max("share").alias("share"))


def _bare_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, owner, first = _text_lists(batch.column("words"))
        h, levels = hash_words(words), np.array([level_of(int(n)) for n in np.diff(first)])
        n_words = np.array([shingle_words(x) for x in levels])
        for n in np.unique(n_words).tolist():
            s, at = shingles(h, owner, n)
            s = s[n_words[owner[at]] == n]
            yield pa.record_batch({"keys": _lists(s.view(np.int64), np.array([0, len(s)]), pa.int64())})
