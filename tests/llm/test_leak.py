import random

import numpy as np
import pytest

from lexispark.llm import leak
from lexispark.llm.leak import leaked_items

VOCAB = [f"{a}{b}{c}" for a in ("ca", "to", "mi", "ré", "lu", "pa") for b in ("vi", "so", "ne", "ra") for c in ("do", "la", "mos")]
DOC, ITEM = "doc_id bigint, text string, item_id bigint, words string", "item_id bigint, text string, doc_id bigint"


def words(rng, n):
    return [rng.choice(VOCAB) for _ in range(n)]


def test_held_by_half_with_noise_and_shorter_borrowings_not(spark):
    rng = random.Random(2)
    items = {i: words(rng, rng.choice([12, 24, 40, 70, 150])) for i in range(60)}
    docs, truth = [], set()
    for d in range(400):
        host = words(rng, rng.choice([0, 30, 300, 3000]))
        i = rng.randrange(60)
        kind = d % 4
        if kind < 3:
            n = len(items[i])
            share = [1.0, 0.65, 0.25][kind]
            m = int(n * share)
            a = rng.randint(0, n - m)
            part = items[i][a : a + m]
            if kind == 1 and m > 20:
                part[m // 2] = "outra"
            if kind == 0 and n > 30:
                part[n // 2 : n // 2] = words(rng, 6)
            if share >= 0.5:
                truth.add((d, i))
            at = rng.randint(0, len(host))
            host = host[:at] + part + host[at:]
        text = ""
        for w in host:
            text += rng.choice([w, w.upper(), w.capitalize()]) + rng.choice([" ", ", ", ".\n", "  "])
        docs.append((d, text, 0, "clash"))
    got = leaked_items(spark.createDataFrame(docs, DOC), spark.createDataFrame([(k, " ".join(v), 0) for k, v in items.items()], ITEM))
    rows = got.collect()
    assert {(r.doc_id, r.item_id) for r in rows} == truth
    assert len(rows) == len(truth)


def rare(rng):
    return "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(4))


@pytest.mark.parametrize("full_filters", [False, True])
def test_items_of_every_size_held_by_exactly_half(spark, monkeypatch, full_filters):
    """Every size from 1 to 64 words is found, also with filters so small that they let everything through."""
    if full_filters:
        monkeypatch.setattr(leak, "MAX_FILTER_BITS", 1024)
    rng = random.Random(7)
    per_size = 6
    items = {n * 100 + k: [rare(rng) for _ in range(n)] for n in range(1, 65) for k in range(per_size)}
    docs, truth = [], set()
    for d, (i, w) in enumerate(items.items()):
        m = (len(w) + 1) // 2
        a = rng.randint(0, len(w) - m)
        docs.append((d, " ".join([rare(rng) for _ in range(rng.randint(0, 120))] + w[a : a + m] + [rare(rng) for _ in range(40)]), 0, ""))
        truth.add((d, i))
    got = {(r.doc_id, r.item_id) for r in leaked_items(spark.createDataFrame(docs, DOC), spark.createDataFrame([(k, " ".join(v), 0) for k, v in items.items()], ITEM)).collect()}
    for n in range(1, 65):
        mine = {x for x in truth if x[1] // 100 == n}
        assert len(got & mine) >= 0.9 * len(mine), n
    assert got <= truth


def test_half_with_changed_words_is_met_by_the_index():
    """Share of half-held items of 33 to 48 words with three changed words whose bands agree often enough."""
    rng = np.random.default_rng(3)
    n, height, least = leak.bands_of(48)
    met = 0
    for _ in range(200):
        item = rng.integers(0, 1 << 62, 40).astype(np.uint64)
        text = np.r_[item[5:25], rng.integers(0, 1 << 62, 5).astype(np.uint64)]
        text[[5, 10, 15]] = rng.integers(0, 1 << 62, 3).astype(np.uint64)
        of = lambda x: leak.shingles(x, np.zeros(len(x), int), 3)[0]
        a, b = of(item), of(text)
        b = b[np.isin(b, a)]
        met += (leak.band_keys(a, np.array([0, len(a)]), 48) == leak.band_keys(b, np.array([0, len(b)]), 48)).sum() >= least
    assert met >= 180


def test_copies_of_items_and_of_documents(spark):
    rng = random.Random(4)
    items = [words(rng, 30) for _ in range(5)]
    docs = spark.createDataFrame([(i, " ".join(words(rng, 100) + items[i % 5] + words(rng, 100)), 0, "") for i in range(20)] + [(100 + i, " ".join(items[0]), 0, "") for i in range(50)], DOC)
    table = spark.createDataFrame([(k * 10 + i, " ".join(w), 0) for i, w in enumerate(items) for k in range(4)], ITEM)
    got = {(r.doc_id, r.item_id) for r in leaked_items(docs, table).collect()}
    assert got == {(i, k * 10 + i % 5) for i in range(20) for k in range(4)} | {(100 + i, k * 10) for i in range(50) for k in range(4)}


def test_nulls_empty_short_and_repeated(spark):
    text = "um dois três quatro cinco seis sete oito nove dez"
    docs = spark.createDataFrame([(None, text, 0, ""), (1, None, 0, ""), (2, "", 0, ""), (3, "um dois", 0, ""), (4, text, 0, ""), (4, text, 0, "")], DOC)
    items = spark.createDataFrame([(None, text, 0), (1, None, 0), (2, "", 0), (3, "um dois", 0), (4, text, 0), (5, text, 0), (5, text, 0), (6, "oito nove dez", 0), (7, "onze", 0), (8, "dez", 0)], ITEM)
    assert sorted((r.doc_id, r.item_id, round(r.share, 3)) for r in leaked_items(docs, items).collect()) == [(3, 3, 1.0), (4, 3, 1.0), (4, 4, 1.0), (4, 5, 1.0), (4, 6, 1.0), (4, 8, 1.0)]
    assert leaked_items(docs.limit(0), items).count() == 0
    assert leaked_items(docs, items.limit(0)).count() == 0


def test_very_long_texts(spark):
    rng = random.Random(9)
    item, long_item = words(rng, 40), words(rng, 3000)
    host = words(rng, 60_000)
    docs = spark.createDataFrame([(1, " ".join(host[:30_000] + item + host[30_000:]), 0, ""), (2, " ".join(host + long_item[:1600]), 0, "")], DOC)
    got = {(r.doc_id, r.item_id) for r in leaked_items(docs, spark.createDataFrame([(1, " ".join(item), 0), (2, " ".join(long_item), 0)], ITEM)).collect()}
    assert got == {(1, 1), (2, 2)}
