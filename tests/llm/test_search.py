import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import types as T

from fieldloom.llm import search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, k=10):
    """(item, rank, doc_id, score), by the words of the contract."""
    terms = [(d, [w.translate(LOWER) for w in TERM.findall(t or "")]) for d, t in docs]
    terms = [(d, ws) for d, ws in terms if ws]
    n, total = len(terms), sum(len(ws) for _, ws in terms)
    df = Counter(w for _, ws in terms for w in set(ws))
    asked, out = {}, []
    for i, t in items:
        asked.setdefault(i, set()).update(w.translate(LOWER) for w in TERM.findall(t or ""))
    for i, words in asked.items():
        scored = []
        for d, ws in terms:
            tf, m = Counter(ws), 10 + (90 * len(ws) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * tf[w] // (1000 * tf[w] + 8 * m)) for w in words if tf[w])
            if s:
                scored.append((-s, d is None, d or 0, d))
        out += [(i, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return out


def rows(frame):
    return sorted(map(tuple, frame.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


DOCS, ITEMS = "doc_id long, text string, score string, rank int, terms string", "item_id long, text string, doc_id long"


def make(spark, docs, items):
    return spark.createDataFrame([(d, t, "x", 1, "y") for d, t in docs], DOCS), spark.createDataFrame([(i, t, 3) for i, t in items], ITEMS)


def test_ranks_by_brute_force(spark):
    draw = random.Random(3)
    words = [f"w{i}" for i in range(40)] + ["É", "日本", "Ü1", "A"]
    text = lambda n: " -".join(draw.choices(words, weights=range(len(words), 0, -1), k=n))
    docs = [(i, text(draw.choice((1, 5, 30, 400)))) for i in range(300)]
    docs += [(500, None), (501, ""), (502, "!?"), (None, text(30)), (None, "日本"), (7, docs[7][1]), (503, "é"), (504, "zzz " * 3000 + "日本")]
    docs += [(600 + i, docs[3][1]) for i in range(90)]  # copies: equal scores
    items = [(i, text(draw.choice((1, 3, 12)))) for i in range(20)] + [(50, None), (51, ""), (52, "nowhere"), (None, "w1"), (None, "w2 日本"), (3, "w9"), (53, "É é"), (54, "W3 w3")]
    d, i = make(spark, docs, items)
    want = sorted(brute(docs, items), key=repr)
    assert rows(search.search(d.repartition(3), i)) == want
    assert rows(search.search(d, i, block_bytes=100)) == want  # several blocks of items
    assert rows(search.search(d, i, k=3)) == sorted(brute(docs, items, 3), key=repr)


def test_nothing_in_nothing_out(spark):
    d, i = make(spark, [(1, "a b")], [(1, "a")])
    for docs, items in ((d.limit(0), i), (d, i.limit(0)), (d.where("doc_id = 2"), i.limit(0))):
        got = search.search(docs, items)
        assert got.count() == 0 and [f.dataType for f in got.schema] == [T.LongType(), T.IntegerType(), T.LongType(), T.LongType()]
    assert rows(search.search(d, i)) == brute([(1, "a b")], [(1, "a")])


def test_blocks_are_passed_over():
    """One range of documents after the other gives what all at once give; bounds leave most blocks unread."""
    rng = np.random.default_rng(1)
    n, vocabulary = 4000, 50
    held = [np.unique(rng.zipf(1.5, 12) % vocabulary) for _ in range(n)]
    times = [rng.integers(1, 4, len(h)) for h in held]
    for d in range(0, n, 800):  # a few documents that hold the rare term often
        held[d], times[d] = np.array([41, 42]), np.array([30, 40])
    lengths = np.array([t.sum() + 5 for t in times])
    weights = rng.integers(1, 9000, vocabulary)
    queries = [np.array([41, 42]), np.array([1, 2, 3, 42])]
    ends, ids = np.cumsum([len(h) for h in held]), np.arange(n)
    total = int(lengths.sum())
    best = search.Best(queries, weights, n, total, 5)
    for a in range(0, n, 512):
        z = min(n, a + 512)
        base = ends[a - 1] if a else 0
        best.add(ids[a:z], np.zeros(z - a, np.int64), lengths[a:z], ends[a:z] - base, np.concatenate(held[a:z]), np.concatenate(times[a:z]))
    for q, found in zip(queries, best.found):
        m = 10 + 90 * lengths * n // total
        score = [sum(int(weights[t]) * (10**9 * int(c) // (1000 * int(c) + 8 * int(m[d]))) for t, c in zip(held[d], times[d]) if t in q) for d in range(n)]
        want = sorted((-s, d) for d, s in enumerate(score) if s)[:5]
        assert [(-int(s), int(d)) for s, _, d in zip(*found)] == want
    assert best.scored < 0.8 * 2 * -(-n // search.BLOCK_DOCS)
