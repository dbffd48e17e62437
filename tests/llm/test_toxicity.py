import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldloom.llm import toxicity

DATA = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    models = toxicity.train(docs.where("doc_id % 4 != 0"), labels)
    scored = toxicity.score(docs.where("doc_id % 4 = 0"), models, keep=["doc_id"]).join(labels, "doc_id").select("toxic", "rejected").toPandas()
    hit = (scored.rejected == (scored.toxic == 1)).mean()
    assert len(scored) > 60 and hit > 0.9
    assert not scored.rejected[scored.toxic == 0].mean() > 0.02


def test_chain_feeds_out_of_fold_probabilities():
    rng = np.random.default_rng(1)
    n = 400
    first = rng.random(n) < 0.5
    rows = np.repeat(np.arange(n), 2)
    hashes = np.stack([np.where(first, 11, 12), rng.integers(100, 120, n)], 1).ravel()
    y2 = first.astype(float)
    models = toxicity.fit_chain(rows, hashes, [first.astype(float), y2], np.arange(n) % 5).models
    assert len(models[0].chained) == 0 and len(models[1].chained) == 1 and models[1].chained[0] > 0
    p = models[0].probability(rows, hashes, n, np.zeros((n, 0)))
    assert ((p > 0.5) == first).all()


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (2, "", None), (None, "idiot " * 100_000, "b")], "doc_id long, text string, rejected string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    models = toxicity.train(docs, labels)
    got = toxicity.score(docs, models, keep=["doc_id"]).collect()
    assert len(got) == 4 and all(r.p_toxic == 0 and r.rejected is False for r in got)
    assert toxicity.drop_toxic(docs, labels).columns == docs.columns
    odd = spark.createDataFrame([(1, None, None), (None, 1, 1), (2, 1, 1), (2, 1, 0), (9, 0, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.drop_toxic(docs, odd).count() in range(5)
    assert toxicity.score(docs.limit(0), models).count() == 0


def test_repeated_ids_are_fitted_once_in_any_order(spark):
    rows = [(i, f"{'fine good' if i % 2 else 'vile bad'} word{i} row{j}") for i in range(12) for j in range(9)]
    labels = spark.createDataFrame([(i, i % 3 % 2, 1 - i % 2) for i in range(12)], "doc_id long, quality int, toxic int")
    once = spark.createDataFrame([r for r in rows if r[1].endswith("row0")], "doc_id long, text string")
    got = [toxicity.train(d, labels, most=8) for d in (once, spark.createDataFrame(rows, once.schema), spark.createDataFrame(rows[::-1], once.schema).repartition(5))]
    for other in got[1:]:
        for a, b in zip(got[0].models, other.models):
            assert a.hashes.tolist() == b.hashes.tolist() and np.allclose(a.weights, b.weights)


def plain_features(text):
    """Of each word between white space: itself without signs around it, its beginnings of 4 to 6 letters, its last 4, the signs it ends in, and whether it is
    in capitals; as CRC-32."""
    out = set()
    for word in re.split("[ \t\n\r\x0b\x0c]+", text or ""):
        low = word.lower().strip(toxicity.STRIP)
        named = [low] if low else []
        named += [f"^{low[:n]}" for n in (4, 5, 6) if len(low) > n] + ([f"{low[-4:]}$"] if len(low) > 4 else [])
        named += [f"!{word[-2:]}"] if word and not word[-1].isalnum() else []
        named += ["UPPER"] if len(word) > 2 and word.isupper() else []
        out |= {crc32(x.encode()) for x in named}
    return out


class Plain:
    """A logistic regression over a dense table of ones and zeros: features that speak for the class by their z-score, 400 steps of Adam, weights of
    features held at zero or above."""

    def __init__(self, sets, y, earlier):
        p = y.mean() if len(y) else 0.0
        self.constant = None
        if p in (0.0, 1.0):
            self.share = p
            return
        names = sorted(set().union(*sets))
        x = np.array([[n in s for n in names] for s in sets], float)
        every, ones = x.sum(0), x[y == 1].sum(0)
        z = np.where(every >= 3, (ones - every * p) / np.sqrt(every * p * (1 - p) * (1 - every / (len(y) + 1)) + 1e-9), 0)
        chosen = sorted(sorted(range(len(names)), key=lambda i: (-z[i], names[i]))[:4096], key=lambda i: names[i])
        chosen = [i for i in chosen if z[i] > 3]
        self.names, table = [names[i] for i in chosen], np.column_stack([x[:, chosen], earlier, np.ones(len(y))])
        k = len(chosen)
        w = np.zeros(table.shape[1])
        w[-1] = np.log(p / (1 - p))
        m, v = np.zeros_like(w), np.zeros_like(w)
        for step in range(1, 401):
            slope = table.T @ (1 / (1 + np.exp(-table @ w)) - y) / len(y) + np.append(0.05 / len(y) * w[:-1], 0)
            m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
            w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
            w[:k] = np.maximum(w[:k], 0)
        self.w, self.constant = w, w[-1]

    def __call__(self, sets, earlier):
        if self.constant is None:
            return np.full(len(sets), self.share)
        return 1 / (1 + np.exp(-(np.column_stack([np.array([[n in s for n in self.names] for s in sets], float).reshape(len(sets), -1), earlier, np.ones(len(sets))]) @ self.w)))


def test_the_chain_by_brute_force(spark):
    """Folds, out-of-fold probabilities and the threshold, put together from dense tables."""
    draw = random.Random(2)
    mild, harsh, poor = [f"word{i}" for i in range(60)], ["idiot!", "SCUM", "trashy"], ["buy", "click", "http"]
    texts, labels = {}, {}
    for i in range(260):
        bad, low = i % 4 == 0, i % 3 == 0
        words = draw.choices(mild, k=draw.randrange(5, 40)) + (draw.sample(harsh, 2) if bad and draw.random() < 0.95 else []) + (draw.sample(poor, 2) if low else [])
        draw.shuffle(words)
        texts[i] = " ".join(words) if i != 7 else None
        if i < 200:
            labels[i] = (int(not low), int(bad))
    docs, told = spark.createDataFrame(list(texts.items()), "doc_id long, text string"), spark.createDataFrame([(i, *y) for i, y in labels.items()], "doc_id long, quality int, toxic int")
    folds = {r.doc_id: r.fold for r in told.select("doc_id", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(5)).alias("fold")).collect()}
    ids = sorted(labels)
    count = Counter(f for i in ids for f in plain_features(texts[i]))
    sets, fold = [{f for f in plain_features(texts[i]) if count[f] >= 3} for i in ids], np.array([folds[i] for i in ids])
    earlier, models = np.zeros((len(ids), 0)), []
    for y in (np.array([1.0 - labels[i][0] for i in ids]), np.array([float(labels[i][1]) for i in ids])):
        outside = np.zeros(len(ids))
        for f in range(5):
            inside = [k for k in range(len(ids)) if fold[k] != f]
            there = [k for k in range(len(ids)) if fold[k] == f]
            outside[there] = Plain([sets[k] for k in inside], y[inside], earlier[inside])([sets[k] for k in there], earlier[there])
        models.append(Plain(sets, y, earlier))
        earlier = np.column_stack([earlier, outside])
    best = max(sorted(set(outside)), key=lambda t: (2 * (y[outside >= t]).sum() / (y.sum() + (outside >= t).sum()), t))
    below = outside[outside < best]
    threshold = min(0.5, max(0.05, (best + (below.max() if len(below) else best)) / 2))
    got = {r.doc_id: r for r in toxicity.score(docs, toxicity.train(docs, told)).collect()}
    every = [plain_features(texts[i]) for i in sorted(texts)]
    first = models[0](every, np.zeros((len(every), 0)))
    second = models[1](every, first[:, None])
    for i, a, b in zip(sorted(texts), first, second):
        assert got[i].p_low_quality == pytest.approx(a, abs=1e-6) and got[i].p_toxic == pytest.approx(b, abs=1e-6)
        assert got[i].rejected == (b >= threshold)
    assert sum(r.rejected for r in got.values()) > 40
