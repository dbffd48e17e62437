import random

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash

from fieldloom.llm import simhash

DATA = "/root/testdata/sf0.001"


def brute_print(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    ids, fps = [i for i, _ in prints], np.array([f for _, f in prints], np.uint64)
    root = list(range(len(ids)))

    def up(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 2):
            a, b = up(i), up(int(j))
            root[max(a, b)] = min(a, b)
    least = {}
    for i, x in enumerate(ids):
        r = up(i)
        least[r] = min(least.get(r, x), x)
    return {x: least[up(i)] for i, x in enumerate(ids)}


def test_fingerprint_is_the_stated_one():
    texts = [None, "", "  ", "One", "one two", "A b\tC d e f g ä ö x y", *pq.read_table(f"{DATA}/documents.parquet").column("text").to_pylist()[:30]]
    assert [simhash.fingerprint(t) for t in texts] == [brute_print(t) for t in texts]


@pytest.mark.parametrize("large", [4096, 3])
def test_components_equal_brute_force(spark, large):
    rng = random.Random(5)
    prints = []
    for c in range(30):
        base = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 5, 40])):
            fp = base
            for _ in range(rng.randrange(5)):
                fp ^= 1 << rng.randrange(64)
            prints.append((len(prints), fp))
    prints += [(1000 + i, 0) for i in range(5)] + [(2000, 3), (2001, 7), (2002, 2**64 - 1)]
    rng.shuffle(prints)
    rows = [(i, fp - (1 << 64) if fp >> 63 else fp) for i, fp in prints]
    frame = spark.createDataFrame(rows, "doc_id long, fp long")
    got = {r.fp: r.component_id for r in simhash.classes(frame, large=large).collect()}
    want = brute_components(prints)
    assert {i: got[f] for i, f in rows} == want


def test_query_over_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = {r.doc_id: (r.fp, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    rows = docs.select("doc_id", "text").collect()
    prints = [(r.doc_id, brute_print(r.text)) for r in rows]
    want = brute_components(prints)
    assert {i: c for i, (_, c) in got.items()} == want
    assert {i: f & (2**64 - 1) for i, (f, _) in got.items()} == dict(prints)
    kept = {r.doc_id for r in simhash.keep_one(docs).collect()}
    assert kept == set(want.values())


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0
    rows = [(1, None, "x"), (1, None, "x"), (2, "", None), (None, "a b c d", "y"), (7, "word " * 200_000, "z"), (8, "word " * 200_000, "z")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted((r.doc_id or -1, r.component_id) for r in simhash.near_duplicates(odd).collect())
    assert got[1:] == [(1, 1), (1, 1), (2, 1), (7, 7), (8, 7)] and len(got) == 6
    assert sorted(r.doc_id or -1 for r in simhash.keep_one(odd).collect()) == [-1, 1, 7]


def test_keep_one_with_repeated_and_missing_ids(spark):
    a, b, c, d = ("".join(f"{w}{i} " for i in range(60)) for w in ("alpha", "beta", "gamma", "delta"))
    rows = [(1, a, "x"), (1, b, "y"), (2, b, "z"), (3, c, "x"), (4, c, "y"), (4, a, "x"), (None, c, "x"), (None, d, "x"), (None, d, "y"), (5, a, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id or 0), r.text) for r in got.collect()) == sorted([(1, a), (1, b), (3, c), (0, d)])
