import math

import numpy as np
import pytest

from fieldloom.llm import topk


def brute(rows, k, is_query):
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    asked = {}
    for i, v in good:
        if is_query(i):
            asked[i] = min(asked.get(i, v), v)
    out = []
    for i, v in asked.items():
        best = sorted(((-dot(v, w), j) for j, w in good if j != i))[:k]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"block": 3, "queries": 7, "pilot": 5, "rows": 50}])
def test_random_against_brute_force(spark, options):
    rng = np.random.default_rng(2)
    rows = [(int(i), (rng.normal(size=16) * rng.choice([0.1, 1.0])).astype(np.float32).tolist()) for i in range(300)]
    rows += [(400 + i, rows[5][1]) for i in range(30)] + [(0, rows[7][1]), (500, rows[8][1][:4]), (501, []), (20, None), (502, [1.0, None]), (503, [float("nan")]), (504, [float("inf")]), (None, [1.0])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, rank string").repartition(3)
    got = sorted(tuple(r) for r in topk.top_k(frame, topk.F.col("vec_id") % 20 == 0, k=7, **options).collect())
    assert got == brute(rows, 7, lambda i: i % 20 == 0)


def test_edges(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(empty, topk.F.lit(True)).count() == 0
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [2.0])], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in topk.top_k(few, topk.F.col("vec_id") == 0).collect()]
    assert sorted(got) == [(0, 1, 1, 64 * 128), (0, 2, 2, 64 * 128)]


def test_documents(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    got = sorted(tuple(r) for r in topk.top_k(frame, topk.F.col("vec_id") % 20 == 0).collect())
    assert got == brute(rows, 20, lambda i: i % 20 == 0)
