import random
from collections import Counter

import pyarrow as pa
import pytest

from fieldloom.llm import suffix_dedup as s


def brute(docs, span):
    raw = [(i, (t or "").encode()) for i, t in docs]
    count = Counter(b[k : k + span] for _, b in raw for k in range(len(b) - span + 1))
    out = []
    for i, b in raw:
        gone = [False] * len(b)
        for k in range(len(b) - span + 1):
            if count[b[k : k + span]] > 1:
                gone[k : k + span] = [True] * span
        spans = [k for k in range(len(b) + 1) if (k < len(b) and gone[k]) != (k > 0 and gone[k - 1])]
        out.append((i, len(b), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def run(spark, docs, **options):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    return sorted(((r.doc_id, r.n_bytes, r.spans, bytes(r.kept)) for r in s.repeated(frame, **options).collect()), key=str)


def corpus(rng, span):
    words = ["".join(rng.choices("abcdéf ", k=rng.randrange(2, 9))) for _ in range(500)]
    passages = ["".join(rng.choices(words, k=span // 2)) for _ in range(6)]
    docs = []
    for i in range(80):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            p = rng.choice(passages)
            parts.append("".join(rng.choices(words, k=rng.randrange(20))) if rng.random() < 0.6 else p[rng.randrange(len(p)) :][: rng.randrange(1, 2 * span)])
        docs.append((i, "".join(parts)))
    docs += [(100, docs[3][1]), (101, docs[3][1]), (102, "x" * (3 * span)), (103, "x" * (2 * span) + "y"), (104, "xy" * 2000), (105, None), (105, None), (106, ""), (None, "short"), (None, docs[5][1] + "!"), (107, "\x00" * span), (108, "b" + "\x00" * span)]
    docs += [(i % 9 or None, docs[7][1]) for i in range(25)] + [(i, "") for i in range(9)]
    docs += [(200 + i, "".join(rng.choices(words, k=3)) + passages[0] + str(i)) for i in range(30)]
    return docs


@pytest.mark.parametrize("options", [{}, {"hot": 3}, {"limits": s.Limits(7, 40, 3, 90)}, {"copies": 1}, {"copies": 3}])
def test_random_against_brute_force(spark, options):
    docs = corpus(random.Random(8), 20)
    assert run(spark, docs, span=20, piece=4, **options) == brute(docs, 20)


def test_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = run(spark, docs)
    assert got == brute(docs, 200) and any(r[2] for r in got)


def test_family_keeps_levels_geometric():
    rng = random.Random(1)
    family, rows = s.Family(8), [(i, 0, 0, bytes(rng.choices(range(97, 100), k=12))) for i in range(400)]
    found, most = set(), 0
    for at in range(0, 400, 5):  # batches one after the other
        batch = rows[at : at + 5]
        data = s.np.frombuffer(b"".join(r[3] for r in batch), s.np.uint8)
        new = family.add(data, s.np.arange(6) * 12, s.np.array([r[:3] for r in batch]))
        found |= {(h, k) for h, _, a, b in new.tolist() for k in range(a, b + 1)}
        sizes, most = [len(x) for x in family.levels], max(most, len(family.levels))
        assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:]))
        for level in family.levels:
            own = level.strings().tolist()
            assert own == sorted(set(own))
    assert most > 3
    count = Counter(r[3][k : k + 8] for r in rows for k in range(5))
    assert found == {(r[0], k) for r in rows for k in range(5) if count[r[3][k : k + 8]] > 1}


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert s.repeated(empty).count() == 0
    docs = spark.createDataFrame([(1, None, "a"), (2, "word " * 100_000, "b"), (3, "é" * 150, "c"), (4, "é" * 150, "c")], "doc_id long, text string, kept string")
    got = {r.doc_id: (r.n_bytes, r.spans, len(r.kept)) for r in s.repeated(docs).collect()}
    assert got == {1: (0, [], 0), 2: (500_000, [0, 500_000], 0), 3: (300, [0, 300], 0), 4: (300, [0, 300], 0)}


def test_last_kind_of_a_flushed_key_is_asked():
    rows = [(5, t, t, 10, 0, 3, 1) for t in range(4)] + [(6, 1, 90, 10, 0, 3, 1)]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    for cuts in ([4], [4, 5], [2, 4], [1, 2, 3, 4]):  # the key's rows end where a batch ends
        ends = sorted({*cuts, 5})
        batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[a:b]), types)], names=list("vthnlhc")) for a, b in zip([0, *ends], ends)]
        for some in (batches, batches[:-1]):
            got = [r for b in s._resolve(iter(some), 3) for r in zip(b.column("h").to_pylist(), b.column("kind").to_pylist())]
            assert [(h, kind % s.HOTTER) for h, kind in sorted(got)] == [(t, 1) for t in range(4)], cuts


def test_many_copies_are_split_and_sent_twice(spark):
    text = "".join(random.Random(5).choices("abcdefgh ", k=900))
    docs = [(i, text) for i in range(400)] + [(1000, text[:450] + "Z" * 40 + text[450:]), (1001, "other" * 9)]
    got = run(spark, docs)
    assert got == brute(docs, 200)
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    seen: dict = {}
    batch = pa.RecordBatch.from_pylist([{"text": t, "h": hash(t), "nb": len(t)} for _, t in docs])
    assert s._first_two(batch, seen).num_rows == 4 and s._first_two(batch, seen).num_rows == 2
    rows = frame.selectExpr("doc_id as id", "text", "xxhash64(text) as h", "octet_length(text) as nb")
    many = s.hot_keys(rows.groupBy("h", "nb").agg(s.F.count("*").alias("n")), len(docs), 50)
    assert [r["__salts"] for r in many.collect()] == [8]
