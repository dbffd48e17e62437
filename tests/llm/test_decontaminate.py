import random
import re

import pytest

from fieldloom.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 12)) if w else ():
            windows.setdefault(tuple(w[k : k + 13]), set()).add(i)
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for size in {len(x) for x in windows}:
            for a in range(len(w) - size + 1):
                if (got := windows.get(tuple(w[a : a + size]))) is not None:
                    hit |= set(range(a, a + size))
                    found |= {str(x) for x in got if x is not None}
        out.append((i, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def run(docs, items, **options):
    got = d.find(docs, items, keep=["doc_id"], **options)
    return [(r[0], r[1], r[2], r[3], r[4]) for r in got.select("doc_id", "n_words", d.n_hit().alias("n"), d.F.array_sort("items").alias("i"), d.contaminated()).collect()]


@pytest.mark.parametrize("block", [8_000_000, 300])
def test_random_against_brute_force(spark, block):
    rng = random.Random(3)
    letters = ["a", "B", "été", "9", "中", "the"]
    items = [(i, " ".join(rng.choices(letters, k=rng.choice([0, 1, 2, 4, 6, 13, 14, 30])))) for i in range(20)] + [(3, "a a"), (None, "the the the zz"), (77, None), (78, "zz q")]
    docs = [(i, rng.choice([" ", ", ", "-\n"]).join(rng.choices(letters, k=rng.randrange(60))) + (rng.choice(items)[1] or "")) for i in range(60)]
    docs += [(100, None), (101, ""), (101, "..."), (102, "x " + items[7][1]), (None, "The the THE zz")]
    got = run(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), block_bytes=block)
    key = lambda r: (str(r[0]), r[1:3], str(r))
    assert sorted(got, key=key) == sorted(brute(docs, items), key=key)


def test_documents(spark):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet") for n in ("documents", "benchmark"))
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.collect()])
    assert sorted(run(docs, items)) == sorted(want) and any(r[4] for r in want)
    assert {r.doc_id for r in d.drop_contaminated(docs, items).collect()} == {r[0] for r in want if not r[4]}


def test_edges(spark):
    docs = spark.createDataFrame([(1, "one two three", [1])], "doc_id long, text string, spans array<int>")
    none = spark.createDataFrame([], "item_id long, text string, spans int")
    assert run(docs, none) == [(1, 3, 0, [], False)]
    assert d.drop_contaminated(docs, none).collect() == docs.collect()
    assert d.find(docs.limit(0), none).count() == 0
    long = spark.createDataFrame([(1, "lorem " * 300_000 + "ipsum")], "doc_id long, text string")
    assert run(long, spark.createDataFrame([(5, "lorem ipsum")], "item_id long, text string")) == [(1, 300_001, 2, ["5"], False)]


def test_many_blocks_do_not_pile_up(spark):
    docs = spark.createDataFrame([(i, f"alpha beta {i} gamma {i % 7} delta") for i in range(40)], "doc_id long, text string")
    items = spark.createDataFrame([(i, f"beta {i} gamma") for i in range(30)], "item_id long, text string")
    found = d.find(docs, items, keep=["doc_id"], block_bytes=40)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Broadcast" not in plan.replace("BroadcastHashJoin", "").replace("BroadcastExchange", "")
    assert {r.doc_id for r in found.where("size(items) = 1").collect()} == set(range(30)) and found.count() == 40
