import math
import zlib
from collections import Counter, defaultdict
from hashlib import md5

import pytest

from fieldloom.llm import shard


def brute(key, n, base=None):
    node = shard.tree(n, base=base)
    while node.children:
        draw = lambda c: -math.log((int(md5(f"{key}|{c.name}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52) / c.weight
        node = min(node.children, key=draw)
    return node.shard


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(7)
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = shard.assign(docs).collect()
    slots = defaultdict(list)
    for r in got:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 8, zlib.crc32(raw), "key")
        assert r.shard == brute(r.doc_id, 24) and r.grown_shard == brute(r.doc_id, 25) and r.grown_shard in (r.shard, 24)
        slots[r.shard].append((r.doc_id, r.slot))
    assert len(got) == len(texts) and set(slots) == set(range(24))
    assert all([s for _, s in sorted(x)] == list(range(len(x))) for x in slots.values())
    assert 10 < sum(r.grown_shard == 24 for r in got) < 90 and max(Counter(r.shard for r in got).values()) < 90


def test_weights_and_movement(spark):
    keys = spark.range(4000)
    before, after = shard.tree(8, 1, 2), shard.tree(8, 1, 2, {5: 3.0})
    rows = keys.select(shard.place(keys.id, before).alias("a"), shard.place(keys.id, after).alias("b")).collect()
    moved = [(r.a, r.b) for r in rows if r.a != r.b]
    assert moved and all(b in (4, 5) for _, b in moved)  # only into the region whose weight grew
    share = Counter(r.b for r in rows)
    assert abs(share[5] / sum(share.values()) - 0.3) < 0.04


def test_law_key_for_every_number_of_shards(spark):
    keys = spark.range(600)
    for base in (1, 7, 8, 24):
        for n in range(base, 41):
            rows = keys.select(shard.place(keys.id, shard.tree(n, base=base)).alias("a"), shard.place(keys.id, shard.tree(n + 1, base=base)).alias("b")).distinct().collect() if n % 5 == base % 5 else ()
            assert all(r.b in (r.a, n) for r in rows)
    with pytest.raises(ValueError, match="base"):
        shard.assign(spark.createDataFrame([(1, "a")], "doc_id long, text string"), 20)
    few = shard.assign(keys.selectExpr("id as doc_id", "'x' as text"), 20, base=16).collect()
    assert all(r.shard == brute(r.doc_id, 20, 16) and r.grown_shard in (r.shard, 20) for r in few)


def test_edges(spark):
    rows = [(1, None, 5), (1, None, 5), (2, "", 6), (None, "é" * 100_000, 7), (None, "é" * 100_000, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    got = shard.assign(docs).collect()
    assert sorted((r.doc_id or 0, r.size, r.text_crc32) for r in got)[2:] == [(1, 8, 0), (1, 8, 0), (2, 8, 0)]
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in by.values())
    assert shard.assign(docs.limit(0)).count() == 0
