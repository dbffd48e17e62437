"""SimHash fingerprints and their links, found by pigeonring filtering.

A fingerprint of 64 bits is cut into M segments on a ring. If two differ in at most D bits, some segment starts a chain in which
every l segments in a row differ in at most l * D / M bits together. With M = 5 and D = 2 the budgets are 0, 0, 1, 1, 2, so two
segments in a row are equal: they are the join key, and the rest of the chain is tested before the full distance.

Rows in a defined way: null text is the empty text; texts of any length are hashed whole, BLOCK shingles at a time; a bit that is set in
exactly half of the hashes is 0; a text without words has fingerprint 0 and links like any other; repeated
rows share their fingerprint and component; null doc_ids take part but name no component unless no other id is reachable (then
the component is null). Other columns of the input are ignored. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, hold_only, with_columns

BITS, SEGMENTS, MOST, SEED = 64, 5, 2, 42
#: A bucket of more distinct fingerprints is linked by masked keys, whose groups have at most 4 members, over all tasks.
LARGE = 4096
#: Shingles whose bits are counted at once.
BLOCK = 1 << 16


def segments(m: int = SEGMENTS) -> list[tuple[int, int]]:
    """(first bit, width) of each segment; bits count from the low end."""
    edges = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def budgets(m: int = SEGMENTS, d: int = MOST) -> list[int]:
    return [length * d // m for length in range(1, m + 1)]


def fingerprint(text: str | None, size: int = 3) -> int:
    """The fingerprint of one text: bit set if it is set in over half of the shingles' hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[i:] for i in range(size)))) if len(words) >= size else [b" ".join(words)]
    n = max(1, len(words) - size + 1)
    hashes = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), dtype="<u8", count=n)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, n, BLOCK):
        part = hashes[i : i + BLOCK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None, out: str = "fp") -> DataFrame:
    def make():
        def each(part: pa.RecordBatch) -> dict[str, pa.Array]:
            prints = [fingerprint(t) for t in part.column(text).to_pylist()]
            return {out: pa.array(np.array(prints, np.uint64).view(np.int64))}

        return each

    return with_columns(docs, text, [(out, T.LongType())], make, keep)


def ring_keys(fp: Column, m: int = SEGMENTS, d: int = MOST) -> Column:
    """For each start on the ring: the segments that must be equal, as (start, key)."""
    parts, zero = segments(m), sum(b == 0 for b in budgets(m, d))
    keys = []
    for start in range(m):
        mask = 0
        for j in range(zero):
            first, width = parts[(start + j) % m]
            mask |= ((1 << width) - 1) << first
        mask -= (1 << 64) if mask >> 63 else 0
        keys.append(F.struct(F.lit(start).alias("start"), fp.bitwiseAND(F.lit(mask)).alias("key")))
    return F.array(*keys)


def roots_of(n: int, left: np.ndarray, right: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Joins the trees of each pair; returns the pairs that joined two trees."""
    used = []
    while len(left):
        a, b = root[left], root[right]
        apart = a != b
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        if not len(left):
            break
        low, high = np.minimum(a, b), np.maximum(a, b)
        order = np.lexsort((low, high))
        first = np.ones(len(order), bool)
        first[1:] = high[order][1:] != high[order][:-1]
        pick = order[first]  # each tree is hung below a smaller one, once in each round
        root[high[pick]] = low[pick]
        used.append(np.stack([left[pick], right[pick]]))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up
    return np.concatenate(used, axis=1) if used else np.zeros((2, 0), np.int64)


def bucket_links(start: np.ndarray, key: np.ndarray, fp: np.ndarray, m: int, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that keep each bucket's groups connected. Rows are sorted by bucket; each bucket is whole."""
    n, parts, allowed = len(fp), segments(m), budgets(m, d)
    zero = sum(b == 0 for b in allowed)
    masks = np.zeros((m, m), np.uint64)  # of the chain's segments so far, by start
    for s in range(m):
        mask = 0
        for j in range(m):
            first, width = parts[(s + j) % m]
            mask |= ((1 << width) - 1) << first
            masks[s, j] = mask
    same = np.ones(n, bool)
    same[1:] = (key[1:] != key[:-1]) | (start[1:] != start[:-1])
    bucket = np.cumsum(same)
    root, found = np.arange(n), []
    at = np.arange(n)
    for step in range(1, n):
        at = at[: np.searchsorted(at, n - step)]
        at = at[bucket[at] == bucket[at + step]]
        if not len(at):
            break
        pairs, diff = at, fp[at] ^ fp[at + step]
        for j in range(zero, m):  # the chain's budgets; the last one is the whole distance
            near = np.bitwise_count(diff & masks[start[pairs], j]) <= allowed[j]
            pairs, diff = pairs[near], diff[near]
        if len(pairs):
            found.append(roots_of(n, pairs, pairs + step, root))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = np.concatenate(found, axis=1)
    return pairs[0], pairs[1]


def link_buckets(large: int, m: int, d: int):
    """Reads rows sorted by bucket; gives links (kind 0) and the members of buckets that are too large for one task (kind 1)."""

    def out(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["kind", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_only()
        start, key, fp = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        over = None  # the bucket that is passed on

        def work(start, key, fp):
            edge = np.flatnonzero((key[1:] != key[:-1]) | (start[1:] != start[:-1])) + 1
            size = np.diff(np.concatenate([[0], edge, [len(fp)]]))
            each = np.repeat(size, size)
            for pick in (each > large, (each > 1) & (each <= large)):
                s, k, f = start[pick], key[pick], fp[pick]
                if len(f) and each[pick][0] > large:
                    yield out(1, f, s.astype(np.uint64))
                elif len(f):
                    a, b = bucket_links(s, k, f, m, d)
                    yield out(0, f[a], f[b])

        for batch in batches:
            s, k, f = (batch.column(i).to_numpy(zero_copy_only=False).astype(t) for i, t in enumerate((np.int64, np.int64, np.int64)))
            start, key, fp = np.concatenate([start, s]), np.concatenate([key, k]), np.concatenate([fp, f.view(np.uint64)])
            if over is not None:
                mine = (start == over[0]) & (key == over[1])
                if mine.any():
                    yield out(1, fp[mine], start[mine].astype(np.uint64))
                    start, key, fp = start[~mine], key[~mine], fp[~mine]
            if not len(fp):
                continue
            last = int(np.flatnonzero((key != key[-1]) | (start != start[-1]))[-1] + 1) if (key[0], start[0]) != (key[-1], start[-1]) else 0
            yield from work(start[:last], key[:last], fp[:last])
            start, key, fp = start[last:], key[last:], fp[last:]
            if len(fp) > large:
                over = (start[0], key[0])
                yield out(1, fp, start.astype(np.uint64))
                start, key, fp = start[:0], key[:0], fp[:0]
        if len(fp):
            yield from work(start, key, fp)

    return run


def masked_links(members: DataFrame, m: int = SEGMENTS, d: int = MOST) -> DataFrame:
    """Exact links within the buckets of (fp, start), linear in their size: two members that the chain allows are equal once one
    bit of the chain's later segments and one of the last, or two of the last, are masked. Such a group has at most 4 members."""
    if (m, d) != (5, 2):
        raise ValueError("the masks are written for 5 segments and 2 bits")
    parts = segments(m)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, start = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for s in range(m):
                own = fp[start == s].view(np.uint64)
                if not len(own):
                    continue
                bits = [[parts[(s + j) % m][0] + b for b in range(parts[(s + j) % m][1])] for j in range(m)]
                last = bits[4]
                pairs = [(x, y) for i, x in enumerate(last) for y in last[:i]] + [(x, y) for x in bits[2] + bits[3] for y in last]
                for x, y in pairs:
                    masked = own & np.uint64(~((1 << x) | (1 << y)) & (2**64 - 1))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), (s * 64 + x) * 64 + y, np.int32)), pa.array(masked.view(np.int64)), pa.array(own.view(np.int64))], names=["mask", "key", "fp"])

    groups = members.mapInArrow(run, "mask int, key long, fp long").groupBy("mask", "key").agg(F.collect_set("fp").alias("all")).where(F.size("all") > 1)
    return groups.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).where("a != b").distinct()


def links(prints: DataFrame, fp: str = "fp", m: int = SEGMENTS, d: int = MOST, large: int = LARGE) -> DataFrame:
    """Links (a, b) between distinct fingerprints at `d` or fewer bits, enough to keep connected what is connected."""
    distinct = prints.select(F.col(fp).alias("fp")).distinct()
    keys = distinct.select("fp", F.explode(ring_keys(F.col("fp"), m, d)).alias("k")).select("k.start", "k.key", "fp")
    dealt = keys.repartition("start", "key").sortWithinPartitions("start", "key", "fp")
    found = cut(dealt.mapInArrow(link_buckets(large, m, d), "kind int, a long, b long"))
    near, members = found.where("kind = 0").select("a", "b"), found.where("kind = 1").selectExpr("a as fp", "b as start")
    return near.unionByName(masked_links(members, m, d)) if not members.isEmpty() else near


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the edges (a, b): root is the smallest node that is reachable. Large and small stars in turn."""
    edges = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.selectExpr("v as u", "u as v"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").selectExpr("v as u", "m as v").where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u != v").distinct()
        edges = cut(small)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.bit_xor(F.xxhash64("v", "u"))).first())
        if now == before:
            return edges.selectExpr("u as node", "v as root")
        before = now


def classes(prints: DataFrame, doc_id: str = "doc_id", fp: str = "fp", m: int = SEGMENTS, d: int = MOST, large: int = LARGE) -> DataFrame:
    """(fp, component_id, root) for each distinct fingerprint of `prints`; root is the component's smallest fingerprint."""
    nodes = prints.groupBy(fp).agg(F.min(doc_id).alias("least"))
    joined = nodes.join(components(links(prints, fp, m, d, large)), nodes[fp] == F.col("node"), "left").select(nodes[fp], "least", F.coalesce("root", nodes[fp]).alias("root"))
    lowest = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    return joined.join(lowest, "root").select(fp, "component_id", "root")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", m: int = SEGMENTS, d: int = MOST, large: int = LARGE) -> DataFrame:
    """One row for each row of `docs`: doc_id, fp (the fingerprint as a long), component_id (smallest doc_id that links reach)."""
    prints = cut(with_fingerprints(docs, text, [doc_id]).select(F.col(doc_id), "fp"))
    return prints.join(classes(prints, doc_id, "fp", m, d, large), "fp").select(doc_id, "fp", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` without near duplicates: of each component one row, that of the smallest doc_id (rows without one come last),
    then of the smallest fingerprint."""
    prints = cut(with_fingerprints(docs, text, [doc_id]).select(F.col(doc_id).alias("__id"), "fp"))
    found = prints.join(classes(prints, "__id", "fp"), "fp")
    best = found.groupBy("root").agg(F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", "fp")).alias("w"))
    stay = cut(best.select(F.col("w.__id").alias("__stay"), F.col("w.fp").alias("__fp")))
    repeated = cut(prints.where("__id is not null").groupBy("__id").agg(F.count("*").alias("n")).where("n > 1").select("__id"))
    several, some_null = not repeated.isEmpty(), not prints.where("__id is null").isEmpty()
    single = stay.join(repeated, F.col("__stay") == F.col("__id"), "left_anti") if several else stay
    kept = docs.join(single, docs[doc_id] == F.col("__stay"), "left_semi")
    # only rows whose doc_id does not name them are told apart by their fingerprints too
    unnamed = [docs.join(repeated, docs[doc_id] == F.col("__id"), "left_semi")] if several else []
    unnamed += [docs.where(F.col(doc_id).isNull())] if some_null else []
    for rows in unnamed:
        told = with_fingerprints(rows, text, out="__print")
        same = (told["__print"] == stay["__fp"]) & told[doc_id].eqNullSafe(stay["__stay"])
        kept = kept.unionByName(told.join(stay, same, "left_semi").dropDuplicates([doc_id, "__print"]).drop("__print"))
    return kept
