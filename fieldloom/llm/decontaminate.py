"""Benchmark passages in documents, by a prefix-filtered set join.

An item's windows are its runs of SIZE consecutive words (all its words if it has fewer). A window is the set of its shingles with
their positions; to contain it a document must contain each of them, so one is enough as its prefix: the rarest, by how often the
shingles occur in all documents. Documents' shingles are joined to the prefixes; a match fixes where the window would lie, which
must be within the document (length and position bound); then its words are compared one by one.

The benchmark is taken in blocks of about BLOCK_BYTES of text, hashed by item. One block is sent to the executors and passed over the
documents, which are not shuffled. Several are sent and passed one after the other: each pass stores what it finds by a hash of the text
(md5), then its block is dropped, so memory does not grow with the benchmark; at the end the finds, which only contaminated texts have,
are joined to the documents once.

Defined cases: of a window's equally rare shingles the first is its prefix, which changes no result; texts of any length are read whole, a slice of rows at a time; null text has no words and no hits; an item without words has no windows; words of an item with a null id are hit but
the item is not listed; repeated items are listed once; repeated documents each get a row. Columns of the documents are kept unless
named like an output; other columns of the benchmark are ignored. Without documents the result is empty, without items all is clean.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, hold_only, slices, text_bytes, with_columns

SIZE, SHINGLE, BLOCK_BYTES = 13, 5, 8_000_000
#: Bytes of text that are hashed at once: each takes some 60 bytes of memory meanwhile.
SLICE = 1_000_000
#: What is kept of a byte: a-z, 0-9 and all beyond ASCII are parts of words; A-Z too, in lower case; 32 is none.
BYTES = np.array([b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)], np.uint8)
BASE = 0x9E3779B97F4A7C15 | 1
MIX = np.uint64(0xD6E8FEB86659FD93)


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    ups, downs = np.full(n, BASE, np.uint64), np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
    ups[0] = downs[0] = 1
    return np.cumprod(ups, dtype=np.uint64), np.cumprod(downs, dtype=np.uint64)


class Words:
    """The words of a column of texts: where they begin and end, their hashes, and the first word of each text."""

    def __init__(self, column: pa.Array) -> None:
        raw, ends = text_bytes(column)
        self.bytes = BYTES[raw]
        inside = self.bytes != 32
        n = len(inside)
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cut = ends[1:-1]  # a text's last word does not go on in the next text
        cut = cut[(cut > 0) & (cut < n)]
        first[cut] = inside[cut]
        last[cut - 1] = inside[cut - 1]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.start, ends)
        up, down = _powers(1 << max(16, int(n).bit_length()))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((self.bytes.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        h = (sums[self.end] - sums[self.start]) * down[self.start]
        h ^= h >> np.uint64(29)
        self.hash = h * MIX
        self.hash ^= self.hash >> np.uint64(32)

    def __len__(self) -> int:
        return len(self.start)

    def shingles(self, k: int) -> np.ndarray:
        """A hash of k words from each word on; near the end of a text it reaches into the next one, which the bounds rule out."""
        n = max(0, len(self) - k + 1)
        out = np.zeros(n, np.uint64)
        for j in range(k):
            out = out * np.uint64(BASE) + self.hash[j : j + n]
        out ^= out >> np.uint64(31)
        return out * MIX

    def text(self, start: int, size: int) -> bytes:
        return b" ".join(self.bytes[a:b].tobytes() for a, b in zip(self.start[start : start + size], self.end[start : start + size]))


class Lookup:
    """Which of many hashes are among a few."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = np.unique(hashes)
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.hashes >> np.uint64(44)).astype(np.int64)] = True

    def places(self, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in `many`, places in `hashes`)."""
        maybe = np.flatnonzero(self.bits[(many >> np.uint64(44)).astype(np.int64)])
        if not len(maybe):
            return maybe, maybe
        at = np.minimum(np.searchsorted(self.hashes, many[maybe]), len(self.hashes) - 1)
        known = self.hashes[at] == many[maybe]
        return maybe[known], at[known]


class Index:
    """The windows of a block of items. Before the shingles' counts are known it only tells which shingles there are."""

    def __init__(self, ids: list[str | None], texts: pa.Array, size: int, shingle: int) -> None:
        words, self.shingle = Words(texts), shingle
        windows: dict[bytes, int] = {}
        self.items: list[set[str]] = []
        where: list[tuple[int, int]] = []
        for i, name in enumerate(ids):
            a, b = int(words.first[i]), int(words.first[i + 1])
            w = min(size, b - a)
            for start in range(a, b - w + 1) if w else ():
                key = words.text(start, w)
                at = windows.setdefault(key, len(windows))
                if at == len(self.items):
                    self.items.append(set())
                    where.append((start, w))
                if name is not None:
                    self.items[at].add(name)
        self.texts, self.sizes = list(windows), np.array([w for _, w in where], np.int64)
        self.kinds = sorted({min(shingle, w) for _, w in where})
        self.parts: list[np.ndarray] = []  # of each window its shingles' hashes
        by_k = {k: words.shingles(k) for k in self.kinds}
        for start, w in where:
            k = min(shingle, w)
            self.parts.append(by_k[k][start : start + w - k + 1])
        self.known = {k: Lookup(np.concatenate([p for p, w in zip(self.parts, self.sizes) if min(shingle, w) == k])) for k in self.kinds}

    def choose(self, counts: dict[tuple[int, int], int]) -> None:
        """Orders each window's shingles by rarity and keeps the first as its prefix."""
        self.prefix = {}
        for k in self.kinds:
            mine = [i for i, w in enumerate(self.sizes) if min(self.shingle, w) == k]
            offset = np.array([min(range(len(self.parts[i])), key=lambda j: (counts.get((k, int(self.parts[i][j])), 0), j)) for i in mine], np.int64)
            prefix = np.array([self.parts[i][o] for i, o in zip(mine, offset)], np.uint64)
            order = np.argsort(prefix, kind="stable")
            table = Lookup(prefix)
            begins = np.searchsorted(prefix[order], table.hashes)
            self.prefix[k] = (table, np.append(begins, len(order)), np.array(mine, np.int64)[order], offset[order])
        self.parts, self.known = [], {}

    def find(self, words: Words) -> list[tuple[int, int, int]]:
        """(text, first word, window) of each occurrence."""
        found = []
        text_of = None
        for k, (table, begins, windows, offsets) in self.prefix.items():
            at, place = table.places(words.shingles(k))
            if not len(at):
                continue
            many = begins[place + 1] - begins[place]
            take = np.repeat(begins[place] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
            window, at = windows[take], np.repeat(at, many)
            text_of = np.searchsorted(words.first, at, "right") - 1
            start = at - offsets[take]
            fits = (start >= words.first[text_of]) & (start + self.sizes[window] <= words.first[text_of + 1])
            for t, s, w in zip(text_of[fits].tolist(), start[fits].tolist(), window[fits].tolist()):
                if words.text(s, int(self.sizes[w])) == self.texts[w]:
                    found.append((t, s, w))
        return found


def _blocks(items: DataFrame, item_id: str, text: str, size: int, shingle: int, block_bytes: int) -> tuple[int, Iterator[Index]]:
    """How many blocks there are, and those that have words."""
    items = items.select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t")).where("t is not null")
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = -(-total // block_bytes)

    def each() -> Iterator[Index]:
        for b in range(n):  # each block has about block_bytes of text
            got = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == b).distinct().toArrow().combine_chunks()
            if got.num_rows:
                index = Index(got.column("i").to_pylist(), got.column("t").combine_chunks() if isinstance(got.column("t"), pa.ChunkedArray) else got.column("t"), size, shingle)
                if index.texts:
                    yield index

    return n, each()


def _counts(docs: DataFrame, text: str, index: Broadcast) -> dict[tuple[int, int], int]:
    """How often each of the block's shingles occurs in all documents; as many rows as the block has shingles at most."""

    def run(batches):
        hold_only("decontaminate", _powers.cache_clear)
        known = index.value.known
        for batch in batches:
            for part in slices(batch, text, SLICE):
                words = Words(part.column(text))
                for k, table in known.items():
                    place, times = np.unique(table.places(words.shingles(k))[1], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(place), k, np.int32)), pa.array(table.hashes[place].view(np.int64)), pa.array(times.astype(np.int64))], names=["k", "h", "n"])

    rows = docs.select(text).mapInArrow(run, "k int, h long, n long").groupBy("k", "h").agg(F.sum("n").alias("n")).toArrow()
    return {(k, h & (2**64 - 1)): n for k, h, n in zip(*(rows.column(c).to_pylist() for c in "khn"))}


def find(docs: DataFrame, items: DataFrame, doc_id_text: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = SIZE, shingle: int = SHINGLE, block_bytes: int = BLOCK_BYTES, keep: list[str] | None = None) -> DataFrame:
    """Adds n_words, spans (starts and ends of maximal runs of hit words, in turn) and items (ids of items with occurring windows)."""
    text, sc = doc_id_text, docs.sparkSession.sparkContext
    fields = [("n_words", T.LongType()), ("spans", T.ArrayType(T.LongType())), ("items", T.ArrayType(T.StringType()))]
    out = docs if keep is None else docs.select(*dict.fromkeys([*keep, text]))
    out = out.drop("n_words", "spans", "items")
    holds = ("decontaminate", _powers.cache_clear)
    n, blocks = _blocks(items, item_id, item_text, size, shingle, block_bytes)
    if n <= 1:
        block = next(blocks, None)
        if block is not None:
            block.choose(_counts(docs, text, sc.broadcast(block)))
        out = with_columns(out, text, fields, _pass(block and sc.broadcast(block), text), most=SLICE, holds=holds)
    else:
        stored = None
        hashed = docs.select(F.col(text).alias("text"), F.md5(text).alias("__hash"))
        for block in blocks:
            first = sc.broadcast(block)
            block.choose(_counts(docs, text, first))
            sent = sc.broadcast(block)
            found = cut(with_columns(hashed, "text", fields, _pass(sent, "text"), ["__hash"], SLICE, holds).where(F.size("spans") > 0).groupBy("__hash").agg(F.first("spans").alias("s"), F.first("items").alias("i")))
            first.destroy()
            sent.destroy()
            stored = found if stored is None else stored.unionByName(found)
        merged = stored.groupBy("__hash").agg(F.flatten(F.collect_list("s")).alias("__s"), F.flatten(F.collect_list("i")).alias("__i")) if stored is not None else None
        if merged is None:
            out = with_columns(out, text, fields, _pass(None, text), most=SLICE, holds=holds)
        else:
            joined = out.withColumn("__hash", F.md5(text)).join(merged, "__hash", "left").drop("__hash")
            out = with_columns(joined, text, fields, _pass(None, text, ("__s", "__i")), most=SLICE, holds=holds).drop("__s", "__i")
    return out if keep is None else out.select(*keep, *(n for n, _ in fields))


def _pass(index: Broadcast | None, text: str, found: tuple[str, str] | None = None):
    """n_words, spans and items by an index, and by what is `found` in two columns: spans in any order, items."""
    def make():
        def each(part: pa.RecordBatch) -> dict[str, pa.Array]:
            words = Words(part.column(text))
            n = part.num_rows
            hit = np.zeros(len(words) + 1, np.int64)
            names: list[set[str]] = [set() for _ in range(n)]
            if index is not None:
                for t, start, window in index.value.find(words):
                    hit[start] += 1
                    hit[start + int(index.value.sizes[window])] -= 1
                    names[t] |= index.value.items[window]
            if found:
                for t, spans in enumerate(part.column(found[0]).to_pylist()):
                    for a, b in zip((spans or ())[::2], (spans or ())[1::2]):
                        hit[words.first[t] + a] += 1
                        hit[words.first[t] + b] -= 1
                for t, earlier in enumerate(part.column(found[1]).to_pylist()):
                    names[t] |= set(earlier or ())
            covered = np.cumsum(hit[:-1]) > 0
            begin = covered.copy()
            begin[1:] &= ~covered[:-1]
            begin[words.first[:-1][words.first[:-1] < len(words)]] = covered[words.first[:-1][words.first[:-1] < len(words)]]
            stop = covered.copy()
            stop[:-1] &= ~covered[1:]
            lasts = words.first[1:][words.first[1:] > 0] - 1
            stop[lasts] = covered[lasts]
            a, b = np.flatnonzero(begin), np.flatnonzero(stop) + 1
            at = np.searchsorted(words.first, a, "right") - 1
            values = np.stack([a - words.first[at], b - words.first[at]], 1).ravel() if len(a) else np.zeros(0, np.int64)
            offsets = 2 * np.concatenate([[0], np.cumsum(np.bincount(at, minlength=n))])
            return {
                "n_words": pa.array(np.diff(words.first).astype(np.int64)),
                "spans": pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values)),
                "items": pa.array([sorted(x) for x in names], pa.list_(pa.string())),
            }

        return each

    return make


def n_hit() -> Column:
    """Hit words, from `spans`."""
    return F.aggregate(F.transform("spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("long"), lambda a, x: a + x)


def contaminated(percent: int = 5) -> Column:
    return (n_hit() > 0) & (100 * n_hit() >= percent * F.col("n_words"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of `docs` of whose words less than 5 of 100 are hit, with their own columns only."""
    renamed = [(c, f"_own_{c}") for c in docs.columns if c in ("n_words", "spans", "items")]
    inner = docs
    for c, other in renamed:
        inner = inner.withColumnRenamed(c, other)
    out = find(inner, items).where(~contaminated()).drop("n_words", "spans", "items")
    for c, other in renamed:
        out = out.withColumnRenamed(other, c)
    return out.select(*docs.columns)
