"""Repeated byte strings, removed by a family of suffix arrays.

Every string of SPAN bytes that starts at two places or more is to be found. A string's key is the least hash of its K-byte pieces, so
equal strings have equal keys, and a text falls into runs of starts with the same key. Only runs whose key occurs elsewhere matter:

1. Runs are dealt by key, each with a hash of all its bytes. A run that occurs twice as a whole is repeated in every byte. Where a key
   has several different runs, one of each kind is asked for its bytes.
2. Their bytes are dealt by key (and two more such keys, which keeps groups small) to as many tasks as it takes for each to have about
   PER_TASK starts. A task takes what comes in batches, in any order. A batch gets a suffix array of its starts, by the SPAN bytes that
   follow each; neighbours with equal bytes are matches, and the array is merge-scanned against every level that the task has, for matches
   with earlier batches. Then it becomes a level itself, and levels of equal size merge, so their sizes grow geometrically. A level
   keeps the bytes of its runs once, and places in them in the order of their suffixes.
3. Each text gets its repeated starts, and loses the bytes that they cover.

The starts of keys with more than HOT different runs are dealt one by one by a 128-bit hash of their bytes instead, so that no key makes a
task larger; of those that occur twice in a slice one is sent on. A task sends a run that it has sent twice no more, it is repeated for
certain; nor does it look at a text again that it has seen twice. The rows of texts with very many copies are dealt to several tasks where
texts get their starts; those with the smallest hash of an id stay together and give the text's bytes. Texts are told apart by a 64-bit hash and their length, whole runs by their key, a 64-bit hash and their length; all
other matches compare bytes.

Defined cases: null text is empty; texts of fewer than SPAN bytes lose nothing; of equal texts of SPAN bytes or more nothing stays, in
either; texts of any length are taken whole; null ids are kept; other columns are ignored. An empty table gives an empty one.
"""

from __future__ import annotations

from collections import namedtuple
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import HOT_ROWS, cut, for_each_salt, give_back, hold_only, hot_keys, salted, slices, text_bytes, with_columns

SPAN, PIECE, HOT = 200, 32, 20_000
#: A run is cut after so many starts; a suffix array is built over about so many; that many rows of a key are held at most; a task of the
#: family gets about so many starts.
Limits = namedtuple("Limits", "longest starts held per_task")
LIMITS = Limits(512, 60_000, 200_000, 400_000)
#: Bytes of text that are hashed at once (each takes some 60 bytes of memory meanwhile); kinds of runs that a task remembers to have sent.
SLICE, REMEMBERED = 2_000_000, 400_000
WITHIN, HOTTER = 10, 10
_RNG = np.random.default_rng(11)
LETTERS = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
ODD = [np.uint64(int(x) | 1) for x in _RNG.integers(1, 2**63, 8, dtype=np.uint64)]


def piece_hashes(data: np.ndarray, piece: int) -> np.ndarray:
    """A hash of the `piece` bytes (a power of two) from each place on."""
    h, size, factor = LETTERS[data], 1, int(ODD[0])
    while size < piece:
        h = h[:-size] * np.uint64(factor) + h[size:]
        factor, size = factor * factor % 2**64, 2 * size
    return h


def mixed(h: np.ndarray, salt: int) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h *= ODD[1 + salt]
    h ^= h >> np.uint64(29)
    h *= ODD[4 + salt]
    return h ^ (h >> np.uint64(32))


def least_in_window(h: np.ndarray, window: int) -> np.ndarray:
    m, size = h, 1
    while 2 * size <= window:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    rest = window - size
    return np.minimum(m[:-rest], m[rest:]) if rest else m


def run_keys(data: np.ndarray, span: int, piece: int, salts: tuple[int, ...]) -> list[np.ndarray]:
    """Of each start the least piece hash of its string, for each salt."""
    h = piece_hashes(data, piece)
    return [least_in_window(mixed(h, s), span - piece + 1) for s in salts]


def runs_of(data: np.ndarray, starts: np.ndarray, keys: list[np.ndarray], span: int, longest: int = LIMITS.longest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first start, last start) of the runs of texts that lie one after the other."""
    size = np.diff(starts)
    long = np.flatnonzero(size >= span)
    if not len(long):
        return (np.zeros(0, np.int64),) * 3
    first, count = starts[long], size[long] - span + 1
    valid = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    change = np.zeros(len(valid), bool)
    for k in keys:
        own = k[valid]
        change[1:] |= own[1:] != own[:-1]
    begin = np.cumsum(count) - count
    change[begin] = True
    at = np.flatnonzero(change)
    # long runs are cut
    length = np.diff(np.append(at, len(valid)))
    pieces = -(-length // longest)
    at = np.repeat(at, pieces) + longest * (np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    text = long[np.searchsorted(begin, at, "right") - 1]
    low = valid[at]
    high = valid[np.append(at[1:], len(valid)) - 1]
    return text, low, high


def _first_two(batch: pa.RecordBatch, copies: dict[tuple[int, int], int]) -> pa.RecordBatch:
    """The rows of texts that `copies` has not counted twice; what it forgets is only sent again."""
    stay = np.ones(batch.num_rows, bool)
    for i, text in enumerate(zip(batch.column("h").to_pylist(), batch.column("nb").to_pylist())):
        n = copies.get(text, 0)
        stay[i] = n < 2
        copies[text] = n + 1
    if len(copies) > REMEMBERED:
        copies.clear()
    return batch if stay.all() else batch.filter(pa.array(stay))


def _find_runs(span: int, piece: int, limits: Limits):
    """Runs of each text, each kind once in a slice. c: 1 seen once, 2 seen again (the others of its kind have c = 3); WITHIN more
    if it may repeat a string within itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_only()
        once, often = np.zeros(0, np.uint64), np.zeros(0, np.uint64)  # hashes of runs that this task has sent, sorted
        copies: dict[tuple[int, int], int] = {}
        for batch in batches:
            for part in slices(_first_two(batch, copies), "text", SLICE):
                data, starts = text_bytes(part.column("text"))
                if len(data) < span:
                    continue
                pieces = mixed(piece_hashes(data, piece), 0)
                key = least_in_window(pieces, span - piece + 1)
                text, low, high = runs_of(data, starts, [key], span, limits.longest)
                if not len(text):
                    continue
                raw = data.tobytes()
                t = np.fromiter((xxhash.xxh3_64_intdigest(raw[a : b + span]) for a, b in zip(low.tolist(), high.tolist())), np.uint64, len(low))
                v, length = key[low], high - low
                order = np.lexsort((length, t, v))
                same = np.zeros(len(order), bool)
                a, b = order[1:], order[:-1]
                same[1:] = (v[a] == v[b]) & (t[a] == t[b]) & (length[a] == length[b])
                c = np.ones(len(order), np.int32)
                c[order[same]] = 3
                again = np.append(same[1:], False) & ~same
                c[order[again]] = 2
                head = ~same
                before, sure = np.isin(t, once, kind="sort"), np.isin(t, often, kind="sort")
                c[before & (c == 1)] = 2
                c[sure] = 3
                first = t[order[head]]
                kinds, now = np.unique(first, return_index=True)
                two = (again[head] | before[order[head]])[now]
                often = np.union1d(often, kinds[two])
                once = np.union1d(once, kinds[~two])
                if len(once) + len(often) > REMEMBERED:
                    once = once[: REMEMBERED // 2]
                    often = often[: REMEMBERED // 2]
                # a run in which its key's piece occurs twice may repeat a string within itself
                inner = np.fromiter((np.count_nonzero(pieces[a : b + span - piece + 1] == k) > 1 for a, b, k in zip(low.tolist(), high.tolist(), v)), bool, len(low))
                c[inner & (c < 3)] += WITHIN
                h, nb = part.column("h").to_numpy(), part.column("nb").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (v.view(np.int64), t.view(np.int64), h[text], nb[text], (low - starts[text]).astype(np.int32), (high - starts[text]).astype(np.int32), c)], names=["v", "t", "h", "nb", "lo", "hi", "c"])

    return run


def _resolve(batches: Iterator[pa.RecordBatch], most: int, hot: int = HOT) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (v, t, hi - lo). kind 0: repeated as a whole; 1: asked for its bytes; 2: both; HOTTER more if its key has more than
    `hot` different runs."""
    held: list[np.ndarray] | None = None
    flushed = None  # a key whose runs were asked without waiting for all: its last kind of run is asked too

    def out(cols: list[np.ndarray], pick: np.ndarray, kind: np.ndarray) -> pa.RecordBatch:
        v, _, h, nb, lo, hi, _ = (x[pick] for x in cols)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (h, nb, lo, hi, v, kind[pick])], names=["h", "nb", "lo", "hi", "v", "kind"])

    def work(cols: list[np.ndarray], sure: bool) -> pa.RecordBatch:
        v, t, _, _, lo, hi, c = cols
        sure = np.full(len(v), sure) if flushed is None else sure | (v == flushed)
        inner, c = c >= WITHIN, c % WITHIN
        n, length = len(v), hi - lo
        new_v, new_t = np.ones(n, bool), np.ones(n, bool)
        new_v[1:] = v[1:] != v[:-1]
        new_t[1:] = new_v[1:] | (t[1:] != t[:-1]) | (length[1:] != length[:-1])
        again = (c >= 2) | ~new_t
        again[:-1] |= ~new_t[1:]
        kinds = np.add.reduceat(new_t.astype(np.int64), np.flatnonzero(new_v))[np.cumsum(new_v) - 1]
        asked = new_t & ((kinds > 1) | inner | sure)
        hotter = HOTTER * ((kinds > hot) | sure)
        return out(cols, again | asked, np.where(asked, np.where(again, 2, 1) + hotter, 0).astype(np.int32))

    for batch in batches:
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(7)]
        done = cols[6] == 3
        if done.any():
            yield out(cols, done, np.zeros(len(done), np.int32))
            cols = [x[~done] for x in cols]
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols)]
        if not len(cols[0]):
            held = cols
            continue
        last = np.searchsorted(cols[0], cols[0][-1])
        if last:
            yield work([x[:last] for x in cols], False)
            cols = [x[last:] for x in cols]
        if len(cols[0]) > most:  # a key with very many runs: all are asked, which is never wrong; the last kind stays to be compared
            final = (cols[1] == cols[1][-1]) & (cols[5] - cols[4] == cols[5][-1] - cols[4][-1])
            if not final.all():
                yield work([x[~final] for x in cols], True)
                flushed, cols = cols[0][-1], [x[final] for x in cols]
            if len(cols[0]) > 2:  # the middle of many of one kind is repeated; the first stands for it
                cols[6] = np.where(np.arange(len(cols[6])) == 0, 2, 3).astype(np.int32)
                middle = cols[6] == 3
                yield out(cols, middle, np.zeros(len(middle), np.int32))
                cols = [x[~middle] for x in cols]
        held = cols
    if held is not None and len(held[0]):
        yield work(held, False)


GIVEN = "k1 long, k2 long, kind int, h long, nb int, lo int, bytes binary"


def _give_bytes(span: int, piece: int):
    """The bytes of the runs that were asked, cut further by two more keys (kind 0); of hot keys each start's hash (kind 1), and starts that
    are repeated for certain (kind 2)."""
    names = ["k1", "k2", "kind", "h", "nb", "lo", "bytes"]

    def batch_of(k1: np.ndarray, k2: np.ndarray, kind: int, h: np.ndarray, nb: np.ndarray, lo: np.ndarray, data: pa.Array | None = None) -> pa.RecordBatch:
        data = pa.nulls(len(h), pa.binary()) if data is None else data
        return pa.RecordBatch.from_arrays([pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), pa.array(np.full(len(h), kind, np.int32)), pa.array(h), pa.array(nb), pa.array(lo.astype(np.int32)), data], names=names)

    def cut_up(runs: list[bytes], about: np.ndarray) -> pa.RecordBatch:
        raw = b"".join(runs)
        data, ends = np.frombuffer(raw, np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in runs])])
        keys = run_keys(data, span, piece, (1, 2))
        at, low, high = runs_of(data, ends, keys, span)
        h, nb, lo, v = about[at].T
        size = high - low + span
        first = np.concatenate([[0], np.cumsum(size)])
        take = np.repeat(low - first[:-1], size) + np.arange(first[-1])
        own = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(first.astype(np.int32)), pa.py_buffer(data[take])])
        return batch_of(v.astype(np.int64).view(np.uint64), keys[0][low] * np.uint64(31) + keys[1][low], 0, h, nb.astype(np.int32), lo + low - ends[at], own)

    def hashed(runs: list[bytes], about: np.ndarray) -> Iterator[pa.RecordBatch]:
        counts = np.array([len(r) - span + 1 for r in runs])
        marks = [xxhash.xxh3_128_intdigest(r[k : k + span]) for r in runs for k in range(len(r) - span + 1)]
        high = np.fromiter((m >> 64 for m in marks), np.uint64, len(marks))
        low = np.fromiter((m & (2**64 - 1) for m in marks), np.uint64, len(marks))
        h, nb, lo, _ = np.repeat(about, counts, axis=0).T
        lo = lo + np.arange(len(marks)) - np.repeat(np.cumsum(counts) - counts, counts)
        nb = nb.astype(np.int32)
        order = np.lexsort((low, high))
        new = np.append(True, (high[order[1:]] != high[order[:-1]]) | (low[order[1:]] != low[order[:-1]]))
        several = ~new | np.append(~new[1:], False)
        one, sure = order[new], order[several]
        yield batch_of(high[one], low[one], 1, h[one], nb[one], lo[one])
        if len(sure):  # dealt by their place
            yield batch_of(h[sure].astype(np.int64).view(np.uint64), lo[sure].astype(np.uint64), 2, h[sure], nb[sure], lo[sure])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_only()
        before = None
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                cold: tuple[list, list] = ([], [])
                hot: tuple[list, list] = ([], [])
                held = 0
                for text, h, nb, asked in zip(*(part.column(c).to_pylist() for c in ("text", "h", "nb", "asked"))):
                    if (h, nb) == before:  # a copy, which is repeated as a whole
                        continue
                    before, raw = (h, nb), text.encode()
                    for one in asked:
                        runs, about = hot if one["hot"] else cold
                        runs.append(raw[one["lo"] : one["hi"] + span])
                        about.append((h, nb, one["lo"], one["v"]))
                        held += len(runs[-1])
                        if held > SLICE:
                            if cold[0]:
                                yield cut_up(cold[0], np.array(cold[1], np.int64))
                            if hot[0]:
                                yield from hashed(hot[0], np.array(hot[1], np.int64))
                            cold, hot, held = ([], []), ([], []), 0
                if cold[0]:
                    yield cut_up(cold[0], np.array(cold[1], np.int64))
                if hot[0]:
                    yield from hashed(hot[0], np.array(hot[1], np.int64))
        give_back()

    return run


class Level:
    """A suffix array: `data` has the bytes of runs one after the other, `at` where suffixes begin in it, in the order of their first SPAN
    bytes, each string once; `place` is one place (h, nb, start) of each, `found` whether it is known to be repeated."""

    def __init__(self, data: np.ndarray, at: np.ndarray, place: np.ndarray, found: np.ndarray, span: int) -> None:
        self.data, self.at, self.place, self.found, self.span = data, at, place, found, span

    def __len__(self) -> int:
        return len(self.at)

    def strings(self) -> np.ndarray:
        return strings_at(self.data, self.at, self.span)

    def merged(self, other: Level) -> Level:
        """Both as one; a string is in one of them only, because matches are not kept twice."""
        both = np.concatenate([self.strings(), other.strings()])
        order = np.argsort(both, kind="stable")  # two sorted runs, which timsort merges
        at = np.concatenate([self.at, other.at + len(self.data)])
        return Level(np.concatenate([self.data, other.data]), at[order], np.concatenate([self.place, other.place])[order], np.concatenate([self.found, other.found])[order], self.span)


def strings_at(data: np.ndarray, at: np.ndarray, span: int) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(data, span)[at].view(f"S{span}").ravel()


class Family:
    """Levels of sizes that grow geometrically."""

    def __init__(self, span: int) -> None:
        self.span, self.levels = span, []

    def add(self, data: np.ndarray, ends: np.ndarray, about: np.ndarray) -> np.ndarray:
        """Runs that lie one after the other in `data`, run i from ends[i] to ends[i + 1], of about[i] = (h, nb, lo). Returns rows (h, nb,
        first, last start) of starts that are found to be repeated now."""
        span, out = self.span, []
        count = np.diff(ends) - span + 1
        row = np.repeat(np.arange(len(count)), count)
        within = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        at = ends[row] + within
        place = about[row]
        place[:, 2] += within
        strings = strings_at(data, at, span)
        order = np.argsort(strings, kind="stable")
        ordered = strings[order]
        same = ordered[1:] == ordered[:-1]
        head = np.append(True, ~same)
        found = np.zeros(len(order), bool)
        found[1:] |= same
        found[:-1] |= same
        distinct = np.flatnonzero(head)
        names, seen, there = ordered[distinct], found[distinct], np.zeros(len(distinct), bool)
        del strings, ordered
        for level in self.levels:  # merge-scan
            own = level.strings()
            near = np.minimum(np.searchsorted(own, names), len(level) - 1)
            hit = own[near] == names
            seen |= hit
            there |= hit
            fresh = np.unique(near[hit & ~level.found[near]])
            out.append(level.place[fresh][:, [0, 1, 2, 2]])
            level.found[fresh] = True
        marked = np.zeros(len(order), bool)
        marked[order] = seen[np.cumsum(head) - 1]
        begin, stop = marked.copy(), marked.copy()
        begin[1:] &= ~(marked[:-1] & (row[1:] == row[:-1]))
        stop[:-1] &= ~(marked[1:] & (row[1:] == row[:-1]))
        out.append(np.column_stack([place[begin], place[stop][:, 2]]))
        new = order[distinct[~there]]
        if len(new):
            self.levels.append(Level(data, at[new], place[new], seen[~there], span))
        while len(self.levels) > 1 and len(self.levels[-2]) < 2 * len(self.levels[-1]):
            last = self.levels.pop()
            self.levels[-1] = self.levels[-1].merged(last)
        return np.concatenate(out)


FOUND = "h long, nb int, lo int, hi int"


def _match(span: int, limits: Limits):
    def rows(found: np.ndarray) -> pa.RecordBatch:
        h, nb, lo, hi = found.T
        return pa.RecordBatch.from_arrays([pa.array(h), *(pa.array(x.astype(np.int32)) for x in (nb, lo, hi))], names=["h", "nb", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_only()
        family, hashes = Family(span), {}
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            about = np.column_stack([batch.column(c).to_numpy().astype(np.int64) for c in ("h", "nb", "lo")])
            sure = about[kind == 2]
            if len(sure):
                yield rows(sure[:, [0, 1, 2, 2]])
            one, out = np.flatnonzero(kind == 1), []
            for k1, k2, i in zip(batch.column("k1").to_numpy()[one].tolist(), batch.column("k2").to_numpy()[one].tolist(), one.tolist()):
                earlier = hashes.setdefault((k1, k2), i := (*about[i].tolist(), 0))
                if earlier is not i:
                    if not earlier[3]:
                        out.append(earlier[:3])
                        hashes[k1, k2] = (*earlier[:3], 1)
                    out.append(i[:3])
            if out:
                yield rows(np.array(out, np.int64)[:, [0, 1, 2, 2]])
            cold = np.flatnonzero(kind == 0)
            runs = batch.column("bytes").take(pa.array(cold))
            about, size = about[cold], pc.binary_length(runs).to_numpy(zero_copy_only=False).astype(np.int64)
            done = np.cumsum(size - span + 1)
            a = 0
            while a < len(cold):
                b = max(a + 1, int(np.searchsorted(done, (done[a - 1] if a else 0) + limits.starts, "right")))
                data = np.frombuffer(b"".join(runs.slice(a, b - a).to_pylist()), np.uint8)
                found = family.add(data, np.concatenate([[0], np.cumsum(size[a:b])]), about[a:b])
                if len(found):
                    yield rows(found)
                a = b
        del family, hashes
        give_back()

    return run


def repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN, piece: int = PIECE, hot: int = HOT, limits: Limits = LIMITS, copies: int = HOT_ROWS) -> DataFrame:
    """doc_id, n_bytes, spans (starts and ends of maximal removed runs of bytes, in turn) and kept (the other bytes) for each row."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("id"), body.alias("text"), F.xxhash64(body).alias("h"), F.octet_length(body).alias("nb"))
    many = hot_keys(rows.groupBy("h", "nb").agg(F.count("*").alias("n"), F.min(F.xxhash64("id")).alias("first")), docs.count(), copies)
    # one projection for both joins below, so that its shuffle is done once
    salt = F.when(F.xxhash64("id") != F.col("first"), F.lit(1) + F.pmod(F.xxhash64("id", F.spark_partition_id()), "__salts").cast("int"))
    source = salted(rows, many, ["h", "nb"], salt)
    runs = rows.mapInArrow(_find_runs(span, piece, limits), "v long, t long, h long, nb int, lo int, hi int, c int")
    dealt = runs.withColumn("deal", F.when(F.col("c") == 3, F.xxhash64("h", "lo")).otherwise(F.col("v"))).repartition("deal").drop("deal")
    known = cut(dealt.withColumn("len", F.col("hi") - F.col("lo")).sortWithinPartitions("v", "t", "len").drop("len").mapInArrow(lambda batches: _resolve(batches, limits.held, hot), "h long, nb int, lo int, hi int, v long, kind int"))
    asked = known.where("kind > 0").select("h", "nb", "lo", "hi", "v", (F.col("kind") >= HOTTER).alias("hot"))
    total = asked.agg(F.sum(F.col("hi") - F.col("lo") + 1)).first()[0] or 0
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // limits.per_task))
    by_text = asked.groupBy("h", "nb").agg(F.collect_set(F.struct("lo", "hi", "v", "hot")).alias("asked"), F.min(F.lit(0)).alias("__salt"))
    given = source.join(by_text, ["h", "nb", "__salt"]).select("id", "text", "h", "nb", "asked").mapInArrow(_give_bytes(span, piece), GIVEN)
    matched = given.repartition(tasks, "k1", "k2").mapInArrow(_match(span, limits), FOUND)
    starts = known.where(F.col("kind") % HOTTER != 1).select("h", "nb", "lo", "hi").unionByName(matched)
    per_text = starts.groupBy("h", "nb").agg(F.collect_set(F.struct("lo", "hi")).alias("starts"))
    joined = source.join(for_each_salt(per_text, many, ["h", "nb"], 1), ["h", "nb", "__salt"], "left").select("id", "text", "starts")
    fields = [("n_bytes", T.LongType()), ("spans", T.ArrayType(T.LongType())), ("kept", T.BinaryType())]
    return with_columns(joined, "text", fields, lambda: lambda part: _removed(part, span), ["id", "starts"]).select(F.col("id").alias(doc_id), "n_bytes", "spans", "kept")


def _removed(part: pa.RecordBatch, span: int) -> dict[str, pa.Array]:
    sizes, spans, kept = [], [], []
    for text, starts in zip(part.column("text").to_pylist(), part.column("starts").to_pylist()):
        raw = text.encode()
        runs: list[int] = []
        for lo, hi in sorted((s["lo"], s["hi"] + span) for s in starts or ()):
            if runs and lo <= runs[-1]:
                runs[-1] = max(runs[-1], hi)
            else:
                runs += [lo, hi]
        edges = [0, *runs, len(raw)]
        sizes.append(len(raw))
        spans.append(runs)
        kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
    return {"n_bytes": pa.array(sizes, pa.int64()), "spans": pa.array(spans, pa.list_(pa.int64())), "kept": pa.array(kept, pa.binary())}
