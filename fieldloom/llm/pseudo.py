"""Masked pseudo-likelihood of documents under a bidirectional window network.

Each token is predicted from the tokens around it, SIDE on the left and SIDE on the right, never from itself: their vectors, one table
for each place, are added, go through tanh, and a softmax of two levels (class, word within its class) gives the probability. A
document's score is the sum over its tokens of the logarithm of that probability. The network knows the most frequent words; each
other word is its bucket (by length and last letter) to it, and `word_score` multiplies the bucket's probability by the word's own
within its bucket, from the counts of all words of the corpus. That table grows with the corpus and is only joined, in the cluster.

All documents take part: their words are counted for the vocabulary (of equally frequent words the smaller comes first; other words
share buckets) and every token is trained on once. Texts, as tokens, are dealt by a hash of id and text to parts of about PART tokens, in
the order of that hash, so parts are the same on every run, however the rows lie and whichever executors are lost. A task trains a copy
in numpy on each of its parts, from the counts' unigram model on, in steps of BATCH tokens. The copies are averaged, weighted by their
tokens, by blocks of parameters and in levels of FAN, each in the order of the parts. Only the network's words, the totals of the buckets
and the averaged network, all of a fixed size, reach the driver.

Defined cases: null or empty text has no tokens and score 0 (mean null); texts of any length are scored and trained on whole; repeated
rows get the same score and count as often in training; other columns are ignored. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import coded_word_array, cut, give_back, hold_only, slices, with_columns

SIDE, WIDTH, CLASSES, MEMBERS, BATCH, RATE, BLOCKS = 2, 12, 32, 32, 8192, 0.08, 16
#: Tokens of a part that one copy is trained on, about; copies that are averaged at once; tokens that are laid out at once.
PART, FAN, LAID = 2_000_000, 64, 16 * BATCH
#: The last class holds the buckets of words outside the vocabulary.
SIZE, KNOWN = CLASSES * MEMBERS, (CLASSES - 1) * MEMBERS
TRIM = "".join(chr(i) for i in range(33, 127) if not chr(i).isalnum())


def _normal(words: pa.Array) -> pa.Array:
    return pc.utf8_trim(pc.utf8_lower(words), characters=TRIM)


def _buckets(normal: pa.Array) -> np.ndarray:
    """The bucket of each word, by its length in bytes and its last byte."""
    offsets = np.frombuffer(normal.buffers()[1], np.int32, len(normal) + 1) if len(normal) else np.zeros(1, np.int32)
    data = np.frombuffer(normal.buffers()[2], np.uint8) if len(normal) and normal.buffers()[2] is not None and normal.buffers()[2].size else np.zeros(1, np.uint8)
    size = np.diff(offsets)
    last = np.where(size > 0, data[np.maximum(offsets[1:] - 1, 0)], 0).astype(np.int64)
    return (last * 7 + size) % MEMBERS


def _coded(column: pa.Array, vocabulary: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct words, their tokens, code of each word of the texts, first word of each text)."""
    words, codes, starts = coded_word_array(column)
    normal = _normal(words)
    known = pc.fill_null(pc.index_in(normal, vocabulary), -1).to_numpy(zero_copy_only=False)
    return normal, np.where(known >= 0, known, KNOWN + _buckets(normal)).astype(np.int32), codes, starts


def _tokens(column: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(token of each word, first word of each text)."""
    _, ids, codes, starts = _coded(column, vocabulary)
    return (ids[codes] if len(codes) else np.zeros(0, np.int32)), starts


def contexts(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Rows of the tokens around each one; beyond the ends of its text SIZE stands for nothing."""
    n, places = len(x), [o for o in range(-SIDE, SIDE + 1) if o]
    out = np.full((len(places), n), SIZE, np.int32)
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    for row, o in zip(out, places):
        if o < 0 and n > -o:
            row[-o:] = np.where(text[-o:] == text[:o], x[:o], SIZE)
        elif o > 0 and n > o:
            row[:-o] = np.where(text[:-o] == text[o:], x[o:], SIZE)
    return out


class Network:
    NAMES = ("around", "middle", "classes", "class_bias", "words", "word_bias")

    def __init__(self, counts: np.ndarray | None = None) -> None:
        rng = np.random.default_rng(7)
        self.around = rng.normal(0, 0.1, (2 * SIDE, SIZE + 1, WIDTH)).astype(np.float32)
        self.middle = np.zeros(WIDTH, np.float32)
        self.classes = rng.normal(0, 0.1, (WIDTH, CLASSES)).astype(np.float32)
        self.words = rng.normal(0, 0.1, (CLASSES, WIDTH, MEMBERS)).astype(np.float32)
        counts = np.ones(SIZE) if counts is None else counts + 1.0
        table = counts.reshape(CLASSES, MEMBERS)
        self.class_bias = np.log(table.sum(axis=1) / table.sum()).astype(np.float32)
        self.word_bias = np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def load(self, flat: np.ndarray) -> Network:
        at = 0
        for n in self.NAMES:
            old = getattr(self, n)
            setattr(self, n, flat[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        return self

    def hidden(self, around: np.ndarray) -> np.ndarray:
        h = self.middle + self.around[0].take(around[0], axis=0)
        for table, ids in zip(self.around[1:], around[1:]):
            h += table.take(ids, axis=0)
        return np.tanh(h, out=h)

    def step(self, x: np.ndarray, around: np.ndarray, slopes: dict[str, np.ndarray] | None = None) -> np.ndarray:
        """Logarithm of each token's probability; with `slopes`, also adds up the loss's derivatives."""
        n, h = len(x), self.hidden(around)
        cls, word = x // MEMBERS, x % MEMBERS
        z = h @ self.classes + self.class_bias
        z -= z.max(axis=1, keepdims=True)
        own = z[np.arange(n), cls]
        np.exp(z, out=z)
        total = z.sum(axis=1)
        out = own - np.log(total)
        if slopes is not None:
            z /= total[:, None]
            z[np.arange(n), cls] -= 1
            slopes["classes"] += h.T @ z
            slopes["class_bias"] += z.sum(axis=0)
            down = z @ self.classes.T
        order = np.argsort(cls.astype(np.uint8), kind="stable")
        ends = np.searchsorted(cls[order], np.arange(CLASSES + 1))
        for c in range(CLASSES):
            at = order[ends[c] : ends[c + 1]]
            if not len(at):
                continue
            hc, w, rows = h[at], word[at], np.arange(len(at))
            z = hc @ self.words[c] + self.word_bias[c]
            z -= z.max(axis=1, keepdims=True)
            own = z[rows, w]
            np.exp(z, out=z)
            total = z.sum(axis=1)
            out[at] += own - np.log(total)
            if slopes is not None:
                z /= total[:, None]
                z[rows, w] -= 1
                slopes["words"][c] += hc.T @ z
                slopes["word_bias"][c] += z.sum(axis=0)
                down[at] += z @ self.words[c].T
        if slopes is not None:
            down *= 1 - h * h
            slopes["middle"] += down.sum(axis=0)
            place = np.arange(WIDTH)
            for row, ids in zip(slopes["around"], around):
                row += np.bincount((ids[:, None] * WIDTH + place).ravel(), weights=down.ravel(), minlength=(SIZE + 1) * WIDTH).reshape(SIZE + 1, WIDTH)
        return out

    def train(self, x: np.ndarray, around: np.ndarray, seen: dict[str, np.ndarray]) -> None:
        """One step of Adagrad for each batch; `seen` holds the squares so far."""
        for a in range(0, len(x), BATCH):
            slopes = {n: np.zeros_like(getattr(self, n)) for n in self.NAMES}
            own = x[a : a + BATCH]
            self.step(own, around[:, a : a + BATCH], slopes)
            for n, s in slopes.items():
                s /= len(own)
                seen[n] += s * s
                getattr(self, n)[...] -= RATE * s / (np.sqrt(seen[n]) + 1e-6)

    def score(self, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Summed log-probability of each text."""
        around = contexts(x, starts)
        logs = np.concatenate([np.zeros(0), *(self.step(x[a : a + BATCH], around[:, a : a + BATCH]) for a in range(0, len(x), BATCH))])
        out, some = np.zeros(len(starts) - 1), np.flatnonzero(np.diff(starts))
        if len(some):  # each text's own logarithms only, in their order
            out[some] = np.add.reduceat(logs.astype(np.float64), starts[some])
        return out


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, bucket, n) of all distinct words of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                words, codes, _ = coded_word_array(part.column(text))
                if len(words):
                    normal = _normal(words)
                    yield pa.RecordBatch.from_arrays([normal, pa.array(_buckets(normal).astype(np.int32)), pa.array(np.bincount(codes, minlength=len(words)))], names=["word", "bucket", "n"])

    return docs.select(text).mapInArrow(run, "word string, bucket int, n long").groupBy("word").agg(F.min("bucket").alias("bucket"), F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, text: str = "text", counts: DataFrame | None = None) -> tuple[list[str], np.ndarray]:
    """The KNOWN most frequent words of all documents, and the counts of all tokens (what is left, evenly over the buckets)."""
    counts = (counted(docs, text) if counts is None else counts).select("word", "n")
    top = counts.where("word != ''").orderBy(F.desc("n"), "word").limit(KNOWN).withColumn("kind", F.lit(0))
    every = counts.agg(F.sum("n").alias("n")).select(F.lit("").alias("word"), "n", F.lit(1).alias("kind"))
    rows = top.unionByName(every).collect()
    words = [(r.n, r.word) for r in rows if r.kind == 0]
    words.sort(key=lambda w: (-w[0], w[1]))
    total = next((r.n for r in rows if r.kind == 1), 0) or 0
    known = np.array([n for n, _ in words] + [0] * (KNOWN - len(words)), float)
    return [w for _, w in words], np.concatenate([known, np.full(MEMBERS, (total - known.sum()) / MEMBERS)])


def _token_rows(docs: DataFrame, words: list[str], text: str, key: Column, parts: int) -> DataFrame:
    """(part, h, x): the tokens of each text that has some, as 16-bit numbers, dealt to parts and in the order that they are trained in."""
    sent = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_only()
        known = pa.array(sent.value, pa.string())
        for batch in batches:
            for piece in slices(batch, "text"):
                x, starts = _tokens(piece.column("text"), known)
                some = np.flatnonzero(np.diff(starts))
                if len(some):
                    raw, ends = pa.py_buffer(x.astype(np.uint16)), np.append(starts[some], starts[-1]) * 2
                    rows = pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(ends.astype(np.int32)), raw])
                    yield pa.RecordBatch.from_arrays([piece.column("h").take(pa.array(some)), rows], names=["h", "x"])
        give_back()

    rows = docs.select(F.col(text).alias("text"), key.alias("h")).mapInArrow(run, "h long, x binary")
    own = rows.select(F.pmod("h", F.lit(parts)).cast("int").alias("part"), "h", "x")
    return own.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "h", "x")


MODEL = "part int, block int, weight double, values array<float>"


def _trained(broadcast):
    """Trains a copy on each part of rows sorted by (part, h, x). What a step sees depends on these rows only."""
    names = ["part", "block", "weight", "values"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_only()
        now, net, seen, tokens = None, None, None, 0
        texts: list[np.ndarray] = []
        held = 0

        def learn() -> None:
            nonlocal texts, held
            if texts:
                x, starts = np.concatenate(texts).astype(np.int32), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
                net.train(x, contexts(x, starts), seen)
            texts, held = [], 0

        def give() -> Iterator[pa.RecordBatch]:
            for b, piece in enumerate(np.array_split(net.flat(), BLOCKS)):
                yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([b], pa.int32()), pa.array([float(tokens)]), pa.array([piece], pa.list_(pa.float32()))], names=names)

        for batch in batches:
            for part, raw in zip(batch.column(0).to_numpy().tolist(), batch.column(2)):
                if part != now:
                    if net is not None:
                        learn()
                        yield from give()
                    now, net, tokens = part, Network(broadcast.value), 0
                    seen = {n: np.full_like(getattr(net, n), 1e-4) for n in net.NAMES}
                texts.append(np.frombuffer(raw.as_buffer(), np.uint16))
                held += len(texts[-1])
                tokens += len(texts[-1])
                if held >= LAID:
                    learn()
        if net is not None:
            learn()
            yield from give()
        give_back()

    return run


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of each (part, block), of rows sorted by them."""
    now, sums, weight = None, None, 0.0

    def give() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int32()), pa.array([weight]), pa.array([(sums / weight).astype(np.float32)], pa.list_(pa.float32()))], names=["part", "block", "weight", "values"])

    for batch in batches:
        for part, block, w, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
            if (part, block) != now:
                if now is not None:
                    yield give()
                now, sums, weight = (part, block), 0.0, 0.0
            sums, weight = sums + values.values.to_numpy().astype(np.float64) * w, weight + w
    if now is not None:
        yield give()


def fit(docs: DataFrame, words: list[str], counts: np.ndarray, text: str = "text", doc_id: str | None = "doc_id", part: int = PART) -> np.ndarray:
    """The averaged network's parameters after one pass over all tokens."""
    key = F.xxhash64(*([F.col(doc_id)] if doc_id in docs.columns else []), F.col(text))
    n = max(1, -(-int(counts.sum()) // part))
    trained = _trained(docs.sparkSession.sparkContext.broadcast(counts))
    models = _token_rows(docs, words, text, key, n).mapInArrow(trained, MODEL)
    while True:
        n = -(-n // FAN)
        grouped = models.withColumn("own", F.col("part")).withColumn("part", F.floor(F.col("part") / FAN).cast("int"))
        models = grouped.repartition(min(n * BLOCKS, 4096), "part", "block").sortWithinPartitions("part", "block", "own").drop("own").mapInArrow(_averaged, MODEL)
        if n == 1:
            break
    rows = models.collect()
    return np.concatenate([np.array(r["values"], np.float32) for r in sorted(rows, key=lambda r: r.block)]) if rows else Network(counts).flat()


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", trained_on: DataFrame | None = None) -> DataFrame:
    """doc_id, n_tokens, log_prob (summed), mean_log_prob of each document's tokens (a word beyond the network's is its bucket), under a
    network trained on all of them. `word_score` tells the words of a bucket apart."""
    corpus = docs if trained_on is None else trained_on
    words, counts = vocabulary(corpus, text)
    sent = docs.sparkSession.sparkContext.broadcast((words, fit(corpus, words, counts, text, doc_id)))

    def make():
        known, net = pa.array(sent.value[0], pa.string()), Network().load(sent.value[1])

        def each(part: pa.RecordBatch) -> dict[str, pa.Array]:
            x, starts = _tokens(part.column(text), known)
            total, n = net.score(x, starts), np.diff(starts).astype(np.int64)
            mean = pa.array(total / np.maximum(n, 1), mask=n == 0)
            return {"n_tokens": pa.array(n), "log_prob": pa.array(total), "mean_log_prob": mean}

        return each

    return with_columns(docs, text, [("n_tokens", T.LongType()), ("log_prob", T.DoubleType()), ("mean_log_prob", T.DoubleType())], make, [doc_id])


def _within(counts: DataFrame, words: list[str]) -> tuple[DataFrame, Column]:
    """(word, within) of the words outside of `words`: the logarithm of each one's probability within its bucket. And the same for a word
    that the corpus lacks, of columns `word` and `bucket`: such words share what as many further tokens as the bucket has distinct words,
    and one, would have (Witten and Bell), by a code of 257 equal signs, its bytes and an end."""
    rest = counts.where(~F.col("word").isin(words)) if words else counts
    totals, kinds = np.zeros(MEMBERS), np.zeros(MEMBERS)
    for r in rest.groupBy("bucket").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect():
        totals[r.bucket], kinds[r.bucket] = r.n, r.kinds
    every = np.log(totals + kinds + 1)
    of = lambda values: F.element_at(F.array(*(F.lit(float(v)) for v in values)), F.col("bucket") + 1)
    lacking = of(np.log(kinds + 1) - every) - (F.octet_length("word") + 1) * float(np.log(257))
    return rest.select("word", (F.log(F.col("n").cast("double")) - of(every)).alias("within")), lacking


def word_score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", trained_on: DataFrame | None = None) -> DataFrame:
    """The columns of `score`, for the words themselves: a word beyond the network's counts with its probability within its bucket."""
    corpus = docs if trained_on is None else trained_on
    counts = cut(counted(corpus, text))
    words, known_counts = vocabulary(corpus, text, counts)
    within, lacking = _within(counts, words)
    sent = docs.sparkSession.sparkContext.broadcast((words, fit(corpus, words, known_counts, text, doc_id)))
    source = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    fields = [("word", T.StringType()), ("bucket", T.IntegerType()), ("rows", T.ArrayType(T.LongType())), ("id", source.schema["id"].dataType), ("n_tokens", T.LongType()), ("log_prob", T.DoubleType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each text, and one for each other word of a slice with the texts that it stands in, as often as it does."""
        hold_only()
        known, net = pa.array(sent.value[0], pa.string()), Network().load(sent.value[1])
        base, names = TaskContext.get().partitionId() << 33, [n for n, _ in fields]
        for batch in batches:
            for part in slices(batch, "text"):
                normal, ids, codes, starts = _coded(part.column("text"), known)
                total, n = net.score(ids[codes] if len(codes) else np.zeros(0, np.int32), starts), np.diff(starts).astype(np.int64)
                rows = base + np.arange(len(n))
                base += len(n)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32)), pa.array(rows))
                none = pa.nulls(len(n), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array([f" {r}" for r in rows.tolist()], pa.string()), none, lists, part.column("id"), pa.array(n), pa.array(total)], names=names)  # no word has a space
                other = np.flatnonzero(ids[codes] >= KNOWN) if len(codes) else np.zeros(0, np.int64)
                if len(other):
                    order = other[np.argsort(codes[other], kind="stable")]
                    kinds, first = np.unique(codes[order], return_index=True)
                    places = np.repeat(rows, n)[order]
                    lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(order)).astype(np.int32)), pa.array(places))
                    m = len(kinds)
                    yield pa.RecordBatch.from_arrays([normal.take(pa.array(kinds)), pa.array(ids[kinds] - KNOWN, pa.int32()), lists, pa.nulls(m, part.column("id").type), pa.nulls(m, pa.int64()), pa.nulls(m, pa.float64())], names=names)
        give_back()

    made = source.mapInArrow(run, T.StructType([T.StructField(n, t) for n, t in fields]))
    own = F.coalesce("within", F.when(F.col("bucket").isNotNull(), lacking), F.col("log_prob"))
    each = made.join(within, "word", "left").select(own.alias("log_prob"), "id", "n_tokens", F.explode("rows").alias("row"))
    summed = each.groupBy("row").agg(F.first("id", ignorenulls=True).alias(doc_id), F.max("n_tokens").alias("n_tokens"), F.sum("log_prob").alias("log_prob"))
    return summed.select(doc_id, "n_tokens", "log_prob", F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")).alias("mean_log_prob"))
