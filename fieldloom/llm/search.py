"""Ranked lexical search by block-max pruning.

Documents are read once: `forward_index` stores of each its length and the query terms it holds. Tasks take this index in ranges of
documents, cut into blocks. A block holds each term's largest share of a score, so a query's bound for a block is the sum over its terms. Blocks are
taken by falling bound and their documents are scored, until a bound is below the score that the query's last of k documents has; what a task has
found so far counts for all its later ranges. The best k of all tasks are merged, first by parts, then by item.

Scores are whole numbers: a term's weight is floor(1000 ln((2N + 2) / (2 df + 1))), its share weight * (10^9 tf div (1000 tf + 8 m)) with
m = 10 + 90 n N div L; N documents with terms hold L terms, this one n.

Terms of the items go to the tasks in blocks of BLOCK_BYTES of item text at most, one block after the other.

Defined cases: null or empty texts have no terms: they are found by no item, and as items they find nothing. Rows with the same item_id,
null included, are one item with the terms of all their texts. Each row of documents is ranked for itself, also where its doc_id repeats;
equal scores go by ascending doc_id, rows without one last. Documents of any length are read whole. Only named columns are used, so others
may have any name. Without documents or items the result is empty.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import PLAIN, cut, give_back, hold_only, item_blocks, remove, shared_dir, slices

#: Documents in a block, and documents whose blocks are looked at together.
BLOCK_DOCS, RANGE_DOCS = 64, 2048
BLOCK_BYTES = 8_000_000
#: An item's results are merged in so many parts first.
PARTS = 64


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(PLAIN).split()


@dataclass
class Queries:
    """A block of items: their ids, the distinct terms, and which of those each item has."""

    ids: pa.Array
    vocabulary: dict[bytes, int]
    terms: list[np.ndarray]

    @staticmethod
    def of(items: pa.Table) -> Queries | None:
        mine: dict[object, set[bytes]] = {}
        for i, text in zip(items.column("i").to_pylist(), items.column("t").cast(pa.binary()).to_pylist()):
            mine.setdefault(i, set()).update(terms_of(text))
        mine = {i: words for i, words in mine.items() if words}
        if not mine:
            return None
        vocabulary = {w: n for n, w in enumerate(sorted(set().union(*mine.values())))}
        return Queries(pa.array(list(mine), items.column("i").type), vocabulary, [np.array(sorted(vocabulary[w] for w in words), np.int64) for words in mine.values()])


def forward_index(docs: DataFrame, vocabulary: dict[bytes, int], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n (all its terms, with repeats) of each document that has terms, and numbers of the vocabulary's terms in it with their counts."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_only()
        number = sent.value.get
        for batch in batches:
            for part in slices(batch, "t"):
                lengths, terms, times = [], [], []
                for t in part.column("t").cast(pa.binary()):
                    words = terms_of(t.as_py())
                    counts = Counter(map(number, words))
                    counts.pop(None, 0)
                    lengths.append(len(words))
                    terms.append(list(counts))
                    times.append(list(counts.values()))
                made = [part.column("d"), pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(made, names=["d", "n", "terms", "times"]).filter(pc.greater(made[1], 0))
        give_back()

    rows = docs.select(F.col(doc_id).cast("long").alias("d"), F.col(text).alias("t"))
    return rows.mapInArrow(run, "d long, n long, terms array<int>, times array<int>")


class Best:
    """The k best documents of each query, over ranges of the forward index that come one after the other."""

    def __init__(self, queries: list[np.ndarray], weights: np.ndarray, docs: int, terms: int, k: int, block: int = BLOCK_DOCS) -> None:
        self.queries, self.weights, self.docs, self.terms, self.k, self.block = queries, weights, docs, terms, k, block
        none = np.zeros(0, np.int64)
        self.found = [(none, none, none)] * len(queries)  # scores, whether the id is null, ids
        self.floor = np.ones(len(queries), np.int64)  # what a document has to score
        self.scored = 0  # blocks

    def add(self, ids: np.ndarray, nulls: np.ndarray, lengths: np.ndarray, ends: np.ndarray, terms: np.ndarray, times: np.ndarray) -> None:
        """Documents in their order; document i has the terms from ends[i - 1] to ends[i]."""
        if not len(terms):
            return
        used, local = np.unique(terms, return_inverse=True)
        here = np.full(len(self.weights), -1, np.int64)
        here[used] = np.arange(len(used))
        doc = np.repeat(np.arange(len(ids)), np.diff(ends, prepend=0))
        m = 10 + 90 * lengths * self.docs // self.terms
        share = self.weights[terms] * (1_000_000_000 * times // (1000 * times + 8 * m[doc]))
        blocks = -(-len(ids) // self.block)
        maxima = np.zeros(blocks * len(used), np.int64)
        np.maximum.at(maxima, doc // self.block * len(used) + local, share)
        maxima = maxima.reshape(blocks, len(used))
        first = np.append(0, ends)[np.append(np.arange(0, len(ids), self.block), len(ids))]  # of each block's terms
        for q, mine in enumerate(self.queries):
            columns = here[mine]
            columns = columns[columns >= 0]
            if not len(columns):
                continue
            bounds = maxima[:, columns].sum(axis=1)
            asked = np.zeros(len(used), np.int64)
            asked[columns] = 1
            for b in np.argsort(-bounds, kind="stable"):
                if bounds[b] < self.floor[q]:
                    break
                a, z = b * self.block, min(len(ids), (b + 1) * self.block)
                running = np.append(0, np.cumsum(share[first[b] : first[b + 1]] * asked[local[first[b] : first[b + 1]]]))
                scores = np.diff(running[np.append(0, ends[a:z] - first[b])])
                self.scored += 1
                self._keep(q, scores, nulls[a:z], ids[a:z])

    def _keep(self, q: int, scores: np.ndarray, nulls: np.ndarray, ids: np.ndarray) -> None:
        high = scores >= self.floor[q]
        if high.any():
            s, o, i = (np.concatenate(pair) for pair in zip(self.found[q], (scores[high], nulls[high], ids[high])))
            order = np.lexsort((i, o, -s))[: self.k]
            self.found[q] = s[order], o[order], i[order]
            if len(order) == self.k:
                self.floor[q] = s[order[-1]]


def _first(rows: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search(docs: DataFrame, queries: Queries, item: T.DataType, k: int, doc_id: str, text: str) -> DataFrame | None:
    spark = docs.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/search-{uuid.uuid4().hex}"
    forward_index(docs, queries.vocabulary, doc_id, text).write.parquet(path)
    found = _ranked(spark.read.parquet(path), queries, item, k)
    remove(spark, path)
    return found


def _ranked(index: DataFrame, queries: Queries, item: T.DataType, k: int) -> DataFrame | None:
    spark = index.sparkSession
    n, total = index.agg(F.count("*"), F.sum("n")).first()
    if not n:
        return None
    # a row for each term of the block at most
    df = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toArrow()
    weights = np.zeros(len(queries.vocabulary), np.int64)
    for term, holding in zip(df.column("term").to_pylist(), df.column("df").to_pylist()):
        weights[term] = math.floor(1000 * math.log((2 * n + 2) / (2 * holding + 1)))
    sent = spark.sparkContext.broadcast((queries.terms, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_only()
        best = Best(*sent.value, n, total, k)
        for batch in batches:
            for start in range(0, batch.num_rows, RANGE_DOCS):
                part = batch.slice(start, RANGE_DOCS)
                lists = part.column("terms")
                ends = lists.offsets.to_numpy()[1:].astype(np.int64) - lists.offsets[0].as_py()
                d = part.column("d")
                numbers = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in (pc.fill_null(d, 0), d.is_null(), part.column("n"))]
                best.add(*numbers, ends, *(part.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("terms", "times")))
        for q, (scores, nulls, ids) in enumerate(best.found):
            if len(scores):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), q)).cast(pa.int32()), pa.array(ids, mask=nulls.astype(bool)), pa.array(scores)], names=["q", "doc_id", "score"])
        give_back()

    # the ids, a block's, are put back at the end
    rows = index.where(F.size("terms") > 0).mapInArrow(run, "q int, doc_id long, score long")
    part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))
    merged = _first(_first(rows.withColumn("part", part), k, "q", "part"), k, "q")
    names = spark.createDataFrame(pa.table({"q": pa.array(range(len(queries.ids)), pa.int32()), "item_id": queries.ids}), T.StructType([T.StructField("q", T.IntegerType()), T.StructField("item_id", item)]))
    # k rows for each item: stored, as the index goes
    return cut(merged.join(F.broadcast(names), "q").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank (from 1), doc_id, score of the k documents that score highest for each item, above 0."""
    asked = items.select(F.col(item_id).alias("i"), F.col(item_text).alias("t"))
    item = asked.schema["i"].dataType
    blocks = (Queries.of(block) for block in item_blocks(asked, "t", "i", block_bytes))
    found = [r for q in blocks if q is not None and (r := _search(docs, q, item, k, doc_id, text)) is not None]
    if not found:
        return docs.sparkSession.createDataFrame([], T.StructType([T.StructField("item_id", item), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    return reduce(DataFrame.unionByName, found)
