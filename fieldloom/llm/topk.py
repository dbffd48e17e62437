"""Exact top-k search by inner product: columnar branch and bound.

Vectors are turned into integers. A task holds its vectors in vertical layout, one row of memory for each dimension. For a query the
products are accumulated block by block of dimensions. After each block the rest of a product is at most the product of the norms
of what is left of both vectors (the remaining mass); candidates whose accumulated score plus that cannot reach the k-th best
score known so far are dropped, and the survivors are compacted before the next block. The k-th best is known from the start: a pilot of
at most PILOT vectors, fully scored in tasks, gives each query a lower bound that holds for all tasks, so they return few candidates.

Queries and their bounds are made once. They are taken in blocks of about QUERIES, whose size is bounded: one block is passed over all
vectors; several are stored in the shared folder, one part each, and passed one after the other, and each adds its k best to a stored
table, so neither plans nor memory grow with the queries. Nothing is shuffled but the tasks' candidates.

Defined cases: rows whose id or vector is null, or whose vector holds null or non-finite components, take no part; shorter vectors
count as filled up with zeros, an empty one as all zeros. Of rows with one id the query is the smallest vector (ties between them are equal vectors), and all of them are
its own; as candidates of other queries each counts by itself. Sums are exact up to 2^53, beyond that Python integers would be
needed and a ValueError is raised. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, remove, shared_dir

K, BLOCK, QUERIES, PILOT, ROWS = 20, 8, 4096, 2048, 32768


def integers(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component x as a double; null if a component is null or not finite."""
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(fine, whole)


def _matrix(column: pa.Array) -> np.ndarray:
    """One row for each vector, filled up with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(column.offsets.to_numpy())
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _width(m: np.ndarray, width: int) -> np.ndarray:
    return m if m.shape[1] == width else np.pad(m, ((0, 0), (0, width - m.shape[1])))


def masses(m: np.ndarray, block: int) -> np.ndarray:
    """Norms of what is left of each vector from each block on; a last one of zeros."""
    squares = np.add.reduceat(m * m, np.arange(0, m.shape[1], block), axis=1) if m.shape[1] else np.zeros((len(m), 1))
    left = np.sqrt(np.cumsum(squares[:, ::-1], axis=1)[:, ::-1])
    return np.concatenate([left, np.zeros((len(m), 1))], axis=1)


class Search:
    """Vectors in vertical layout."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, block: int) -> None:
        self.ids, self.block = ids, block
        self.columns = np.ascontiguousarray(m.T)
        self.left = np.ascontiguousarray(masses(m, block).T)

    def best(self, query: np.ndarray, own: int, k: int, floor: float, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best that reach `floor`, among all but the rows with the query's own id."""
        alive = np.flatnonzero(self.ids != own)
        score = np.zeros(len(alive))
        for b, start in enumerate(range(0, len(query), self.block)):
            dims = slice(start, start + self.block)
            part = self.columns[dims] if len(alive) == len(self.ids) else self.columns[dims].take(alive, axis=1)
            score += query[dims] @ part
            rest = self.left[b + 1, alive] * left[b + 1]
            if len(alive) > k:
                low = score - rest
                floor = max(floor, np.partition(low, len(low) - k)[len(low) - k])
            stay = score + rest >= floor - 1e-6 * (1 + abs(floor))
            if not stay.all():
                alive, score = alive[stay], score[stay]
            if not len(alive):
                break
        order = np.lexsort((self.ids[alive], -score))[:k]
        return self.ids[alive[order]], score[order]


def _with_floors(asked: DataFrame, pilot: tuple[np.ndarray, np.ndarray], k: int, block: int) -> DataFrame:
    """Adds `low`: the k-th best score of each query (id, v) among the pilot's vectors; minus infinity if it has fewer."""
    sent = asked.sparkSession.sparkContext.broadcast(pilot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, m = batch.column(0).to_numpy(), _matrix(batch.column(1))
            if first is None or first.columns.shape[0] < m.shape[1]:
                first = Search(sent.value[0], _width(sent.value[1], max(m.shape[1], sent.value[1].shape[1])), block)
            full = _width(m, first.columns.shape[0])
            left, low = masses(full, block), np.full(len(ids), -np.inf)
            for i in range(len(ids)):
                _, scores = first.best(full[i], ids[i], k, -np.inf, left[i])
                if len(scores) == k:
                    low[i] = scores[-1]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(low)], names=["id", "v", "low"])

    return asked.select("id", "v").mapInArrow(run, "id long, v array<double>, low double")


def _search_block(vectors: DataFrame, queries: pa.Table, k: int, block: int, rows: int) -> DataFrame:
    """The k best of each query of a block: query_id, rank, vec_id, score."""
    sent = vectors.sparkSession.sparkContext.broadcast((queries.column("id").to_numpy(), _matrix(queries.column("v").combine_chunks()), queries.column("low").to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, m, limits = sent.value
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def work() -> pa.RecordBatch:
            own, width = np.concatenate([h[0] for h in held]), max([m.shape[1], *(h[1].shape[1] for h in held)])
            there, all_m = Search(own, np.concatenate([_width(h[1], width) for h in held]), block), _width(m, width)
            left = masses(all_m, block)
            if (all_m * all_m).sum(axis=1).max(initial=0) ** 0.5 * there.left[0].max(initial=0) >= 2**53:
                raise ValueError("inner products beyond 2^53 are not exact")
            out = [(i, *there.best(all_m[i], ids[i], k, limits[i], left[i])) for i in range(len(ids))]
            sizes = [len(a) for _, a, _ in out]
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, sizes)), pa.array(np.concatenate([a for _, a, _ in out])), pa.array(np.concatenate([s for _, _, s in out]).astype(np.int64))], names=["query_id", "vec_id", "score"])

        for batch in batches:
            if batch.num_rows:
                held.append((batch.column(0).to_numpy(), _matrix(batch.column(1))))
            if sum(len(h[0]) for h in held) >= rows:
                yield work()
                held.clear()
        if held:
            yield work()

    found = vectors.mapInArrow(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding", k: int = K, scale: int = 64, block: int = BLOCK, queries: int = QUERIES, pilot: int = PILOT, rows: int = ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest inner products, ties to the smaller vec_id."""
    taking = vectors.where(F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("long").alias("id"), integers(F.col(vector), scale).alias("v"), is_query.alias("q")).where("v is not null")
    spark = vectors.sparkSession
    some = taking.select("id", "v").limit(pilot).toArrow().combine_chunks()
    first = (some.column("id").to_numpy(), _matrix(some.column("v").combine_chunks())) if some.num_rows else (np.zeros(0, np.int64), np.zeros((0, 0)))
    asked = cut(_with_floors(taking.where("q").groupBy("id").agg(F.min("v").alias("v")), first, k, block))
    total, every = asked.count(), taking.select("id", "v")
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if total <= queries:
        return _search_block(every, asked.toArrow().combine_chunks(), k, block, rows)
    parts, folder = -(-total // queries), f"{shared_dir(spark).rstrip('/')}/top-k-{uuid.uuid4().hex}"
    asked.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")).repartition(parts, "part").write.partitionBy("part").parquet(f"{folder}/asked")
    stored = spark.read.schema("id long, v array<double>, low double, part int").parquet(f"{folder}/asked")
    for p in range(parts):
        one = stored.where(F.col("part") == p).select("id", "v", "low").toArrow().combine_chunks()
        if one.num_rows:
            _search_block(every, one, k, block, rows).write.mode("append").parquet(f"{folder}/found")
    remove(spark, f"{folder}/asked")
    return spark.read.schema("query_id long, rank int, vec_id long, score long").parquet(f"{folder}/found")
