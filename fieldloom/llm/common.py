"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.folders import cut  # noqa: F401, the operators use it
from ..sources.folders import shared_folder as shared_dir  # noqa: F401

#: Python works on slices of about so many bytes of text, however large the batches are that Spark hands over.
SLICE_BYTES = 6_000_000
#: A key is split where it has more rows than this, and than one in so many of all rows: so fewer keys than the second are split.
HOT_ROWS, HOT_KEYS = 200, 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of ours, in whatever store it lies."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def give_back() -> None:
    """Returns memory that this worker no longer uses to the system; workers live on for later tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not every C library has it
        pass


def hot_keys(counts: DataFrame, total: int, least: int = HOT_ROWS) -> DataFrame:
    """The rows of `counts` (keys, n and any more) whose key has many of all `total` rows, with `__salts` in place of n: the number of tasks
    to deal them to. Fewer than HOT_KEYS rows, and at most twice as many salts, so they can be broadcast."""
    size = max(least, total // HOT_KEYS)
    return cut(counts.where(F.col("n") > size).withColumn("__salts", F.ceil(F.col("n") / size).cast("int")).drop("n"))


def salted(rows: DataFrame, hot: DataFrame, on: list[str], salt: Column) -> DataFrame:
    """Adds `__salt` to rows: that of the column for hot keys, 0 where it is null and for all others."""
    return rows.join(F.broadcast(hot), on, "left").select(*rows.columns, F.coalesce(F.when(F.col("__salts").isNotNull(), salt), F.lit(0)).alias("__salt"))


def for_each_salt(rows: DataFrame, hot: DataFrame, on: list[str], more: int = 0) -> DataFrame:
    """Rows once for each salt of their key, from 0 (and so many salts more for hot keys)."""
    last = F.coalesce(F.col("__salts") - 1 + more, F.lit(0))
    return rows.join(F.broadcast(hot), on, "left").select(*rows.columns, F.explode(F.sequence(F.lit(0), last)).alias("__salt"))


_held: dict[str, Callable[[], None]] = {}


def hold_only(name: str = "", clear: Callable[[], None] | None = None) -> None:
    """Called where a task starts: tables that other operators have left in this worker are dropped; `clear` drops this one's."""
    others = [n for n in _held if n != name]
    for n in others:
        _held.pop(n)()
    if others:
        gc.collect()
        give_back()
    if clear is not None:
        _held[name] = clear


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into runs of rows with about `most` bytes of text; one longer text is a slice of its own."""
    n = batch.num_rows
    if not n:
        return
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < n:
        done = size[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(size, done + most, "right")))
        yield batch.slice(start, end - start)
        start = end


def with_columns(df: DataFrame, text: str, fields: list[tuple[str, T.DataType]], make: Callable[[], Callable[[pa.RecordBatch], dict[str, pa.Array]]], keep: list[str] | None = None, most: int = SLICE_BYTES, holds: tuple[str, Callable[[], None]] | None = None) -> DataFrame:
    """Adds columns that Python makes from a text column, a slice of rows at a time.

    `make()` runs once in each task and returns the function for slices. A column of `df` with the name of a new one is replaced.
    `keep` names the columns of `df` to carry along (all if None). Slices have about `most` bytes of text.
    `holds` names tables that `make` keeps in the worker for later tasks, and how to drop them.
    """
    new = [name for name, _ in fields]
    source = df if keep is None else df.select(*dict.fromkeys([*keep, text]))
    kept = [f for f in source.schema.fields if f.name not in new and (keep is None or f.name in keep)]
    schema = T.StructType([*kept, *(T.StructField(n, t) for n, t in fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_only(holds[0], holds[1]) if holds else hold_only()
        each = make()
        for batch in batches:
            for part in slices(batch, text, most):
                made = each(part)
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), *(made[n] for n in new)], names=[*(f.name for f in kept), *new])
        give_back()

    return source.mapInArrow(run, schema)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts of a column one after the other, and each text's start (nulls are empty)."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64, count=len(column) + 1 + column.offset)[column.offset :]
    data = column.buffers()[2]
    all_bytes = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return all_bytes[ends[0] : ends[-1]], ends - ends[0]


def coded_words(column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words between ASCII white space: the distinct ones, a code for each word, and the first word of each text."""
    words, codes, starts = coded_word_array(column)
    return words.to_pylist(), codes, starts


def coded_word_array(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The same with the distinct words as an Arrow array."""
    lists = pc.ascii_split_whitespace(pc.fill_null(column, ""))
    coded = lists.flatten().dictionary_encode()
    starts = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    words, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
    empty = pc.index(coded.dictionary, "").as_py()
    if empty >= 0:  # at white space at a text's ends
        stay = codes != empty
        starts, codes = np.concatenate([[0], np.cumsum(stay)])[starts], codes[stay]
    return words, codes, starts


#: Bytes of UTF-8 text to those of its plain words: A-Z in lower case, all other ASCII but letters and digits a space.
PLAIN = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))


def item_blocks(items: DataFrame, text: str, by: str, most: int) -> Iterator[pa.Table]:
    """Rows of a table that is small beside the documents, in blocks of about `most` bytes of text; rows with the same `by` stay together."""
    total = items.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = max(1, -(-total // most))
    for b in range(n):
        got = items.where(F.pmod(F.xxhash64(by), F.lit(n)) == b).toArrow().combine_chunks()
        if got.num_rows:
            yield got
