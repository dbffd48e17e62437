"""Mapping tables: one location in each row, with list-valued cells for its videos."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REQUIRED = ("continent", "country", "state", "locality", "videos", "time_of_day", "start_time", "end_time", "vehicle_type")
FIRST_ROW = 2  # the header is row 1


def require_columns(df: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required column in CSV: {missing[0]}")
    return df


def numbered(df: DataFrame, first: int = FIRST_ROW) -> DataFrame:
    """Adds row_num in the order of the source's partitions, in the JVM and without a shuffle of the rows: each partition's rows are counted,
    and it begins after those before it. A table of one file, as mapping tables are, has one partition and is read once."""
    tagged = df.withColumn("__id", F.monotonically_increasing_id())
    part, at = F.shiftright("__id", 33), F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    before = F.lit(0)
    if (parts := df.rdd.getNumPartitions()) > 1:  # a row of counts for each partition, however many rows there are
        counts = {r.p: r.n for r in tagged.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
        starts = [0, *accumulate(counts.get(p, 0) for p in range(parts - 1))]
        before = F.get(F.expr(f"array({', '.join(f'{n}L' for n in starts)})"), part.cast("int"))
    return tagged.withColumn("row_num", (at + before + F.lit(first)).cast("long")).drop("__id")


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, records numbered from 2. Quotes are doubled within quotes, cells may hold line ends, a mark at the start is skipped."""
    raw = spark.read.option("header", True).option("escape", '"').option("multiLine", True).option("encoding", "UTF-8").csv(path)
    return numbered(require_columns(raw).select(*(F.col(c).cast("string") for c in REQUIRED)))
