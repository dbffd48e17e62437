"""Mapping files that keep arriving, planned as they come. An extension: it adds no operator to those of the batch plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.segments import mapping_frames, ranges_of, videos_of
from ..sources.mapping import REQUIRED


def stream_mapping(spark: SparkSession, folder: str) -> DataFrame:
    """A streaming DataFrame of the rows of new mapping files. Their headers must name the required columns in order; others fail the query."""
    schema = ", ".join(f"{c} string" for c in REQUIRED)
    return spark.readStream.schema(schema).option("header", True).option("enforceSchema", False).option("escape", '"').option("multiLine", True).csv(folder)


def write_frames(rows: DataFrame, out: str, checkpoint: str, root: str, step: int):
    """Plans each batch of files and appends its frames as Parquet, once for each batch even if it is retried. Rows are numbered within
    their batch, so equal rows stay apart."""

    def batch(df: DataFrame, n: int) -> None:
        numbered = df.withColumn("row_num", F.monotonically_increasing_id())
        mapping_frames(ranges_of(videos_of(numbered)), root, step).write.mode("overwrite").parquet(f"{out}/batch={n}")

    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
