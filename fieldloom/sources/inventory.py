"""Inventories of files: videos that are there, frames that exist."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import basename, stem


def scan_files(spark: SparkSession, root: str, pattern: str = "*.[mM][pP]4") -> DataFrame:
    """path, file_name and length of files below a folder. Only their status is read, not their content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return files.select("path", basename(F.col("path")).alias("file_name"), "length")


def video_index(files: DataFrame, order: str = "path") -> DataFrame:
    """key -> path: by file name and by its stem, in lower case; the first file in order has a key."""
    low = F.lower("file_name")
    keys = F.array_distinct(F.array(low, stem(low)))
    return files.select(F.explode(keys).alias("key"), "path", F.col(order).alias("__order")).groupBy("key").agg(F.min_by("path", "__order").alias("path"))


def add_video(index: DataFrame, files: DataFrame) -> DataFrame:
    """An index with more files; their keys replace those that are there."""
    new = video_index(files)
    return index.join(new, "key", "left_anti").unionByName(new)


def remove_video(index: DataFrame, paths: DataFrame) -> DataFrame:
    return index.join(paths.select("path").distinct(), "path", "left_anti").select("key", "path")
