"""Repeatable random orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def draw(seed: str, level: str, *keys: Column | str) -> Column:
    """A text that orders rows at random, the same on every run and every engine that has md5."""
    return F.md5(F.concat_ws("|", F.lit(seed), F.lit(level), *keys))


def random_first(df: DataFrame, n: int, seed: str, level: str, *keys: Column | str) -> DataFrame:
    """n rows at random, kept by each task's n first; nothing else is shuffled."""
    return df.orderBy(draw(seed, level, *keys), *keys).limit(n)
