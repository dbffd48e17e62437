"""Location trees and filters over frame inventories."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import EMPTY_MARKERS, MISSING_FILTER_NAME, folded

LEVELS = ("continent", "country", "state", "city")
_SCHEMA = "continent string, country string, state string, city string"


def _everything(value: Any) -> bool:
    if value is None or value == [] or value == {} or value == ():
        return True
    return isinstance(value, str) and (value.strip() in EMPTY_MARKERS or value.strip().casefold() == "all")


def _name(value: Any) -> str:
    import re

    text = "" if value is None else str(value).strip()
    tidy = " ".join(re.sub(r'[<>:"/\\|?*]+', "_", text).split())
    return "unknown" if text in MISSING_FILTER_NAME or not tidy else tidy


def location_rows(tree: Any) -> list[tuple[str | None, ...]]:
    """A nested location setting as filter rows; None stands for everything at a level. A wrong shape is a ValueError."""
    rows: list[tuple[str | None, ...]] = []

    def walk(node: Any, path: tuple[str, ...]) -> None:
        if _everything(node):
            rows.append(path + (None,) * (4 - len(path)))
        elif len(path) < 3:
            if not isinstance(node, dict):
                raise ValueError(f"below '{' / '.join(path) or 'the root'}' a dictionary is needed")
            for key, below in node.items():
                walk(below, (*path, _name(key)))
        else:
            cities = node.split(",") if isinstance(node, str) else node if isinstance(node, (list, tuple, set)) else [node]
            names = [_name(c) for c in cities]
            if any(_everything(c) for c in cities) or not (names := [n for n in names if n != "unknown"]):
                rows.append((*path, None))
            rows.extend((*path, n) for n in names if not any(_everything(c) for c in cities))

    walk(tree, ())
    return list(dict.fromkeys(rows)) or [(None,) * 4]


def location_filters(spark: SparkSession, tree: Any) -> DataFrame:
    return spark.createDataFrame(location_rows(tree), _SCHEMA)


def _covers(f: DataFrame, t: DataFrame) -> Column:
    out = F.lit(True)
    for level in LEVELS:
        out = out & (f[level].isNull() | (f[level] == t[level]))
    return out


def expand_cities(tree: DataFrame, filters: DataFrame) -> DataFrame:
    """The cities that filters cover, once each; names match in their exact case.

    Filters with the same levels given form one equi-join, so there are 16 joins at most and never a nested loop over the tree.
    """
    cities = tree.select(*LEVELS).distinct()
    shape = F.concat(*(F.when(F.col(level).isNull(), "0").otherwise("1") for level in LEVELS))
    shaped = filters.select(*LEVELS, shape.alias("shape")).distinct()
    found = None
    for (pattern,) in shaped.select("shape").distinct().collect():  # 16 at most
        given = [level for level, bit in zip(LEVELS, pattern) if bit == "1"]
        mine = shaped.where(F.col("shape") == pattern)
        part = cities.join(mine.select(*given), given, "left_semi").select(*LEVELS) if given else cities
        found = part if found is None else found.unionByName(part)
    return found.distinct() if found is not None else cities.limit(0)


def matching(inventory: DataFrame, filters: DataFrame) -> DataFrame:
    """Inventory rows of the cities that filters cover. Filters are a setting; they go to the rows, which are read once and not moved."""
    shape = F.concat(*(F.when(F.col(level).isNull(), "0").otherwise("1") for level in LEVELS))
    shaped = filters.select(*LEVELS, shape.alias("shape")).distinct()
    columns, out, marks = inventory.columns, inventory, []
    for (pattern,) in shaped.select("shape").distinct().collect():  # 16 at most
        given = [level for level, bit in zip(LEVELS, pattern) if bit == "1"]
        if not given:
            return inventory
        marks.append(f"__m{pattern}")
        out = out.join(F.broadcast(shaped.where(F.col("shape") == pattern).select(*given, F.lit(True).alias(marks[-1]))), given, "left")
    return out.where(F.coalesce(*marks, F.lit(False))).select(*columns) if marks else inventory.limit(0)


def among(column: str, wanted: list[str]) -> Column:
    """Membership without regard to case; an empty list takes all."""
    return folded(F.col(column)).isin([w.casefold() for w in wanted]) if wanted else F.lit(True)


def select_frames(inventory: DataFrame, days: list[str], vehicles: list[str], videos: list[str]) -> DataFrame:
    return inventory.where(among("day_night", days) & among("vehicle", vehicles) & among("video_id", videos))


def missing_values(inventory: DataFrame, by: list[str], column: str, wanted: list[str]) -> DataFrame:
    """For each `by`: wanted values (column `wanted`) that no row of it has. The wanted list is a setting, a few values."""
    there = inventory.select(*by, folded(F.col(column)).alias("__low")).distinct()
    values = F.array(*(F.struct(F.lit(w).alias("wanted"), F.lit(w.casefold()).alias("__low")) for w in dict.fromkeys(wanted)))
    asked = there.select(*by).distinct().select(*by, F.inline(values))
    return asked.join(there, [*by, "__low"], "left_anti").select(*by, "wanted")
