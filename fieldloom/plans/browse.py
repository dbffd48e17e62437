"""An inventory of frames from browse pages: the folders' levels, one after the other."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import file_name, is_image, quote
from ..operators.filters import LEVELS, among, location_rows, missing_values
from ..operators.links import anchors, browse_links, fetched
from ..operators.sampling import FOLDER, first_folders
from ..sources.adapters import Fetcher, fetch_pages
from ..sources.folders import cut, once, shared_folder
from ..sources.settings import Settings
from .sample import wanted_values

#: Addresses of which a hash (8 bytes) is sent to all tasks at most.
MOST_HASHES = 1_000_000
#: Gives url (as it was had, with or without a slash at its end) and html of the pages in a column `url`, as far as there are any.
Reader = Callable[[DataFrame], DataFrame]


def stored_pages(pages: DataFrame) -> Reader:
    """Reads from a table of pages (url, html). If it is in parts by `depth` (of how many pieces between slashes the address is, without slashes at its end), only
    parts that are asked for are read.

    Pages stay where they are: a hash of each wanted address goes to them, and only pages with such a hash are moved to be joined by their
    addresses. Beyond MOST_HASHES addresses all are moved.
    """

    def read(wanted: DataFrame) -> DataFrame:
        asked = cut(wanted.select(_bare("url").alias("url")).distinct())
        near = pages
        if "depth" in pages.columns:
            depths = asked.select(F.size(F.split("url", "/")).alias("n")).distinct().collect()  # a few: folders of one level
            near = near.where(F.col("depth").isin([r.n for r in depths]))
        if asked.count() <= MOST_HASHES:
            hashes = asked.select(F.xxhash64("url").alias("__hash")).distinct()
            near = near.withColumn("__hash", F.xxhash64(F.regexp_replace("url", "/$", ""))).join(F.broadcast(hashes), "__hash", "left_semi")
        return fetched(asked, near.select("url", "html")).where("html is not null").select(F.col("form").alias("url"), "html")

    return read


def fetched_pages(fetch: Fetcher) -> Reader:
    """Reads from a server."""
    return lambda wanted: fetch_pages(wanted, fetch).select("url", "html")


def _bare(url: str) -> Column:
    return F.regexp_replace(url, "/+$", "")


def children(folders: DataFrame, read: Reader, kind: str) -> DataFrame:
    """Rows of folders (url and more) with name and child, one for each folder or file that their pages link to. What is not there has none."""
    pages = read(folders.select("url").distinct())
    found = browse_links(anchors(pages)).where(F.col("kind") == kind).select(_bare("page_url").alias("__at"), "name", F.col("url").alias("child"))
    return folders.withColumn("__at", _bare("url")).join(found, "__at").drop("__at")


def _down(folders: DataFrame, level: str, read: Reader) -> DataFrame:
    """The folders of the next level: those that filters name, without a look at the page above them, else all that this page links to."""
    kept = [c for c in folders.columns if c not in ("url", f"asked_{level}")]
    if f"asked_{level}" not in folders.columns:
        return children(folders, read, "folder").select(*kept, F.col("name").alias(level), F.col("child").alias("url")).distinct()
    asked = F.col(f"asked_{level}")
    named = folders.where(asked.isNotNull()).select(*kept, asked.alias(level), F.concat(_bare("url"), F.lit("/"), quote(asked)).alias("url"))
    listed = children(folders.where(asked.isNull()), read, "folder").select(*kept, F.col("name").alias(level), F.col("child").alias("url"))
    return named.unionByName(listed).distinct()


@dataclass
class Inventory:
    """frames: what was found. levels: for each level its folders, before the filter of this level."""

    frames: DataFrame
    levels: dict[str, DataFrame]
    wanted: dict[str, list[str]]

    def missing(self, level: str) -> DataFrame:
        """Where a value of a filter is not there: alias, the levels above, and the value, `wanted`."""
        above = ["alias", *FOLDER[: FOLDER.index(level)]]
        return missing_values(self.levels[level], above, level, self.wanted[level])


def browse_inventory(spark: SparkSession, read: Reader, settings: Settings, aliases: list[str], store: str | None = None) -> Inventory:
    """The frames below the aliases' browse pages that the settings' filters of place, day, vehicle and video let through.

    Each level is read in the cluster, a task for many pages, and filtered before the next one is asked for; named places are not looked up in the pages
    above them. Every level is stored as a table below `store` when it is whole, so a run with the same `store` goes on behind the last whole
    level. Of each city as many video folders are looked into as the settings allow, in the order of its random walk.
    """
    folder = (store or f"{shared_folder(spark)}/inventory-{uuid.uuid4().hex}").rstrip("/")
    wanted = wanted_values(spark, settings)
    # aliases and places are settings
    starts = [(a, f"{settings.base_url.rstrip('/')}/v/{a}/browse", *place) for a in dict.fromkeys(aliases) for place in location_rows(settings.location_tree)]
    at = spark.createDataFrame(starts, ", ".join(f"{c} string" for c in ("alias", "url", *(f"asked_{level}" for level in LEVELS))))
    levels: dict[str, DataFrame] = {}
    for n, level in enumerate(FOLDER):
        levels[level] = once(spark, f"{folder}/{n}-{level}", lambda above=at, level=level: _down(above, level, read))
        at = levels[level].where(among(level, wanted[level])) if level in wanted else levels[level]
    some = once(spark, f"{folder}/{len(FOLDER)}-folders", lambda: first_folders(at, settings.folders_per_city, settings.seed))
    files = lambda: children(some, read, "file").where(is_image(F.col("child")))
    named = lambda: files().select(F.col("child").alias("url"), file_name(F.col("child")).alias("filename"), "alias", *FOLDER).distinct()
    return Inventory(once(spark, f"{folder}/{len(FOLDER) + 1}-frames", named), levels, wanted)
