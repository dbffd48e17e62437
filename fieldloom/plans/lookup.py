"""Where videos can be had: directly below an alias, else wherever a walk over its browse pages finds them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import is_file_link
from ..operators.links import direct_urls, locate, walk
from ..sources.settings import Settings


def walked_files(edges: DataFrame, roots: DataFrame, settings: Settings) -> DataFrame:
    """url, label, depth, priority of the files on the pages of a walk: of each alias as many pages as the settings allow. `edges` has parent,
    child and label, the text of the link; files are no pages. `roots` has node and, where there are several aliases, their rank, which is the priority."""
    files = is_file_link(F.col("child"))
    ranked = roots if "rank" in roots.columns else roots.withColumn("rank", F.lit(0))
    pages = walk(edges.where(~files).select("parent", "child"), ranked, settings.crawl_pages)
    return pages.withColumnRenamed("node", "parent").join(edges.where(files), "parent").select(F.col("child").alias("url"), "label", "depth", F.col("rank").alias("priority"))


def video_sources(edges: DataFrame, roots: DataFrame, wanted: DataFrame, settings: Settings, aliases: list[str]) -> DataFrame:
    """name, priority, url of each wanted name: its direct addresses in the aliases' order, then where each alias' walk has found it first."""
    direct = direct_urls(wanted, settings.base_url, aliases)
    found = locate(walked_files(edges, roots, settings), wanted, each=True).select("name", (F.col("priority") + len(aliases)).alias("priority"), "url")
    return direct.unionByName(found)
