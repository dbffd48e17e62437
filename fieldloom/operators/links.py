"""Links of browse pages, and walks along them."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from functools import reduce
from itertools import count

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import MISSING_FILTER_NAME, basename, clean_name, folded, strip
from ..functions.urls import is_file_link, is_folder_link, join, path_of, quote, unquote
from ..sources.folders import cut
from ..sources.logs import logger

MOST_TABLES = 16
HREF = r"""<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""


class _Anchors(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[list] = []
        self.open: list[list] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "a":
            self.open.append([(dict(attrs).get("href") or "").strip(), []])
            self.found.append(self.open[-1])

    def handle_endtag(self, tag: str) -> None:
        if tag == "a" and self.open:
            self.open.pop()

    def handle_data(self, data: str) -> None:
        for a in self.open:
            a[1].append(data.strip())


def anchors_of(html: str | None) -> list[tuple[str, str]]:
    """(href, text) of the anchors of a page, in order."""
    reader = _Anchors()
    reader.feed(html or "")
    reader.close()
    return [(href, " ".join(x for x in text if x)) for href, text in reader.found]


def anchors(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """page_url, ord, href, label of every anchor, read by an HTML parser."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(u, i, h, t) for u, page in zip(pdf[url], pdf[html]) for i, (h, t) in enumerate(anchors_of(page))]
            yield pd.DataFrame(rows, columns=["page_url", "ord", "href", "label"])

    return pages.select(url, html).mapInPandas(run, "page_url string, ord int, href string, label string")


def hrefs(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """page_url, ord, href by a pattern in the JVM, for pages whose attributes are quoted."""
    return pages.select(F.col(url).alias("page_url"), F.posexplode(F.regexp_extract_all(html, F.lit(HREF), F.lit(1))).alias("ord", "href"))


def browse_links(links: DataFrame) -> DataFrame:
    """page_url, name, url, kind (folder or file) of links below the page; links back are left out, repeated ones kept once."""
    full = join(F.col("page_url"), F.col("href"))
    at = links.where((F.col("href") != "") & ~F.col("label").isin("..", "⬅ Back") & (F.lower("label") != "back")).withColumn("url", full)
    path = F.regexp_replace(path_of(F.col("url")), "/+$", "")
    here = F.regexp_replace(path_of(F.col("page_url")), "/+$", "")
    kind = F.when(F.contains(path, F.lit("/browse")), F.when(path.startswith(F.concat(here, F.lit("/"))), "folder")).when(is_file_link(path), "file")
    return at.select("page_url", clean_name(basename(unquote(path)), MISSING_FILTER_NAME).alias("name"), "url", kind.alias("kind")).where("kind is not null").distinct()


def walk(edges: DataFrame, roots: DataFrame, pages: int | None = None) -> DataFrame:
    """node, rank, depth of all that can be reached along edges (parent, child) from roots (node, rank), however deep.

    Roots of a lower rank go first, as aliases are searched in their order: what they have visited is not visited again, nor passed through, by
    those after them. `depth` is the least from a node's own roots. With `pages` each rank's walk ends after so many nodes, by depth and then by name,
    and a warning tells that it was cut; what it has left is open to the next.

    Each round joins the frontier with the edges, keeps what is new and stores it; what was found is stored anew as one table only when
    there are as many tables as MOST_TABLES, so plans stay short and nothing is copied each round. Ranks are a few (the aliases of a setting).
    """
    starts = cut(roots.groupBy("node").agg(F.min("rank").cast("int").alias("rank")))
    found: list[DataFrame] = []
    for (rank,) in starts.select("rank").distinct().orderBy("rank").collect():
        frontier = starts.where(F.col("rank") == rank).select("node")
        total = 0
        for depth in count():
            if found:
                frontier = frontier.join(reduce(DataFrame.unionByName, found).select("node"), "node", "left_anti")
            frontier = cut(frontier.select("node", F.lit(rank).alias("rank"), F.lit(depth).alias("depth")))
            new = frontier.count()
            if not new:
                break
            if pages is not None and total + new > pages:
                logger("fieldloom.links").warning("walk of rank %d cut after %d of at least %d nodes", rank, pages, total + new)
                found.append(cut(frontier.orderBy("node").limit(pages - total)))
                break
            total += new
            found.append(frontier)
            if len(found) > MOST_TABLES:
                found = [cut(reduce(DataFrame.unionByName, found))]
            frontier = frontier.select(F.col("node").alias("parent")).join(edges, "parent").select(F.col("child").alias("node")).distinct()
    return reduce(DataFrame.unionByName, found) if found else starts.select("node", "rank", F.lit(0).alias("depth"))


def reachable(edges: DataFrame, roots: DataFrame, pages: int | None = None) -> DataFrame:
    """node, depth: the same from roots (node) that are all alike."""
    return walk(edges, roots.select("node", F.lit(0).alias("rank")), pages).drop("rank")


def alias_roots(spark: SparkSession, aliases: list[str], base: str = "") -> DataFrame:
    """node and rank of the browse pages where the walks of aliases begin, in the order in which aliases are tried."""
    return spark.createDataFrame([(f"{base.rstrip('/')}/v/{a}/browse", i) for i, a in enumerate(dict.fromkeys(aliases))], "node string, rank int")


def locate(files: DataFrame, wanted: DataFrame, each: bool = False) -> DataFrame:
    """name, url of the first file of each wanted name, in any case: by priority, then depth, then address. With `each`, the first one of every
    priority, and this. A file is named by the end of its address and, where `files` has a `label`, by its anchor's text."""
    asked = wanted.select(folded(F.col("name")).alias("key"), F.col("name").alias("asked")).distinct()
    tail = folded(basename(unquote(path_of(F.col("url")))))
    names = F.array(tail, folded(strip(F.col("label")))) if "label" in files.columns else F.array(tail)
    found = files.withColumn("key", F.explode(F.array_distinct(F.filter(names, lambda x: x.isNotNull() & (x != "")))))
    by = ["asked", "priority"] if each else ["asked"]
    return found.join(asked, "key").groupBy(*by).agg(F.min_by("url", F.struct("priority", "depth", "url")).alias("url")).withColumnRenamed("asked", "name")


def direct_urls(wanted: DataFrame, base: str, aliases: list[str]) -> DataFrame:
    """Where each name would lie directly, for each alias in the order they are tried."""
    tried = F.explode(F.array(*(F.struct(F.lit(i).alias("priority"), F.lit(a).alias("alias")) for i, a in enumerate(aliases))))
    return wanted.select("name", tried.alias("a")).select("name", "a.priority", F.concat(F.lit(base.rstrip("/") + "/v/"), F.col("a.alias"), F.lit("/files/"), quote(F.col("name"))).alias("url"))


def fetched(wanted: DataFrame, pages: DataFrame) -> DataFrame:
    """html of each url, looked up with a slash at its end first, then without, and `form`, how it was found. Pages are joined once, by their address without
    this slash; only what was found of both forms is compared."""
    there = pages.where("html is not null").select(F.regexp_replace("url", "/$", "").alias("__bare"), F.col("url").alias("form"), "html")
    both = wanted.withColumn("__bare", F.regexp_replace("url", "/+$", "")).join(there, "__bare", "left").withColumn("__slash", F.coalesce(F.endswith("form", F.lit("/")), F.lit(False)))
    return both.withColumn("__any", F.max("__slash").over(Window.partitionBy("__bare"))).where(F.col("__slash") == F.col("__any")).drop("__bare", "__slash", "__any")


__all__ = ["alias_roots", "anchors", "anchors_of", "browse_links", "direct_urls", "fetched", "hrefs", "is_folder_link", "locate", "reachable", "walk"]
