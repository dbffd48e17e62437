"""An extraction run: from a mapping to frames in their places."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import basename
from ..operators.frames import resolve_videos
from ..operators.links import direct_urls, locate
from ..operators.segments import checked_videos
from ..sources.adapters import Decoder, Mover, Opener, Prober, Remover, Store, delete_videos, first_available, probe
from ..sources.folders import cut, once, shared_folder
from ..sources.frames_out import promote_folders, remove_left, stage_folders, whole_groups
from ..sources.inventory import add_video, remove_video, video_index
from ..sources.logs import logger
from ..sources.settings import Settings
from .extraction import GROUP, located_folders, plan_extraction
from .lookup import walked_files

REASONS = ("no videos", "bad time", "unequal times", "end before start", "no valid range")


@dataclass(frozen=True)
class Outside:
    """What a run needs from outside; see `sources.adapters`. Videos are stored and deleted by their path, frames by theirs."""

    fetch: Opener
    decode: Decoder
    probe: Prober
    store: Store
    move: Mover
    remove: Remover


@dataclass(frozen=True)
class Sources:
    """Where videos can be had: aliases in the order they are tried, and, if their browse pages are known, edges (parent, child, label) and roots
    (node, rank) of walks over them."""

    aliases: list[str] = field(default_factory=list)
    edges: DataFrame | None = None
    roots: DataFrame | None = None


@dataclass
class Run:
    """videos: for each video what was planned, how many frames are new, where it was had and what became of it; groups: planned and new frames of each;
    problems: of the mapping; index: the videos that are there after the run."""

    videos: DataFrame
    groups: DataFrame
    problems: DataFrame
    index: DataFrame


def available_videos(wanted: DataFrame, index: DataFrame, sources: Sources, outside: Outside, settings: Settings) -> DataFrame:
    """video_key, video, path, url and was_downloaded of each wanted video (video_key, video): from the index, by its name or its stem, else fetched
    from the first of its addresses that can be had, and stored. path is null if there is none. Names with `.` or `..` as a part are not fetched."""
    here = resolve_videos(wanted.groupBy("video_key").agg(F.min("video").alias("video")), "video", index)
    extension = F.when(F.lower("video").endswith(".mp4"), "").otherwise(".mp4")
    named = here.withColumn("name", F.concat(F.trim("video"), extension))
    absent = named.where(F.col("path").isNull() & ~F.col("name").rlike(r"(^|/)\s*\.{0,2}\s*(/|$)|\\")).select("name").distinct()
    root = settings.videos.rstrip("/")
    fetched = lambda tried: first_available(tried, outside.fetch, "name", outside.store, lambda name: f"{root}/{name}")
    had = cut(fetched(direct_urls(absent, settings.base_url, sources.aliases)))
    left = absent.join(had, "name", "left_anti")
    if sources.edges is not None and not left.isEmpty():  # only what has no direct address is walked for
        found = locate(walked_files(sources.edges, sources.roots, settings), left, each=True)
        had = had.unionByName(fetched(found))
    told = named.join(had, "name", "left")
    path = F.coalesce("path", F.when(F.col("url").isNotNull(), F.concat(F.lit(f"{root}/"), "name")))
    return told.select("video_key", "video", path.alias("path"), "url", F.col("url").isNotNull().alias("was_downloaded"))


def indexed(index: DataFrame, videos: DataFrame) -> DataFrame:
    """The index with the videos that were fetched."""
    return add_video(index, videos.where("was_downloaded").select("path", basename(F.col("path")).alias("file_name")))


def run_extraction(
    mapping: DataFrame, existing: DataFrame, files: DataFrame, settings: Settings, outside: Outside, sources: Sources, store: str | None = None, waves: int = 1
) -> Run:
    """Makes the frames of all incomplete groups: videos are found or fetched, decoded, their groups' frames made visible as a whole, and what was fetched
    is deleted after its last use.

    `existing` has the paths of frames that are there, `files` path and file_name of the videos. Videos are dealt to `waves`, one after the other, each
    with all its references, so no more than a wave's videos have to be held. Each step of a wave is stored as a table below `store` when it is
    whole; a run with the same `store` goes on behind the last whole step and fetches and decodes nothing twice. Steps that were broken off are
    repeated: fetching and moving again does no harm. A video that cannot be had or read leaves its groups as they are.
    """
    spark = mapping.sparkSession
    folder = (store or f"{shared_folder(spark)}/extraction-{uuid.uuid4().hex}").rstrip("/")
    step: Callable[[str, Callable[[], DataFrame]], DataFrame] = lambda name, make: once(spark, f"{folder}/{name}", make)
    # a run that goes on has to know which videos were there when it began
    index = video_index(step("files", lambda: files.select("path", "file_name")))
    seen: list[Observation] = []
    checked = step("mapping", lambda: _counted(checked_videos(mapping), seen))
    for counts in seen:  # filled in the pass in which the rows were stored
        logger("fieldloom.run").info("mapping, rows with problems: %s", counts.get)
    plan = plan_extraction(mapping, existing, index, settings, checked)
    todo = step("todo", lambda: plan.folders.select(*GROUP, "video_key", "video", "folder", "ranges", "total"))
    done = [_wave(todo.where(F.pmod(F.xxhash64("video_key"), F.lit(waves)) == w), index, settings, outside, sources, lambda name, make, w=w: step(f"wave-{w}-{name}", make)) for w in range(waves)]
    videos, groups = (reduce(DataFrame.unionByName, part) for part in zip(*done))
    _tell(videos)
    left = remove_video(indexed(index, videos), videos.where("outcome = 'deleted'").select("path"))
    return Run(videos, groups, plan.problems, left)


def _wave(todo: DataFrame, index: DataFrame, settings: Settings, outside: Outside, sources: Sources, step: Callable[[str, Callable[[], DataFrame]], DataFrame]) -> tuple[DataFrame, DataFrame]:
    wanted = todo.where("video_key != ''").select("video_key", "video")
    videos = step("videos", lambda: available_videos(wanted, index, sources, outside, settings))
    now = indexed(index, videos)
    fps = step("sizes", lambda: probe(videos.where("path is not null").select("path"), outside.probe)).where("fps > 0")
    own, seconds = [*GROUP, "video_key"], settings.interval_seconds
    staged = step("staged", lambda: stage_folders(located_folders(todo, now, fps), own, seconds, outside.decode, outside.store, f"{settings.frames.rstrip('/')}/.staged"))
    told = whole_groups(staged, GROUP)  # follows from the stored table, which is what commits
    promoted = step("promoted", lambda: promote_folders(told.where("whole"), own, seconds, outside.move))
    torn = told.where("not whole").select("folder", "at", "starts", "ends")
    unmoved = staged.join(promoted.where("left").select("folder", "at").distinct(), ["folder", "at"], "left_semi").select("folder", "at", "starts", "ends")
    step("left", lambda: remove_left(torn.unionByName(unmoved), seconds, outside.remove))
    deleted = step("deleted", lambda: delete_videos(videos.withColumn("mine", F.col("was_downloaded") & F.lit(settings.delete_downloaded_videos)), outside.remove, downloaded="mine"))
    planned, new = todo.select(*own, F.col("total").alias("planned"), F.lit(0).cast("bigint").alias("new")), promoted.select(*own, F.lit(0).cast("bigint").alias("planned"), "new")
    groups = step("groups", lambda: planned.unionByName(new).groupBy(*own).agg(F.sum("planned").alias("planned"), F.sum("new").alias("new")))
    per_video = groups.groupBy("video_key").agg(F.sum("planned").alias("planned"), F.sum("new").alias("new"))
    return step("done", lambda: per_video.join(videos, "video_key", "left").join(deleted, "path", "left")), groups


def _counted(checked: DataFrame, seen: list[Observation]) -> DataFrame:
    seen.append(Observation("mapping"))
    return checked.observe(seen[-1], *(F.count_if(F.array_contains("problems.reason", r)).alias(r) for r in REASONS))


def _tell(videos: DataFrame) -> None:
    """What a run has done, in its log."""
    told = videos.agg(F.count("*").alias("videos"), F.sum("planned").alias("planned"), F.sum("new").alias("new"), F.count_if("was_downloaded").alias("fetched"), F.count_if(F.col("path").isNull()).alias("absent"), F.count_if(F.col("outcome") == "deleted").alias("deleted")).first()
    logger("fieldloom.run").info("videos: %d, %d fetched, %d absent, %d deleted; frames: %d of %d", told.videos, told.fetched, told.absent, told.deleted, told.new or 0, told.planned or 0)
