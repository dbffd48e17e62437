"""From a mapping table to the frames that have to be made."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import frame_index, video_key
from ..operators.frames import counted_folders, deletable, pending, remaining_uses, resolve_videos
from ..operators.segments import checked_videos, folder_frames, mapping_folders, problem_rows, videos_of
from ..sources.settings import Settings

GROUP = ["row_num", "pos", "day_night", "vehicle"]


@dataclass
class Plan:
    """videos: every reference; frames: all planned frames; groups: counts of each group; todo: frames of incomplete groups; folders: the incomplete
    groups themselves, with their ranges; uses: what follows each reference; problems: what is wrong with the mapping, with its rows."""

    videos: DataFrame
    frames: DataFrame
    groups: DataFrame
    todo: DataFrame
    folders: DataFrame
    uses: DataFrame
    problems: DataFrame


def plan_extraction(mapping: DataFrame, existing: DataFrame, index: DataFrame, settings: Settings, checked: DataFrame | None = None) -> Plan:
    """`existing` has the paths of frames that are there, `index` the videos (key, path). Complete groups need no video at all. `checked` may be
    given as `checked_videos(mapping)` where it has been stored, so that frames and problems come from one pass over the mapping. Rows have numbers of their
    own, so a group is one folder; folders and ranges are counted and moved, frames are told where they are asked for."""
    told = checked_videos(mapping) if checked is None else checked
    videos = videos_of(mapping) if checked is None else checked.where("pos is not null").drop("problems")
    folders = mapping_folders(videos, settings.frames, settings.interval_seconds, settings.strict_times)
    counted = counted_folders(folders, existing, settings.interval_seconds)
    left = pending(counted)
    frames, todo = (folder_frames(f, settings.interval_seconds) for f in (folders, left))
    groups = counted.groupBy(*GROUP).agg(F.sum("total").alias("total"), F.sum("existing").alias("existing"))
    keyed = videos.select("row_num", "pos", "video", video_key(F.col("video")).alias("video_key")).where("video_key != ''")
    here = resolve_videos(keyed, "video", index).withColumn("was_downloaded", F.col("path").isNull() & F.lit(settings.delete_downloaded_videos))
    uses = deletable(remaining_uses(here, "video_key", ["row_num", "pos"]))
    return Plan(videos, frames, groups, todo, left, uses, problem_rows(told))


def decode_plan(todo: DataFrame, index: DataFrame, fps: DataFrame) -> DataFrame:
    """video_path, frame and path of each frame to decode. `fps` has path and fps of the videos."""
    located = resolve_videos(todo.withColumnRenamed("path", "frame_path"), "video", index).where("path is not null")
    return located.join(fps.select("path", "fps"), "path").select(F.col("path").alias("video_path"), frame_index(F.col("t"), F.col("fps")).alias("frame"), F.col("frame_path").alias("path"))


def located_folders(todo: DataFrame, index: DataFrame, fps: DataFrame) -> DataFrame:
    """The same for folders, with video_path and fps. Videos are looked up once for each name, not for each of their folders."""
    named = resolve_videos(todo.select("video").distinct(), "video", index).where("path is not null")
    return todo.join(named.join(fps.select("path", "fps"), "path").withColumnRenamed("path", "video_path"), "video")
