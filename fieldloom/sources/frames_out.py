"""Frames of videos, made visible group by group: all of a group's frames or none.

Two phases. First every task puts the frames that it decodes below the name of its own attempt, where nobody looks for them, and tells which it
has; a frame goes as soon as it is decoded. Then the groups of which every planned frame is there are written down, once; this table is
the commit. What it names is moved to its place, which may be repeated as often as need be: what is moved already is no error. A task that
was retried, or an executor that was lost, leaves files below an attempt's name only.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import frame_index
from .adapters import Decoder, Mover, Remover, Store

STAGED = "video_path string, path string, at string, reason string"
COLUMNS = ["video_path", "path", "at", "reason"]
#: Frames of a video that one task decodes at most, about an hour.
STRETCH = 100_000
#: Rows that are told at once, about.
BATCH = 1_000


def _decoded(video: str, paths: dict[int, list[str]], decode: Decoder, store: Store, attempt: str) -> tuple[set[str], str]:
    """The paths of those frames that were decoded and put below an attempt's name, and why others were not."""
    done: set[str] = set()
    try:
        got = decode(video, sorted(paths))
        for frame, content in got.items() if isinstance(got, dict) else got:
            for path in paths.get(int(frame), ()):
                store(f"{attempt}/{path}", content)
                done.add(path)
    except OSError as e:
        return done, f"{type(e).__name__}: {e}"
    return done, "not decoded"


def stage(plan: DataFrame, decode: Decoder, store: Store, below: str = ".staged") -> DataFrame:
    """video_path, path, at and reason of each planned frame: where it was put, or why it was not. Columns of the plan: video_path, frame, path.

    A stretch of a video is decoded by one task, in one pass, and its frames are not held.
    """

    def put(video: str, rows: list[tuple[int, str]]) -> list[tuple[str, str, str | None, str | None]]:
        attempt = f"{below}/{uuid.uuid4().hex}"
        paths: dict[int, list[str]] = {}
        for frame, path in rows:
            paths.setdefault(int(frame), []).append(path)
        done, reason = _decoded(video, paths, decode, store, attempt)
        return [(video, p, f"{attempt}/{p}" if p in done else None, None if p in done else reason) for _, p in rows]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, rows = None, []  # the stretch that is read; it may go on in the next batch
        for pdf in batches:
            told = []
            for video, stretch, frame, path in zip(pdf["video_path"], pdf["stretch"], pdf["frame"], pdf["path"]):
                if (video, stretch) != own:
                    if rows:
                        told += put(own[0], rows)
                    own, rows = (video, stretch), []
                rows.append((frame, path))
            yield pd.DataFrame(told, columns=COLUMNS)
        if rows:
            yield pd.DataFrame(put(own[0], rows), columns=COLUMNS)

    rows = plan.select("video_path", "frame", "path", F.floor(F.col("frame") / STRETCH).alias("stretch"))
    return rows.repartition("video_path", "stretch").sortWithinPartitions("video_path", "stretch").mapInPandas(run, STAGED)


def stage_folders(plan: DataFrame, group: list[str], step: int, decode: Decoder, store: Store, below: str = ".staged") -> DataFrame:
    """The same for folders whose frames are told by ranges (start, end) of times: for each of the folder's stretches how many frames are planned and
    missing, where those that are there were put, as ranges too, and why others were not. Columns of the plan: the group's, folder, ranges, video_path, fps.

    Names of frames are made in the task that decodes them; what is moved and stored grows with the folders.
    """
    wide, most = F.lit(step).cast("bigint"), STRETCH
    last = F.array_max(F.transform("ranges", lambda r: r["end"] - F.pmod(r["end"] - r["start"], wide)))
    first = F.array_min("ranges.start")
    at = lambda t: F.floor(frame_index(t, F.col("fps")) / most)
    parts = plan.where(F.size("ranges") > 0).withColumn("stretches", F.sequence(at(first), at(last)))
    each = parts.select("video_path", F.explode("stretches").alias("stretch"), "fps", F.size("stretches").alias("parts"), *group, "folder", F.col("ranges.start").alias("starts"), F.col("ranges.end").alias("ends"))

    def times_of(fps: float, starts: Iterable[int], ends: Iterable[int], stretch: int) -> Iterator[tuple[int, int]]:
        """Times and frames of the ranges that lie in a stretch."""
        low, high = (stretch * most - 1) / fps, ((stretch + 1) * most + 1) / fps
        for s, e in zip(starts, ends):
            for t in range(s + max(0, math.floor((low - s) / step)) * step, min(e, math.ceil(high)) + 1, step):
                if (frame := round(t * fps)) // most == stretch:
                    yield t, frame

    def put(video: str, stretch: int, rows: list[tuple], attempt: str) -> list[tuple]:
        paths: dict[int, list[str]] = {}
        own = []
        for _, _, fps, folder, starts, ends in rows:
            before, mine = f"{folder}/{folder.rsplit('/', 1)[-1]}_", []
            for t, frame in times_of(fps, starts.tolist(), ends.tolist(), stretch):
                mine.append((t, path := f"{before}{t}.png"))
                if path not in (same := paths.setdefault(frame, [])):
                    same.append(path)
            own.append(mine)
        done, reason = _decoded(video, paths, decode, store, attempt) if paths else (set(), None)
        told = []
        for (key, n, _, folder, _, _), mine in zip(rows, own):
            there = [t for t, path in mine if path in done]
            lost = len(mine) - len(there)
            told.append((*key, folder, n, len(mine), lost, attempt if there else None, *_runs(there, step), reason if lost else None))
        return told

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, rows, told = None, [], []  # the stretch that is read; it may go on in the next batch
        attempt, n = f"{below}/{uuid.uuid4().hex}", 0
        for pdf in batches:
            keys = zip(*(pdf[c] for c in group))
            for video, stretch, *row in zip(pdf["video_path"], pdf["stretch"], keys, *(pdf[c] for c in ("parts", "fps", "folder", "starts", "ends"))):
                if (video, stretch) != own:
                    if rows:
                        told += put(*own, rows, f"{attempt}-{n}")
                        n += 1
                    own, rows = (video, stretch), []
                    if len(told) >= BATCH:
                        yield pd.DataFrame(told, columns=columns)
                        told = []
                rows.append(row)
        if rows:
            told += put(*own, rows, f"{attempt}-{n}")
        if told:
            yield pd.DataFrame(told, columns=columns)

    columns = [*group, "folder", "parts", "planned", "missing", "at", "starts", "ends", "reason"]
    kinds = [*(f"{c} {plan.schema[c].dataType.simpleString()}" for c in group), "folder string, parts int, planned bigint, missing bigint, at string, starts array<bigint>, ends array<bigint>, reason string"]
    return each.repartition("video_path", "stretch").sortWithinPartitions("video_path", "stretch").mapInPandas(run, ", ".join(kinds))


def _runs(times: list[int], step: int) -> tuple[list[int], list[int]]:
    """Starts and ends of the runs of times that follow each other by steps."""
    starts = [t for i, t in enumerate(times) if not i or t - times[i - 1] != step]
    ends = [t for i, t in enumerate(times) if i + 1 == len(times) or times[i + 1] - t != step]
    return starts, ends


def whole_groups(staged: DataFrame, group: list[str]) -> DataFrame:
    """Adds whole: whether no frame of the group is missing. Most groups are in one stretch and know it themselves; only the others are put together."""
    several = F.sum("missing").over(Window.partitionBy(*group)) == 0
    return staged.where("parts = 1").withColumn("whole", F.col("missing") == 0).unionByName(staged.where("parts > 1").withColumn("whole", several))


def _each_path(pdf: pd.DataFrame, step: int) -> Iterator[list[str]]:
    """For each row the paths of its frames, without what they are below."""
    for folder, starts, ends in zip(pdf["folder"], pdf["starts"], pdf["ends"]):
        before = f"{folder}/{folder.rsplit('/', 1)[-1]}_"
        yield [f"{before}{t}.png" for s, e in zip(starts, ends) for t in range(s, e + 1, step)]


def promote_folders(committed: DataFrame, group: list[str], step: int, move: Mover) -> DataFrame:
    """The same for staged folders: the group's columns, folder, at, new, the number of frames that are in their places, and whether others are left."""

    def one(source: str, path: str) -> bool:
        try:
            return bool(move(source, path))
        except OSError:
            return False

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            done = [[one(f"{at}/{p}", p) for p in paths] for at, paths in zip(pdf["at"], _each_path(pdf, step))]
            yield pdf[[*group, "folder", "at"]].assign(new=[sum(d) for d in done], left=[not all(d) for d in done])

    kinds = [*(f"{c} {committed.schema[c].dataType.simpleString()}" for c in group), "folder string, at string, new bigint, left boolean"]
    return committed.select(*group, "folder", "at", "starts", "ends").mapInPandas(run, ", ".join(kinds))


def remove_left(staged: DataFrame, step: int, remove: Remover) -> DataFrame:
    """folder, at, outcome and number of the staged frames of folders that were not moved to their places."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            told = []
            for folder, at, paths in zip(pdf["folder"], pdf["at"], _each_path(pdf, step)):
                done: Counter = Counter()
                for p in paths:
                    try:
                        done["deleted" if remove(f"{at}/{p}") else "missing"] += 1
                    except OSError:
                        done["failed"] += 1
                told += [(folder, at, outcome, n) for outcome, n in done.items()]
            yield pd.DataFrame(told, columns=["folder", "at", "outcome", "n"])

    return staged.where("at is not null").select("folder", "at", "starts", "ends").mapInPandas(run, "folder string, at string, outcome string, n bigint")


def complete_groups(plan: DataFrame, staged: DataFrame, group: list[str]) -> DataFrame:
    """The group's columns, path and at of the frames of groups that are there as a whole: what is to be committed."""
    told = plan.select(*group, "path").distinct().join(staged.select("path", "at"), "path", "left")
    whole = told.groupBy(*group).agg(F.count_if(F.col("at").isNull()).alias("missing")).where("missing = 0").select(*group)
    return told.join(whole, group, "left_semi").select(*group, "path", "at")


def promote(committed: DataFrame, move: Mover) -> DataFrame:
    """path and whether it is in its place, for each committed frame. Moves that were done already count as done."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            done = []
            for at, path in zip(pdf["at"], pdf["path"]):
                try:
                    done.append(bool(move(at, path)))
                except OSError:
                    done.append(False)
            yield pd.DataFrame({"path": pdf["path"], "stored": done})

    return committed.select("at", "path").mapInPandas(run, "path string, stored boolean")


def remove_staged(staged: DataFrame, promoted: DataFrame, remove: Remover) -> DataFrame:
    """at and outcome of staged frames that were not moved to their places."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            done = []
            for at in pdf["at"]:
                try:
                    done.append("deleted" if remove(at) else "missing")
                except OSError:
                    done.append("failed")
            yield pd.DataFrame({"at": pdf["at"], "outcome": done})

    left = staged.where("at is not null").join(promoted.where("stored").select("path"), "path", "left_anti")
    return left.select("at").distinct().mapInPandas(run, "at string, outcome string")
