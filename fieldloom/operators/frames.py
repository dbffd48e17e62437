"""Frame plans: what has to be there, what is missing, and when a video is used for the last time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip, video_key


def align_by_position(values: DataFrame, keys: list[str], pos: str, n: str, columns: dict[str, str], count: str) -> DataFrame:
    """Rows of parallel lists that lie exploded: each row gets the value at its position, or the list's last one.

    `count` is the column with the list's own length. A window over the rows of a key, so one shuffle and no join.
    """
    own = Window.partitionBy(*keys).orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    at = F.least(F.col(pos), F.least(F.col(n), F.col(count)) - 1)
    return values.select("*", *(F.get(F.collect_list(F.struct(c)).over(own), at.cast("int"))[c].alias(out) for c, out in columns.items()))


def fresh_ranges(ranges: DataFrame, keys: list[str], start: str, end: str, step: int) -> DataFrame:
    """The ranges, of which each begins behind the times that ranges before it give to the same key; what gives nothing new goes.

    Ranges whose starts differ by whole steps have their times on one grid, so the last time so far tells what is new. One window over the ranges; the
    times themselves are neither held nor compared.
    """
    if step <= 0:
        raise ValueError("the interval must be positive")
    first, wide = F.col(start).cast("bigint"), F.lit(step).cast("bigint")
    own = Window.partitionBy(*keys, F.pmod(first, wide)).orderBy(first).rowsBetween(Window.unboundedPreceding, -1)
    last = first + F.expr(f"(cast(`{end}` as bigint) - cast(`{start}` as bigint)) div {step}L") * wide
    valid = ranges.where(F.col(end) >= F.col(start))
    told = valid.withColumn("__begin", F.greatest(first, F.max(last).over(own) + wide)).where(F.col("__begin") <= F.col(end))
    return told.withColumn(start, F.col("__begin")).drop("__begin")


def trimmed(ranges: Column, step: int) -> Column:
    """What `fresh_ranges` leaves of valid ranges (start, end) that lie in a list."""
    if step <= 0:
        raise ValueError("the interval must be positive")
    wide = F.lit(step).cast("bigint")
    told = F.array_sort(F.transform(ranges, lambda x: F.struct(F.pmod(x["start"], wide).alias("grid"), x["start"].alias("start"), x["end"].alias("end"))))
    none = F.struct(F.array().cast("array<struct<start:bigint,end:bigint>>").alias("kept"), F.lit(None).cast("bigint").alias("grid"), F.lit(None).cast("bigint").alias("next"))

    def add(had: Column, x: Column) -> Column:
        begin = F.when(had["grid"] == x["grid"], F.greatest(x["start"], had["next"])).otherwise(x["start"])
        new = begin <= x["end"]
        kept = F.when(new, F.concat(had["kept"], F.array(F.struct(begin.alias("start"), x["end"].alias("end"))))).otherwise(had["kept"])
        after = F.when(new, x["end"] - F.pmod(x["end"] - begin, wide) + wide).otherwise(had["next"])
        return F.struct(kept.alias("kept"), x["grid"].alias("grid"), after.alias("next"))

    return F.aggregate(told, none, add, lambda had: had["kept"])


def n_times(ranges: Column, step: int) -> Column:
    """How many times trimmed ranges have."""
    return F.aggregate(ranges, F.lit(0).cast("bigint"), lambda n, x: n + F.floor((x["end"] - x["start"]) / step) + 1)


def existing_times(existing: DataFrame) -> DataFrame:
    """folder and there, the distinct times of the frames in it, of paths as the plan makes them; other paths are of no frames."""
    name = F.substring_index("path", "/", -1)
    split = existing.select("path", F.expr("left(path, char_length(path) - char_length(substring_index(path, '/', -1)) - 1)").alias("folder"), F.substring_index(F.substring_index(name, "_", -1), ".", 1).try_cast("bigint").alias("t"))
    planned = F.concat("folder", F.lit("/"), F.substring_index("folder", "/", -1), F.lit("_"), F.col("t").cast("string"), F.lit(".png"))
    return split.where(F.col("path") == planned).groupBy("folder").agg(F.collect_set("t").alias("there"))


def counted_folders(folders: DataFrame, existing: DataFrame, step: int) -> DataFrame:
    """Adds total and existing frames of each folder's ranges. Folders are dealt once, with their times as ranges; so are the existing times, as lists."""
    times = F.flatten(F.transform("ranges", lambda r: F.sequence(r["start"], r["end"], F.lit(step).cast("bigint"))))
    there = F.when(F.col("there").isNull(), F.lit(0)).otherwise(F.size(F.array_intersect(times, F.col("there")))).cast("bigint")
    told = folders.withColumn("total", n_times(F.col("ranges"), step)).join(existing_times(existing), "folder", "left")
    return told.withColumn("existing", there).select(*folders.columns, "total", "existing")


def each_time(start: str, end: str, step: int) -> Column:
    return F.explode(F.sequence(F.col(start).cast("bigint"), F.col(end).cast("bigint"), F.lit(step).cast("bigint")))


def frame_times(ranges: DataFrame, keys: list[str], start: str, end: str, step: int, out: str = "t") -> DataFrame:
    """Every time of every range, once for each key. Ranges that are empty give none."""
    return fresh_ranges(ranges.select(*keys, start, end), keys, start, end, step).select(*keys, each_time(start, end, step).alias(out))


def _told(planned: DataFrame, existing: DataFrame, group: list[str], key: list[str]) -> DataFrame:
    """Planned frames with `__e`, whether each exists; dealt by the group once, both sides together."""
    flagged = planned.select(*key, F.lit(True).alias("__planned")).unionByName(existing.select(*key, F.lit(False).alias("__planned")))
    return flagged.repartition(*group).groupBy(*key).agg(F.bool_or("__planned").alias("__p"), F.bool_or(~F.col("__planned")).alias("__e")).where("__p")


def existing_counts(planned: DataFrame, existing: DataFrame, group: list[str], key: list[str]) -> DataFrame:
    """total and existing frames of each group; planned frames are distinct.

    Where the group is part of the frame's key, both sides are dealt by the group once, and frames and groups are counted where they
    then are. Otherwise existing frames are joined by key and the counts are summed before they move.
    """
    if set(group) <= set(key):
        return _told(planned, existing, group, key).groupBy(*group).agg(F.count("*").alias("total"), F.count_if("__e").alias("existing"))
    there = existing.select(*key).distinct().withColumn("there", F.lit(1))
    return planned.join(there, key, "left").groupBy(*group).agg(F.count("*").alias("total"), F.count("there").alias("existing"))


def pending(counts: DataFrame) -> DataFrame:
    """Groups that are not complete. All of their frames are made anew."""
    return counts.where("existing < total")


def pending_frames(planned: DataFrame, existing: DataFrame, group: list[str], key: list[str]) -> DataFrame:
    """The frames of incomplete groups, each once; a group's missing frames are counted beside its frames, so nothing is planned twice. Where the group
    is part of the frame's key, they are counted where they were dealt to."""
    missing = lambda absent: F.count_if(absent).over(Window.partitionBy(*group))
    if set(group) <= set(key) and set(planned.columns) == set(key):
        told = _told(planned, existing, group, key).withColumn("__missing", missing(~F.col("__e")))
    else:
        there = existing.select(*key).distinct().withColumn("__e", F.lit(True))
        told = planned.join(there, key, "left").withColumn("__missing", missing(F.col("__e").isNull()))
    return told.where(F.col("__missing") > 0).select(*planned.columns)


def use_counts(references: DataFrame, video: str) -> DataFrame:
    """How often each video is referred to, blank references aside."""
    keyed = references.select(video_key(F.col(video)).alias("video_key"))
    return keyed.where("video_key != ''").groupBy("video_key").agg(F.count("*").alias("uses"))


def remaining_uses(references: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Adds remaining: uses of the key that follow this one; 0 at its last."""
    mine = Window.partitionBy(key)
    return references.withColumn("remaining", F.count("*").over(mine) - F.row_number().over(mine.orderBy(*order)))


def deletable(uses: DataFrame, downloaded: str = "was_downloaded") -> DataFrame:
    """Adds deletable: at its last use, and only if this run has fetched it."""
    return uses.withColumn("deletable", (F.col("remaining") == 0) & F.col(downloaded))


def resolve_videos(references: DataFrame, ref: str, index: DataFrame) -> DataFrame:
    """Adds path: the file of the reference's name, else of its stem, in any case; null if there is none."""
    name = references.withColumn("__full", F.lower(strip(F.col(ref)))).withColumn("__stem", video_key(F.col(ref)))
    full, short = index.select(F.col("key").alias("__full"), F.col("path").alias("__p1")), index.select(F.col("key").alias("__stem"), F.col("path").alias("__p2"))
    return name.join(full, "__full", "left").join(short, "__stem", "left").withColumn("path", F.coalesce("__p1", "__p2")).drop("__full", "__stem", "__p1", "__p2")
