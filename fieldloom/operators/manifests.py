"""Manifests of sampled frames, and names that do not collide."""

from __future__ import annotations

import os
import uuid
from itertools import count

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import stem

# The columns of a manifest.
COLUMNS = ("local_path", "source_url", "alias", "continent", "country", "state", "city", "day_night", "vehicle", "video_id", "file_name")


def without_collisions(files: DataFrame, name: str, order: list[str], out: str = "local_name", taken: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """Adds `out`: the first free one of the name, the name with _1, with _2, ... for each row, in the rows' order.

    `taken` (column `name`) are names that are not free. The first row that has a name keeps it if it is free, so rows with a suffix as part of
    their own name are not given to others. Free numbers are the gaps between taken ones: before the i-th taken number t (from 0) there are
    t - i free ones, so the k-th row gets k + (taken numbers with t - i <= k). One window over each name's rows and taken numbers: rows of one name are
    numbered in one task, as those of a sample can be. Names are dealt to `tasks` tasks, or to the session's number of them; a task sorts all rows of its names.
    """
    dealt = lambda rows, key: rows.repartition(tasks, key) if tasks else rows
    base, dot = (lambda c: stem(c)), (lambda c: F.substr(c, F.length(stem(c)) + 1))
    pattern = r"\A(.*)_(0|[1-9][0-9]{0,17})\z"
    names = files.select(F.col(name).alias("__own"))
    blocked = (names if taken is None else names.unionByName(taken.select(F.col("name").alias("__own")))).where("__own is not null").distinct()
    # a name blocks its own number in the family of the name without the suffix; only names that are taken block number 0
    family = F.concat(F.regexp_extract(base(F.col("__own")), pattern, 1), dot(F.col("__own")))
    number = F.regexp_extract(base(F.col("__own")), pattern, 2).try_cast("long")
    suffixed = blocked.where(base(F.col("__own")).rlike(pattern)).select(family.alias("__f"), number.alias("__t")).where("__t > 0")
    numbers = suffixed if taken is None else suffixed.unionByName(taken.where("name is not null").select(F.col("name").alias("__f"), F.lit(0).cast("long").alias("__t")).distinct())
    numbers = numbers.join(names.distinct(), F.col("__f") == F.col("__own"), "left_semi")
    before = numbers.withColumn("__at", F.col("__t") - F.row_number().over(Window.partitionBy("__f").orderBy("__t")) + 1)
    kth = F.row_number().over(Window.partitionBy(name).orderBy(*order)).cast("long") - 1
    rows = dealt(files, name).select(F.col(name).alias("__f"), kth.alias("__at"), F.lit(0).alias("__n"), F.struct(*files.columns).alias("__row"))
    gaps = before.select("__f", "__at", F.lit(1).alias("__n"), F.lit(None).cast(rows.schema["__row"].dataType).alias("__row"))
    passed = F.sum("__n").over(Window.partitionBy("__f").orderBy("__at", F.desc("__n")).rowsBetween(Window.unboundedPreceding, 0))
    told = dealt(rows.unionByName(gaps), "__f").withColumn("__k", F.col("__at") + passed).where("__row is not null")
    made = F.when(F.col("__k") == 0, F.col("__f")).otherwise(F.concat(base(F.col("__f")), F.lit("_"), F.col("__k").cast("string"), dot(F.col("__f"))))
    return told.select("__row.*", made.alias(out))


def manifest(frames: DataFrame, root: str, order: list[str], taken: DataFrame | None = None) -> DataFrame:
    """The manifest's columns, in their order, all text. `taken` (column `name`) are the names of files that lie below the root already."""
    named = without_collisions(frames, "filename", order, taken=taken)
    local = F.concat_ws("/", F.lit(root), F.col("local_name"))
    values = {"local_path": local, "source_url": F.col("url"), "file_name": F.col("local_name")}
    return named.select(*(values.get(c, F.col(c)).cast("string").alias(c) for c in COLUMNS))


def write_manifest(rows: DataFrame, path: str) -> str:
    """One CSV file with a header at the path, or with _1, _2, ... before its extension where that is taken; returns its name. Nothing is ever overwritten: a
    name is claimed by creating the file, which only one run can, and what was written is then moved there. On any store that Hadoop knows.
    A manifest has a row for each sampled frame, a bounded number, so one task writes it."""
    spark, beside = rows.sparkSession, f"{path}.{uuid.uuid4().hex}.tmp"
    rows.select(*COLUMNS).coalesce(1).write.option("header", True).option("encoding", "UTF-8").option("escape", '"').csv(beside)
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    store = hadoop.Path(path).getFileSystem(conf)
    try:
        written = [f.getPath() for f in store.listStatus(hadoop.Path(beside)) if f.getPath().getName().startswith("part-")]
        base, dot = os.path.splitext(path)
        claimed = next(p for n in count() if store.createNewFile(hadoop.Path(p := path if not n else f"{base}_{n}{dot}")))
        if written:
            over = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
            over[0] = hadoop.Options.Rename.OVERWRITE
            hadoop.FileContext.getFileContext(store.getUri(), conf).rename(store.makeQualified(written[0]), store.makeQualified(hadoop.Path(claimed)), over)
    finally:
        store.delete(hadoop.Path(beside), True)
    return claimed
