"""Folders that the cluster shares, and guards for those that are written to."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import IMAGE_EXTENSIONS


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; only where none is set and all runs in one process (tests) a local folder."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if sc.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="fieldloom-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder: computed once, and still there if executors are lost."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def once(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table at a path; made and written only where it is not there as a whole, so that a run that was stopped goes on where it was."""
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        make().write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def safe_parts(*parts: str) -> str:
    """A relative path of these parts; `.` and `..` are refused."""
    for p in parts:
        if p.strip() in (".", "..", "") or "/" in p or "\\" in p:
            raise ValueError(f"not a folder name: {p!r}")
    return "/".join(parts)


def refuse_precious(path: str) -> Path:
    """The path, unless it is the root, the home folder or the working folder (or above one of them)."""
    at = Path(path).resolve()
    for other in (Path("/"), Path.home(), Path(os.getcwd())):
        if at == other.resolve() or at in other.resolve().parents:
            raise ValueError(f"refused to clean {at}")
    return at


def own_outputs(spark: SparkSession, path: str) -> DataFrame:
    """path of the files below a folder that a sampling run leaves: images, images that were not finished, manifests. Listed by Spark, on any store that
    Hadoop knows, so without those whose name begins with `_` or `.`; files are not read. None if there is no such folder."""
    at, endings = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path), "|".join(IMAGE_EXTENSIONS)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], "path string")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    return files.where(F.lower("path").rlike(rf"\.(?:(?:{endings})(?:\.tmp)?|csv)$"))


def clean_output(spark: SparkSession, path: str, remove: Callable[[str], bool], remove_folder: Callable[[str], bool] | None = None) -> DataFrame:
    """path and outcome (deleted, missing, failed) of the files that earlier runs have left below a folder, deleted in tasks. Other files stay. With
    `remove_folder`, which deletes a folder if it is empty, folders that are left empty go too, the deepest first; that is not done for stores without folders.

    Refused are the root, the home folder and the working folder.
    """
    if "://" not in path:
        refuse_precious(path)
    outcome = lambda rows, how: cut(rows.mapInPandas(_removing(how), "path string, outcome string"))
    done = outcome(own_outputs(spark, path), remove)
    if remove_folder is not None:
        root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(root).toString()
        above = lambda rows: rows.where("outcome = 'deleted'").select(F.regexp_replace("path", "/[^/]*$", "").alias("path")).distinct().where(F.col("path").startswith(at.rstrip("/") + "/"))
        empty = above(done)
        while not empty.isEmpty():  # a round for each level of folders
            empty = above(outcome(empty, remove_folder))
    return done


def _removing(how: Callable[[str], bool]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            done = []
            for p in pdf["path"]:
                try:
                    done.append("deleted" if how(p) else "missing")
                except OSError:
                    done.append("failed")
            yield pd.DataFrame({"path": pdf["path"], "outcome": done})

    return run


def local_path(path: str) -> str:
    """The path in the file system that all tasks see of one that Spark lists with `file:`; such paths are not encoded."""
    return "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:/") else path


def remove_local(path: str) -> bool:
    try:
        os.remove(local_path(path))
        return True
    except FileNotFoundError:
        return False


def remove_empty_local(path: str) -> bool:
    """Deletes a folder if nothing is in it."""
    at = local_path(path)
    if not os.path.isdir(at) or os.listdir(at):
        return False
    os.rmdir(at)
    return True
