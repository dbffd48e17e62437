"""From a frame inventory to a manifest of a random sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import day_filter, vehicle_filter, video_filter
from ..functions.lists import wanted
from ..operators.filters import location_filters, matching, select_frames
from ..operators.manifests import manifest, write_manifest
from ..operators.sampling import balanced_sample, unbalanced_sample
from ..sources.folders import cut
from ..sources.settings import Settings


def _values(spark, values: tuple[str, ...], normal) -> list[str]:
    """A filter setting in the inventory's words. It is a setting, so the driver may know it."""
    row = spark.createDataFrame([(list(values),)], "v array<string>").select(wanted(F.col("v"), normal).alias("v")).first()
    return list(row.v or [])


def wanted_values(spark: SparkSession, settings: Settings) -> dict[str, list[str]]:
    """The values that the settings let through, by the inventory's column; none stands for all."""
    return {"day_night": _values(spark, settings.day_nights, day_filter), "vehicle": _values(spark, settings.vehicles, vehicle_filter), "video_id": _values(spark, settings.video_ids, video_filter)}


def plan_sample(inventory: DataFrame, settings: Settings) -> DataFrame:
    """The sampled frames. FileNotFoundError if no frame matches."""
    spark = inventory.sparkSession
    chosen = select_frames(matching(inventory, location_filters(spark, settings.location_tree)), *wanted_values(spark, settings).values())
    if settings.balanced:
        sample = balanced_sample(chosen, settings.num_images, settings.seed, settings.images_per_folder, settings.fill_images_per_folder, settings.folders_per_city)
    else:
        sample = unbalanced_sample(chosen, settings.num_images, settings.seed, settings.images_per_folder)
    if sample.isEmpty():
        raise FileNotFoundError("no matching frames")
    return sample


def sample_manifest(inventory: DataFrame, settings: Settings, taken: DataFrame | None = None) -> DataFrame:
    """The manifest of a sample; `taken` (column `name`) are names of files that lie in the output folder already."""
    return manifest(plan_sample(inventory, settings), settings.local_output_root, ["url"], taken)


def save_sample(inventory: DataFrame, settings: Settings, path: str, taken: DataFrame | None = None) -> DataFrame:
    """The manifest of a sample; also written to `path`, or to a free name beside it, if the settings ask for it."""
    rows = sample_manifest(inventory, settings, taken)
    if settings.save_manifest:
        rows = cut(rows)
        write_manifest(rows, path)
    return rows
