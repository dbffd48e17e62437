"""Codes of mapping tables and inventories, and the labels that they stand for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels by code.
VEHICLES = {0: "Car", 1: "Bus", 2: "Truck", 3: "Two wheeler", 4: "Bicycle", 5: "Automated car", 6: "Electric scooter", 7: "Monowheel unicycle", 8: "Emergency vehicle", 9: "Automated bus", 10: "Automated truck", 11: "Automated two wheeler", 12: "Non electric scooter", 13: "Pedestrian"}
TIMES = {0: "Day", 1: "Night"}
IMAGE_EXTENSIONS = ("png", "jpg", "jpeg", "webp")


def label_of(code: Column, labels: dict[int, str]) -> Column:
    """The label of an integer code; null where there is none. A literal map, so no join and no shuffle."""
    table = F.create_map(*(F.lit(x).cast("long") if isinstance(x, int) else F.lit(x) for pair in labels.items() for x in pair))
    return F.try_element_at(table, code.cast("long"))
