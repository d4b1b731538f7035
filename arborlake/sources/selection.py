"""Selections of neurons as JSON files: one object a line, with skeleton_id and whatever else was chosen."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def to_selection(neurons: DataFrame, folder: str, colour: str = "#ffff00", opacity: float = 1.0) -> None:
    """Writes the ids of ``neurons`` (skeleton_id) with a colour and an opacity."""
    neurons.select("skeleton_id", F.lit(colour).alias("color"), F.lit(opacity).alias("opacity")).write.mode("overwrite").json(folder)


def from_selection(spark: SparkSession, path: str) -> DataFrame:
    """(skeleton_id, color, opacity) of a selection; a file may also hold one array of objects."""
    return spark.read.schema("skeleton_id long, color string, opacity double").option("multiLine", path.endswith(".json")).json(path).where("skeleton_id IS NOT NULL").distinct()
