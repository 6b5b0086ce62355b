"""Positions stored along a curve that keeps near places together, so that a box reads few row groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from contrail.functions.grid import morton_code, morton_ranges
from contrail.operators.filters import within_bbox

PLACE = "place_code"


def write_positions(rows: DataFrame, path: str, files: int, also: str | None = None, row_group_bytes: int | None = None) -> None:
    """Write rows with ``lat`` and ``lon`` in the order of their places, in ``files`` files of one stretch of the curve
    each. Rows without a position are kept, in front. ``also`` is a column that splits places with very many rows over
    several files, as the ranges are cut by it too."""
    placed = rows.withColumn(PLACE, morton_code(F.col("lat"), F.col("lon")))
    order = [PLACE, *([also] if also else [])]
    writer = placed.repartitionByRange(files, *order).sortWithinPartitions(*order).write
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)


def within_bbox_stored(
    spark: SparkSession, path: str, lamin: float, lamax: float, lomin: float, lomax: float, most_ranges: int = 64,
) -> DataFrame:
    """Rows of such a folder inside the box, bounds included. The box is cut into stretches of the curve, which the scan
    compares with the bounds of every row group; the coordinates themselves decide."""
    rows = spark.read.parquet(path)
    ranges = morton_ranges(lamin, lamax, lomin, lomax, most_ranges)
    near = reduce(lambda a, b: a | b, [F.col(PLACE).between(low, high) for low, high in ranges], F.lit(False))
    return within_bbox(rows.where(near), lamin, lamax, lomin, lomax).drop(PLACE)
