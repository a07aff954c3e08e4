"""Points stored along a space-filling curve, so that a query for an area reads a small part of the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roadpulse.operators.grid import Grid

_BITS = 16
_MASKS = ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555))


def _spread(number: Column) -> Column:
    """The bits of a 16-bit number, each moved to twice its place."""
    for shift, mask in _MASKS:
        number = F.shiftleft(number, shift).bitwiseOR(number).bitwiseAND(F.lit(mask).cast("long"))
    return number


def curve_place(x: Column, y: Column, grid: Grid = Grid()) -> Column:
    """The place of a point on a Z-order curve over the grid's area; points outside go to its border.

    Points that are near on the curve are near on the map, so a stretch of it is a small area. A null
    coordinate has no place.
    """
    top, left = F.lit(grid.top), F.lit(grid.left)
    steps = (1 << _BITS) - 1
    across = (x - left) / F.lit(grid.width * grid.columns)
    down = (top - y) / F.lit(grid.height * grid.rows)
    cells = [F.floor(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * steps).cast("long") for share in (across, down)]
    place = _spread(cells[0]).bitwiseOR(F.shiftleft(_spread(cells[1]), 1))
    return F.when(x.isNotNull() & y.isNotNull(), place)


def write_clustered(
    points: DataFrame, path: str, grid: Grid = Grid(), x: str = "location_x", y: str = "location_y",
    rows_per_file: int = 1_000_000,
) -> None:
    """Write points in the order of the curve, in files of at most `rows_per_file` rows.

    Every file and row group then covers a small area, which its column statistics say; range
    filters such as `grid.within_bounds` skip the others when they scan the table.
    """
    placed = points.withColumn("__place", curve_place(F.col(x), F.col(y), grid))
    (placed.repartitionByRange("__place").sortWithinPartitions("__place").drop("__place")
     .write.option("maxRecordsPerFile", rows_per_file).parquet(path))
