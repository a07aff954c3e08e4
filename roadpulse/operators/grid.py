"""A regular grid over the map: the table of cells, and the cell of a point by arithmetic."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roadpulse.sources.feeds import objects_of, opened_cells


@dataclass(frozen=True)
class Grid:
    """Bounds and cell sizes in degrees. The defaults are fixed values of the feed's area."""

    top: float = -33.2
    left: float = -71.0
    height: float = 0.1267
    width: float = 0.0667
    rows: int = 4
    columns: int = 8

    @property
    def cells(self) -> int:
        return self.rows * self.columns

    @property
    def label(self) -> str:
        return f"{self.columns}x{self.rows}"

    def bottom(self) -> float:
        return self.top - self.rows * self.height

    def right(self) -> float:
        return self.left + self.columns * self.width


def describe_cells(cells: DataFrame, grid: Grid = Grid(), index: str = "indice_celda") -> DataFrame:
    """Add bounds, labels and 1-based row and column to rows that have a cell index."""
    i = F.col(index)
    row, column = F.floor(i / grid.columns).cast("int"), (i % grid.columns).cast("int")
    return cells.withColumns({
        "top": F.lit(grid.top) - row * F.lit(grid.height),
        "left": F.lit(grid.left) + column * F.lit(grid.width),
        "zona_aproximada": F.concat(F.lit("Celda "), (i + 1).cast("string")),
        "fila": row + 1,
        "columna": column + 1,
        "total_celdas": F.lit(grid.cells),
        "grid_size": F.lit(grid.label),
    }).withColumns({
        "bottom": F.col("top") - F.lit(grid.height),
        "right": F.col("left") + F.lit(grid.width),
    })


def grid_cells(spark: SparkSession, grid: Grid = Grid()) -> DataFrame:
    cells = spark.range(grid.cells).select(F.col("id").cast("int").alias("indice_celda"))
    return describe_cells(cells, grid)


def cell_of(x: Column, y: Column, grid: Grid = Grid()) -> Column:
    """Index of the cell that holds a point, null outside. Top and left edges belong to a cell.

    Plain arithmetic on the row: a range join against the cells would be a nested loop.
    """
    row = F.floor((F.lit(grid.top) - y) / F.lit(grid.height))
    column = F.floor((x - F.lit(grid.left)) / F.lit(grid.width))
    inside = row.between(0, grid.rows - 1) & column.between(0, grid.columns - 1)
    return F.when(inside, row * grid.columns + column).cast("int")


def assign_cell(points: DataFrame, grid: Grid = Grid(), x: str = "location_x", y: str = "location_y") -> DataFrame:
    return points.withColumn("indice_celda", cell_of(F.col(x), F.col(y), grid))


def within_bounds(points: DataFrame, top: float, bottom: float, left: float, right: float,
                  x: str = "location_x", y: str = "location_y") -> DataFrame:
    """Points inside a box; simple range predicates, so a columnar scan can skip by them."""
    return points.filter(F.col(x).between(left, right) & F.col(y).between(bottom, top))


def counts_by_cell(points: DataFrame, grid: Grid = Grid()) -> DataFrame:
    return assign_cell(points, grid).groupBy("indice_celda").agg(F.count("*").alias("cantidad"))


def cells_with_counts(points: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """The whole grid with the number of points in each cell, empty cells included."""
    cells = grid_cells(points.sparkSession, grid)
    counts = counts_by_cell(points, grid)
    return cells.join(counts, "indice_celda", "left").fillna(0, ["cantidad"])


def feed_cell_counts(documents: DataFrame) -> DataFrame:
    """Alerts and jams per cell of the fetched feed documents, from the array sizes alone."""
    cells = opened_cells(documents).withColumnRenamed("cell", "indice_celda")
    found = [F.sum(F.coalesce(F.array_size(objects_of(part)), F.lit(0))).alias(name)
             for part, name in (("alerts", "alertas"), ("jams", "atascos"))]
    return cells.groupBy("indice_celda").agg(F.count("*").alias("consultas"), *found)
