"""Neighbourhood access and slope.

Two window passes, by row and then by column, give a pixel all eight neighbours. Both run
inside stripes with a halo, so one shuffle serves them and a task never holds the raster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.numbers import rint
from gridloom.grid import Grid
from gridloom.operators.halo import by_col, by_row, dealt, own


def neighbours(layer: DataFrame, value: str, grid: Grid) -> DataFrame:
    """Adds __n, nine values from top left to bottom right; beyond the edge stands the edge's own value."""
    v = F.col(value)
    left = F.when(F.col("col") == 0, v).otherwise(F.lag(v).over(by_row()))
    right = F.when(F.col("col") == grid.width - 1, v).otherwise(F.lead(v).over(by_row()))
    lines = dealt(layer, 1).withColumn("__line", F.array(left, v, right))
    line = F.col("__line")
    above = F.when(F.col("row") == 0, line).otherwise(F.lag(line).over(by_col()))
    below = F.when(F.col("row") == grid.height - 1, line).otherwise(F.lead(line).over(by_col()))
    return own(lines.withColumn("__n", F.concat(above, line, below)).drop("__line"))


def horn_slope(layer: DataFrame, value: str, grid: Grid, res: float | None = None, out: str = "slope") -> DataFrame:
    """Slope in degrees from Horn's weighted differences; a missing centre or neighbour makes it missing."""
    step = 8 * (res or grid.res)
    n = [F.col("__n")[i] for i in range(9)]
    dx = ((n[2] + 2 * n[5] + n[8]) - (n[0] + 2 * n[3] + n[6])) / step
    dy = ((n[6] + 2 * n[7] + n[8]) - (n[0] + 2 * n[1] + n[2])) / step
    return neighbours(layer, value, grid).withColumn(out, F.when(n[4].isNotNull(), F.degrees(F.atan(F.sqrt(dx * dx + dy * dy))))).drop("__n")


def summary(layer: DataFrame, value: str, points: Sequence[int] = (1, 25, 50, 75, 99), above: Sequence[float] = (), up_to: Sequence[float] = ()) -> DataFrame:
    """Exact percentiles, extremes, and shares above or up to cuts, over the values that exist; one row.

    Percentiles combine counts of distinct values on the map side; round values first where
    a layer has as many values as pixels.
    """
    v: Column = F.col(value)
    shares = [rint(100 * F.avg((v > c).cast("int")), 4).alias(f"above_{c:g}") for c in above] + [rint(100 * F.avg((v <= c).cast("int")), 4).alias(f"up_to_{c:g}") for c in up_to]
    return layer.filter(v.isNotNull()).agg(
        F.count(v).alias("n"), F.min(v).alias("low"), F.max(v).alias("high"),
        *[rint(F.percentile(v, F.lit(p / 100)), 4).alias(f"p{p}") for p in points], *shares,
    )


def masked(layer: DataFrame, value: str, valid: Column) -> DataFrame:
    """Only the centre counts: values where it is invalid become missing."""
    return layer.withColumn(value, F.when(valid, F.col(value)))
