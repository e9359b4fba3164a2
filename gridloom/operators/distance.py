"""Exact Euclidean distance to features, the nearest feature's place, and coverage checks.

Two passes. By column, windows find the nearest feature row above and below each pixel. By
stripe of rows, a vectorised search walks outward one column at a time until no farther
column can help; a stripe is whole rows and bounded in height, so memory is bounded by
the grid's width.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.numbers import rint
from gridloom.grid import Grid

NONE = np.int64(1) << 62
STRIPE = 64


def nearest_in_rows(near: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Squared distance, feature row and feature column for each pixel of whole rows.

    near: each pixel's nearest feature row in its own column, -1 for none; row: the rows' numbers.
    Of features equally far the least (row, column) counts.
    """
    height, width = near.shape
    own = np.where(near >= 0, (near - row[:, None]).astype(np.int64) ** 2, NONE)
    col = np.arange(width)
    best, feature_row, feature_col = own.copy(), near.copy(), np.broadcast_to(col, near.shape).copy()
    for step in range(1, width):
        if step * step > best.max():
            break
        for here, there in ((slice(step, None), slice(None, width - step)), (slice(None, width - step), slice(step, None))):
            d = np.where(own[:, there] < NONE, own[:, there] + step * step, NONE)
            r, c = near[:, there], np.broadcast_to(col[there], near[:, there].shape)
            better = (d < best[:, here]) | ((d == best[:, here]) & (d < NONE) & ((r < feature_row[:, here]) | ((r == feature_row[:, here]) & (c < feature_col[:, here]))))
            for target, source in ((best, d), (feature_row, r), (feature_col, c)):
                target[:, here][better] = source[better]
    return best, feature_row, feature_col


def nearest(layer: DataFrame, feature: str, grid: Grid, stripe: int = STRIPE) -> DataFrame:
    """row, col, distance, near_row, near_col of a layer that holds every pixel; without any feature it fails."""
    at = F.when(F.col(feature), F.col("row"))
    column = Window.partitionBy("col").orderBy("row")
    above = F.last(at, ignorenulls=True).over(column.rowsBetween(Window.unboundedPreceding, 0))
    below = F.first(at, ignorenulls=True).over(column.rowsBetween(0, Window.unboundedFollowing))
    near = F.when(above.isNull(), below).when(below.isNull(), above).when(F.col("row") - above <= below - F.col("row"), above).otherwise(below)
    rows = layer.select("row", "col", F.coalesce(near, F.lit(-1)).cast("int").alias("near"), F.expr(f"row DIV {stripe}").alias("stripe"))
    width, res = grid.width, grid.res

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["row", "col"])
        near = pdf["near"].to_numpy().reshape(-1, width)
        row = pdf["row"].to_numpy().reshape(-1, width)[:, 0]
        if (near < 0).all():
            raise ValueError("no feature to measure distances to")
        best, r, c = nearest_in_rows(near, row)
        return pd.DataFrame({"row": pdf["row"].to_numpy(), "col": pdf["col"].to_numpy(), "distance": np.sqrt(best.ravel()) * res, "near_row": r.ravel(), "near_col": c.ravel()})

    return rows.groupBy("stripe").applyInPandas(search, "row int, col int, distance double, near_row int, near_col int")


def above_nearest(layer: DataFrame, found: DataFrame, value: str = "elevation") -> DataFrame:
    """A pixel's value less the value at its nearest feature: an equality join on the feature's place."""
    there = layer.select(F.col("row").alias("near_row"), F.col("col").alias("near_col"), F.col(value).alias("near_value"))
    own = found.join(layer.select("row", "col", value), ["row", "col"])
    return own.join(there, ["near_row", "near_col"]).withColumn("rise", F.col(value) - F.col("near_value"))


def cell_of(i: F.Column, n: int, cells: int) -> F.Column:
    """Which of ``cells`` nearly equal parts position i of n falls in; the first n % cells are one longer."""
    short, longer = divmod(n, cells)
    if short == 0:
        return i
    edge = longer * (short + 1)
    return F.when(i < edge, F.floor(i / (short + 1))).otherwise(longer + F.floor((i - edge) / short)).cast("int")


def coverage(layer: DataFrame, feature: str, grid: Grid, cells: int, floor: float) -> DataFrame:
    """One row: occupied cells of cells x cells, their share, and whether it reaches the floor."""
    hit = layer.filter(F.col(feature)).select(cell_of(F.col("row"), grid.height, cells).alias("r"), cell_of(F.col("col"), grid.width, cells).alias("c")).distinct()
    n = float(min(cells, grid.height) * min(cells, grid.width))
    return hit.agg(F.count(F.lit(1)).alias("occupied")).select("occupied", rint(F.col("occupied") / n, 4).alias("share"), (F.col("occupied") / n >= floor).alias("covered"))


def require_coverage(report: DataFrame, theme: str, fatal: bool) -> None:
    """Fails, or warns, where features are missing from too much of the grid."""
    row = report.first()
    if not row["covered"]:
        message = f"{theme}: only {row['share']:.0%} of the cells hold a feature"
        if fatal:
            raise ValueError(message)
        import warnings

        warnings.warn(message, stacklevel=2)
