"""3 x 3 erosion, dilation and opening of boolean layers; outside the grid is false.

A square's minimum is the minimum along rows of the minimum along columns, so each step is
two window passes over lines. A chain of steps runs inside stripes whose halo has a row for
each step: one shuffle, however long the chain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators.halo import by_col, by_row, dealt, own


def _along(layer: DataFrame, mask: str, window, pick) -> DataFrame:
    m: Column = F.col(mask)
    side = lambda x: F.coalesce(x.over(window), F.lit(False))
    return layer.withColumn(mask, pick(side(F.lag(m)), m, side(F.lead(m))))


def _eroded(layer: DataFrame, mask: str) -> DataFrame:
    return _along(_along(layer, mask, by_row(), F.least), mask, by_col(), F.least)


def _dilated(layer: DataFrame, mask: str) -> DataFrame:
    return _along(_along(layer, mask, by_col(), F.greatest), mask, by_row(), F.greatest)


def eroded(layer: DataFrame, mask: str) -> DataFrame:
    """Pixels whose whole square is true. The layer must hold every pixel of its grid."""
    return own(_eroded(dealt(layer, 1), mask))


def dilated(layer: DataFrame, mask: str) -> DataFrame:
    return own(_dilated(dealt(layer, 1), mask))


def opened(layer: DataFrame, mask: str) -> DataFrame:
    """The union of all whole squares inside the mask."""
    return own(_dilated(_eroded(dealt(layer, 2), mask), mask))


def opened_with_core(layer: DataFrame, mask: str, core: str = "core") -> DataFrame:
    """The mask opened, and its erosion beside it."""
    clean = _dilated(_eroded(dealt(layer, 3), mask), mask)
    return own(_eroded(clean.withColumn(core, F.col(mask)), core))
