"""Stripes of rows with a halo: one shuffle serves a whole chain of neighbourhood steps.

A row near a stripe's edge is also dealt to the neighbour. Windows whose partitions begin
with the stripe then need no further exchange, and each step spoils at most one more row of
the halo; only the stripe's own rows are kept in the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

HEIGHT = 64


def dealt(layer: DataFrame, halo: int, height: int = HEIGHT) -> DataFrame:
    """The rows of each stripe and ``halo`` more on both sides, with __stripe and __home."""
    if not 0 < halo <= height:
        raise ValueError(f"a halo of {halo} rows doesn't fit stripes of {height}")
    stripe = lambda row: F.floor(row / height).cast("int")
    places = F.array_distinct(F.array(stripe(F.greatest(F.col("row") - halo, F.lit(0))), stripe(F.col("row")), stripe(F.col("row") + halo)))
    rows = layer.withColumn("__stripe", F.explode(places)).withColumn("__home", stripe(F.col("row")) == F.col("__stripe"))
    return rows.repartition("__stripe")


def own(rows: DataFrame) -> DataFrame:
    return rows.filter("__home").drop("__stripe", "__home")


def by_row() -> WindowSpec:
    return Window.partitionBy("__stripe", "row").orderBy("col")


def by_col() -> WindowSpec:
    return Window.partitionBy("__stripe", "col").orderBy("row")
