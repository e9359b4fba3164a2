"""Spatial train and validation splits by blocks, with a buffer between them."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.numbers import rint
from gridloom.grid import Grid

BUFFER, TRAIN, VAL = 0, 1, 2
SEED, BLOCK, BUFFER_PX, PATCH, SHARE = 20260731, 1024, 256, 256, 0.2
# The validation blocks of the two regions at the default seed.
VAL_BLOCKS = {
    "A": ((0, 0), (0, 3), (1, 5), (2, 1), (3, 5), (5, 1), (6, 2), (6, 3)),
    "B": ((0, 0), (0, 3), (1, 4), (1, 6), (3, 2), (4, 3), (5, 3), (5, 4)),
}


def block_shape(height: int, width: int, block: int = BLOCK) -> tuple[int, int]:
    return -(-height // block), -(-width // block)


def chosen_blocks(shape: tuple[int, int], seed: int = SEED, share: float = SHARE) -> list[tuple[int, int]]:
    """Validation blocks drawn without replacement by a seeded generator; freeze the result, streams may change."""
    n = shape[0] * shape[1]
    picked = np.random.default_rng(seed).choice(n, size=max(round(n * share), 1), replace=False)
    return sorted((int(i) // shape[1], int(i) % shape[1]) for i in picked)


def split_of(val_blocks: Iterable[tuple[int, int]], grid: Grid, block: int = BLOCK, buffer_px: int = BUFFER_PX) -> F.Column:
    """The split of a pixel from row and col alone: a few rectangles, so no pixel meets another.

    A training pixel within buffer_px (counted along the longer axis) of a validation pixel is buffer.
    """
    row, col = F.col("row"), F.col("col")
    inside, near = F.lit(False), F.lit(False)
    for r, c in val_blocks:
        top, left = r * block, c * block
        bottom, right = min(top + block, grid.height) - 1, min(left + block, grid.width) - 1
        inside = inside | (row.between(top, bottom) & col.between(left, right))
        if buffer_px > 0:
            near = near | (row.between(top - buffer_px, bottom + buffer_px) & col.between(left - buffer_px, right + buffer_px))
    return F.when(inside, VAL).when(near, BUFFER).otherwise(TRAIN)


def build(spark: SparkSession, grid: Grid, val_blocks: Iterable[tuple[int, int]], block: int = BLOCK, buffer_px: int = BUFFER_PX) -> DataFrame:
    return grid.pixels(spark).withColumn("split", split_of(list(val_blocks), grid, block, buffer_px))


def patch_origins(split: DataFrame, grid: Grid, value: int, patch: int = PATCH, stride: int | None = None) -> DataFrame:
    """Top left corners on the stride's lattice whose whole patch has the value.

    Each pixel counts toward the few origins that cover it; sums combine on the map side, a
    column's first so that a row of the lattice is spread over its columns.
    """
    step = stride or patch
    hits = split.filter(F.col("split") == value)
    last_r, last_c = (grid.height - patch) // step, (grid.width - patch) // step
    if last_r < 0 or last_c < 0:
        return hits.select("row", "col").filter(F.lit(False))
    covers = lambda x, last: F.sequence(F.greatest(F.lit(0), F.ceil((x - patch + 1) / step)).cast("int"), F.least(F.lit(last), F.floor(x / step)).cast("int"))
    reach = lambda x, last: F.ceil((x - patch + 1) / step) <= F.least(F.lit(last), F.floor(x / step))
    by_row = hits.filter(reach(F.col("row"), last_r) & (F.floor(F.col("row") / step) >= 0)).withColumn("i", F.explode(covers(F.col("row"), last_r))).groupBy("i", "col").agg(F.count(F.lit(1)).alias("n"))
    full = by_row.filter(F.col("n") == patch).filter(reach(F.col("col"), last_c)).withColumn("j", F.explode(covers(F.col("col"), last_c))).groupBy("i", "j").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == patch)
    return full.select((F.col("i") * step).alias("row"), (F.col("j") * step).alias("col"))


def class_balance(split: DataFrame, labels: DataFrame, label: str = "landcover") -> DataFrame:
    """Shares of classes within each split, without nodata; both sides meet on row and col."""
    counts = split.join(labels.select("row", "col", label), ["row", "col"]).filter(F.col(label) != 0).groupBy("split", label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("split").agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(totals), "split").select("split", label, rint(100.0 * F.col("n") / F.col("total"), 2).alias("pct"))  # three splits at most


def shares(split: DataFrame) -> DataFrame:
    counts = split.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    return counts.crossJoin(F.broadcast(counts.agg(F.sum("n").alias("total")))).select("split", rint(100.0 * F.col("n") / F.col("total"), 4).alias("pct"))
