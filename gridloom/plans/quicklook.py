"""Pictures of layers: classes by their palette, one or three bands stretched between percentiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions import colours
from gridloom.grid import Grid
from gridloom.operators import resample
from gridloom.sources import png, tiff


def quicklook(layer: DataFrame, grid: Grid, path: str, bands: Sequence[str | int] | None = None, categorical: bool = False, width: int = 1400) -> tuple[int, int]:
    """Writes a picture of at most about ``width`` columns and returns its size. Averages shrink bands; classes are picked."""
    names = [c for c in layer.columns if c not in ("row", "col")]
    chosen = [names[i - 1] for i in tiff.bands_named(names, list(bands) if bands else None)]
    k = png.step_for(grid.width, width)
    if categorical:
        small = resample.decimated(layer.select("row", "col", chosen[0]), k).withColumn("rgb", colours.class_rgb(F.col(chosen[0])))
    else:
        square = [F.expr(f"CAST({x} DIV {k} AS INT)").alias(x) for x in ("row", "col")]
        small = layer.groupBy(*square).agg(*[F.avg(c).alias(c) for c in chosen])
        ends = layer.agg(*[F.percentile(c, F.array(F.lit(0.02), F.lit(0.98))).alias(c) for c in chosen]).first()  # two numbers a band
        three = chosen if len(chosen) == 3 else [chosen[0]] * 3
        small = small.withColumn("rgb", F.array(*[colours.stretched(F.col(c), F.lit(float((ends[c] or [0.0])[0])), F.lit(float((ends[c] or [0.0])[-1]))) for c in three]))
    size = -(-grid.width // k), -(-grid.height // k)
    png.picture(small, "rgb", *size, path)
    return size
