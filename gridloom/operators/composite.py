"""Cloud-masked median composites.

One aggregation by pixel is the only shuffle. Masking stands before it and combines on
the map side for counts; the median needs a pixel's looks together, a bounded number
(scenes over one place), so no pixel can be hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.numbers import rint
from gridloom.grid import Grid

CLEAR = (4, 5, 6, 7)  # Fixed values: quality codes that count as clear.


def overlapping(scenes: DataFrame, stripes: DataFrame) -> DataFrame:
    """Scene and stripe pairs whose open rectangles meet; touching edges don't.

    Both carry left, bottom, right, top. Stripes are full-width slabs of one height, so a
    scene's range of stripes is arithmetic and the join is an equality on the stripe number.
    """
    span = stripes.agg(F.max("top").alias("y0"), F.max(F.col("top") - F.col("bottom")).alias("h"))
    reach = scenes.crossJoin(F.broadcast(span)).withColumn("stripe", F.explode(F.sequence(F.greatest(F.lit(0), F.floor((F.col("y0") - F.col("top")) / F.col("h"))).cast("int"), F.greatest(F.lit(0), F.floor((F.col("y0") - F.col("bottom")) / F.col("h"))).cast("int")))).drop("y0", "h")
    other = stripes.select("stripe", *[F.col(c).alias(f"s_{c}") for c in ("left", "bottom", "right", "top")])
    meets = (F.col("left") < F.col("s_right")) & (F.col("right") > F.col("s_left")) & (F.col("bottom") < F.col("s_top")) & (F.col("top") > F.col("s_bottom"))
    return reach.join(other, "stripe").filter(meets).drop("s_left", "s_bottom", "s_right", "s_top")


def median_composite(looks: DataFrame, bands: Sequence[str], clear: Sequence[int] = CLEAR) -> DataFrame:
    """row, col, a rounded median for each band (0 where nothing is clear) and the number of clear looks.

    A look's band counts where it is clear and not fill (0), band by band; clear looks are
    counted by their quality alone.
    """
    seen = looks.filter(F.col("scl").isin(*clear))
    medians = [F.coalesce(rint(F.median(F.when(F.col(b) != 0, F.col(b)))), F.lit(0.0)).cast("int").alias(b) for b in bands]
    return seen.groupBy("row", "col").agg(*medians, F.count(F.lit(1)).alias("clear"))


def on_grid(composite: DataFrame, grid: Grid, bands: Sequence[str]) -> DataFrame:
    """The composite with every pixel of the grid; those without clear looks hold 0."""
    return grid.pixels(composite.sparkSession).join(composite, ["row", "col"], "left").select("row", "col", *[F.coalesce(F.col(b), F.lit(0)).alias(b) for b in (*bands, "clear")])


def quality(composite: DataFrame, stripe_height: int) -> DataFrame:
    """Median of clear looks and share of empty pixels by stripe, in percent."""
    return composite.groupBy(F.expr(f"row DIV {stripe_height}").alias("stripe")).agg(F.median("clear").alias("median_clear"), rint(100 * F.avg((F.col("clear") == 0).cast("int")), 4).alias("empty_pct"))
