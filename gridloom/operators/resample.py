"""Resampling between grids, decimation, and rasterising of vectors.

Resampling goes by tiles of the target. A tile's outline, walked in source coordinates, bounds
the source pixels that it needs; these are dealt to it (a pixel near an outline to more than one)
and the task weighs all taps of the tile's pixels at once. Source rows are shuffled once, and the
boxes that they meet are a few rows for each tile. Weights of missing taps drop out, as do their
shares of the total.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import utm
from gridloom.grid import Grid

TAPS = {"nearest": 1, "bilinear": 2, "cubic": 4}
TILE, BOX = 256, 1024


def _weight(kind: str, d: np.ndarray) -> np.ndarray:
    """The weight of a tap at a distance of d source pixels."""
    if kind == "nearest":
        return np.ones(d.shape)
    if kind == "bilinear":
        return 1 - d
    near = (1.5 * d - 2.5) * d * d + 1
    far = ((-0.5 * d + 2.5) * d - 4) * d + 2
    return np.where(d <= 1, near, far)


def source_position(target: Grid, source: Grid, row, col, m=utm.COLUMNS) -> tuple:
    """A place in target pixels (0.0 is the first pixel's centre) in source pixels, where whole numbers are centres."""
    x, y = target.x0 + (col + 0.5) * target.res, target.y0 - (row + 0.5) * target.res
    if target.epsg != source.epsg:
        lon, lat = utm.unproject(x, y, target.epsg, m)
        x, y = utm.project(lon, lat, source.epsg, m) if source.epsg != 4326 else (lon, lat)
    return (source.y0 - y) / source.res - 0.5, (x - source.x0) / source.res - 0.5


def tile_side(source: Grid, target: Grid) -> int:
    """Target pixels along a tile's side, so that its source box has about BOX pixels a side at most."""
    middle = target.height / 2, target.width / 2
    here, there = (source_position(target, source, middle[0] + k, middle[1] + k, utm.NUMBERS) for k in (0, 1))
    return max(1, min(TILE, int(BOX / max(abs(a - b) for a, b in zip(here, there, strict=True)))))


def source_boxes(spark: SparkSession, source: Grid, target: Grid, side: int, taps: int) -> DataFrame:
    """(tr, tc, r0, r1, c0, c1): the source pixels that each target tile needs; tiles beyond the source are left out."""
    across, down = -(-target.width // side), -(-target.height // side)
    share = np.linspace(0, 1, 17)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tr, tc = np.divmod(batch["id"].to_numpy(), across)
            top, left = (tr * side - 0.5)[:, None], (tc * side - 0.5)[:, None]
            bottom, right = np.minimum(top + side, target.height - 0.5), np.minimum(left + side, target.width - 0.5)
            x, y = left + share * (right - left), top + share * (bottom - top)
            rows, cols = np.hstack([top + 0 * x, bottom + 0 * x, y, y]), np.hstack([x, x, left + 0 * y, right + 0 * y])
            r, c = source_position(target, source, rows, cols, utm.ARRAYS)
            box = {"r0": np.floor(r.min(axis=1)) - taps, "r1": np.ceil(r.max(axis=1)) + taps, "c0": np.floor(c.min(axis=1)) - taps, "c1": np.ceil(c.max(axis=1)) + taps}
            near = pd.DataFrame({"tr": tr, "tc": tc} | {k: np.clip(v, -1e9, 1e9) for k, v in box.items()}).astype("int32")
            yield near[(near.r1 >= 0) & (near.c1 >= 0) & (near.r0 < source.height) & (near.c0 < source.width)]

    near = spark.range(across * down).mapInPandas(walk, "tr int, tc int, r0 int, r1 int, c0 int, c1 int")
    first, last = [F.greatest(F.lit(0), F.col(k)).alias(k) for k in ("r0", "c0")], [F.least(F.lit(n - 1), F.col(k)).alias(k) for k, n in (("r1", source.height), ("c1", source.width))]
    return near.select("tr", "tc", *first, *last)


def weighed(sr: np.ndarray, sc: np.ndarray, v: np.ndarray, r: np.ndarray, c: np.ndarray, kind: str) -> np.ndarray:
    """Values at the places (r, c) from the taps (sr, sc, v) around them; NaN where there is none."""
    taps = TAPS[kind]
    r0, c0 = int(sr.min()), int(sc.min())
    box = np.full((int(sr.max()) - r0 + 1, int(sc.max()) - c0 + 1), np.nan)
    box[sr - r0, sc - c0] = v
    start = (lambda x: np.floor(x + 0.5)) if taps == 1 else (lambda x: np.floor(x) - (taps // 2 - 1))
    total, weight = np.zeros(r.shape), np.zeros(r.shape)
    for i in range(taps):
        at_r = start(r) + i
        for j in range(taps):
            at_c = start(c) + j
            inside = (at_r >= r0) & (at_r < r0 + box.shape[0]) & (at_c >= c0) & (at_c < c0 + box.shape[1])
            tap = np.where(inside, box[np.where(inside, at_r - r0, 0).astype(np.int64), np.where(inside, at_c - c0, 0).astype(np.int64)], np.nan)
            known = ~np.isnan(tap)
            w = np.where(known, _weight(kind, np.abs(r - at_r)) * _weight(kind, np.abs(c - at_c)), 0.0)
            total += w * np.where(known, tap, 0.0)
            weight += w
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(weight != 0, total / weight, np.nan)


def resample(layer: DataFrame, value: str, source: Grid, target: Grid, kind: str = "bilinear") -> DataFrame:
    """(row, col, value) of the target grid; pixels without any tap are left out."""
    side, block = tile_side(source, target), 256
    boxes = source_boxes(layer.sparkSession, source, target, side, TAPS[kind])
    blocks = lambda a, b: F.sequence(F.expr(f"CAST({a} DIV {block} AS INT)"), F.expr(f"CAST({b} DIV {block} AS INT)"))
    boxes = boxes.withColumn("br", F.explode(blocks("r0", "r1"))).withColumn("bc", F.explode(blocks("c0", "c1")))
    known = layer.filter(F.col(value).isNotNull()).select(F.col("row").cast("int").alias("sr"), F.col("col").cast("int").alias("sc"), F.col(value).cast("double").alias("v"))
    known = known.withColumn("br", F.expr(f"CAST(sr DIV {block} AS INT)")).withColumn("bc", F.expr(f"CAST(sc DIV {block} AS INT)"))
    dealt = known.join(boxes, ["br", "bc"]).filter("sr BETWEEN r0 AND r1 AND sc BETWEEN c0 AND c1").select("tr", "tc", "sr", "sc", "v")

    def tile(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        top, left = int(key[0]) * side, int(key[1]) * side
        row, col = (k.ravel() for k in np.mgrid[top : min(top + side, target.height), left : min(left + side, target.width)])
        r, c = source_position(target, source, row.astype(float), col.astype(float), utm.ARRAYS)
        got = weighed(rows["sr"].to_numpy(), rows["sc"].to_numpy(), rows["v"].to_numpy(), r, c, kind)
        some = ~np.isnan(got)
        return pd.DataFrame({"row": row[some].astype("int32"), "col": col[some].astype("int32"), value: got[some]})

    return dealt.groupBy("tr", "tc").applyInPandas(tile, f"row int, col int, `{value}` double")


def footprints(scenes: DataFrame, grid: Grid, points: int = 21) -> DataFrame:
    """Each scene's (id, epsg, left, bottom, right, top) in its own zone as bounds in the grid's zone, along densified edges."""
    steps = F.transform(F.sequence(F.lit(0), F.lit(points + 1)), lambda k: k / (points + 1.0))
    walked = scenes.withColumn("t", F.explode(steps))
    x, y = F.col("left") + F.col("t") * (F.col("right") - F.col("left")), F.col("bottom") + F.col("t") * (F.col("top") - F.col("bottom"))
    ring = walked.select("id", "epsg", F.explode(F.array(*[F.struct(a.alias("x"), b.alias("y")) for a, b in ((x, F.col("bottom")), (x, F.col("top")), (F.col("left"), y), (F.col("right"), y))])).alias("p"))
    lon, lat = utm.unproject(F.col("p.x"), F.col("p.y"), F.col("epsg"))
    east, north = utm.project(F.col("lon"), F.col("lat"), grid.epsg)
    placed = ring.select("id", lon.alias("lon"), lat.alias("lat")).select("id", east.alias("x"), north.alias("y"))
    return placed.groupBy("id").agg(F.min("x").alias("left"), F.min("y").alias("bottom"), F.max("x").alias("right"), F.max("y").alias("top"))


def averaged(layer: DataFrame, value: str, k: int) -> DataFrame:
    """The mean of each k x k square's values."""
    return layer.groupBy(F.expr(f"CAST(row DIV {k} AS INT)").alias("row"), F.expr(f"CAST(col DIV {k} AS INT)").alias("col")).agg(F.avg(value).alias(value))


def decimated(layer: DataFrame, k: int) -> DataFrame:
    """Every k-th pixel of every k-th row."""
    return layer.filter((F.col("row") % k == 0) & (F.col("col") % k == 0)).withColumn("row", F.expr(f"CAST(row DIV {k} AS INT)")).withColumn("col", F.expr(f"CAST(col DIV {k} AS INT)"))


def slope_by_coarse(layer: DataFrame, value: str, grid: Grid, factor: int = 3, margin: int = 4, kind: str = "bilinear") -> DataFrame:
    """Slope at factor times the pixel size, brought back by lines between centres; invalid centres stay missing."""
    from gridloom.operators.terrain import horn_slope

    coarse = grid.coarsened(factor, margin)
    down = coarse.pixels(layer.sparkSession).join(resample(layer, value, grid, coarse, kind), ["row", "col"], "left")
    back = resample(horn_slope(down, value, coarse), "slope", coarse, grid, "bilinear")
    return layer.select("row", "col", F.col(value).isNotNull().alias("known")).join(back, ["row", "col"], "left").select("row", "col", F.when(F.col("known"), F.col("slope")).alias("slope"))


def touched_by_segments(segments: DataFrame, grid: Grid) -> DataFrame:
    """Every pixel that a segment (x0, y0, x1, y1 in grid pixels, y down) touches; distinct (row, col).

    A segment is cut by each row it crosses; in a row it touches all columns between the
    least and greatest column of its part there.
    """
    y0, y1, x0, x1 = (F.col(c) for c in ("y0", "y1", "x0", "x1"))
    low, high = F.least(y0, y1), F.greatest(y0, y1)
    rows = segments.filter((high >= 0) & (low < grid.height)).withColumn("row", F.explode(F.sequence(F.greatest(F.lit(0), F.floor(low)).cast("int"), F.least(F.lit(grid.height - 1), F.floor(high)).cast("int"))))
    at = lambda y: x0 + (x1 - x0) * F.try_divide(y - y0, F.nullif(y1 - y0, F.lit(0.0)))
    top, bottom = F.greatest(low, F.col("row").cast("double")), F.least(high, (F.col("row") + 1).cast("double"))
    level = y0 == y1
    a, b = F.when(level, x0).otherwise(at(top)), F.when(level, x1).otherwise(at(bottom))
    left, right = F.floor(F.least(a, b)), F.floor(F.greatest(a, b))
    inside = rows.withColumn("left", F.greatest(F.lit(0), left).cast("int")).withColumn("right", F.least(F.lit(grid.width - 1), right).cast("int")).filter("left <= right")
    return inside.select("row", F.explode(F.sequence("left", "right")).alias("col")).distinct()


def filled_polygons(edges: DataFrame, grid: Grid) -> DataFrame:
    """Pixels whose centre lies in a polygon by the even-odd rule, with those its edges touch. edges: id, x0, y0, x1, y1."""
    from pyspark.sql import Window

    low, high = F.least("y0", "y1"), F.greatest("y0", "y1")
    first, last = F.greatest(F.lit(0), F.ceil(low - 0.5)).cast("int"), F.least(F.lit(grid.height - 1), F.ceil(high - 0.5) - 1).cast("int")
    crossing = edges.filter((F.col("y0") != F.col("y1")) & (first <= last)).withColumn("row", F.explode(F.sequence(first, last)))
    x = F.col("x0") + (F.col("x1") - F.col("x0")) * (F.col("row") + 0.5 - F.col("y0")) / (F.col("y1") - F.col("y0"))
    line = Window.partitionBy("id", "row").orderBy("x")
    pairs = crossing.select("id", "row", x.alias("x")).withColumn("to", F.lead("x").over(line)).withColumn("nth", F.row_number().over(line)).filter("nth % 2 = 1 AND to IS NOT NULL")
    left, right = F.greatest(F.lit(0), F.ceil(F.col("x") - 0.5)).cast("int"), F.least(F.lit(grid.width - 1), F.ceil(F.col("to") - 0.5) - 1).cast("int")
    inner = pairs.filter(left <= right).select("row", F.explode(F.sequence(left, right)).alias("col"))
    return inner.union(touched_by_segments(edges, grid)).distinct()


def segments_of(features: DataFrame, grid: Grid, points: str = "points") -> DataFrame:
    """Consecutive points (lon, lat) of each feature as segments in grid pixels; features without geometry are skipped."""
    lon, lat = F.col("p.lon"), F.col("p.lat")
    x, y = utm.project(lon, lat, grid.epsg)
    placed = features.filter(F.col(points).isNotNull()).select("id", F.posexplode(points).alias("k", "p")).select("id", "k", ((x - grid.x0) / grid.res).alias("x"), ((F.lit(grid.y0) - y) / grid.res).alias("y"))
    from pyspark.sql import Window

    order = Window.partitionBy("id").orderBy("k")
    return placed.select("id", F.col("x").alias("x0"), F.col("y").alias("y0"), F.lead("x").over(order).alias("x1"), F.lead("y").over(order).alias("y1")).filter("x1 IS NOT NULL")


def lanes(values: np.ndarray, spark: SparkSession, name: str = "value") -> DataFrame:
    """A small array as (row, col, value): for tests and seeds, not for rasters."""
    return spark.createDataFrame([(int(r), int(c), values[r, c].item()) for r, c in np.ndindex(values.shape)], f"row int, col int, {name} {'double' if values.dtype.kind == 'f' else 'boolean' if values.dtype.kind == 'b' else 'int'}")
