"""From a region and a box to ranked sites, a score layer, a picture and a document."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import colours, utm
from gridloom.grid import REGIONS, Grid, Window, grid_for
from gridloom.operators import resample, scoring, sites
from gridloom.plans import report
from gridloom.sources import layers, png, tiff
from gridloom.sources.scratch import materialise

MOST_KM2 = 25.0


def window_of(region: str, bbox: tuple[float, float, float, float] | None, grid: Grid, most_km2: float | None = None) -> Window:
    """The pixels of a box in degrees; a limit on its area can be asked for."""
    if bbox is None:
        return grid.full
    w = grid.window_for(utm.bounds_projected(bbox, grid.epsg))
    area = w.width * w.height * grid.res**2 / 1e6
    if most_km2 is not None and area > most_km2:
        raise ValueError(f"region {region}: the box covers {area:.1f} km2; the limit is {most_km2:g} km2")
    return w


def polygon_pixels(stack: DataFrame, ring: list[tuple[float, float]], grid: Grid) -> DataFrame:
    """The stack's pixels inside a ring of (lon, lat)."""
    spark = stack.sparkSession
    xy = [utm.project(lon, lat, grid.epsg, utm.NUMBERS) for lon, lat in ring]
    px = [((x - grid.x0) / grid.res, (grid.y0 - y) / grid.res) for x, y in xy]
    edges = spark.createDataFrame([(0, *a, *b) for a, b in zip(px, [*px[1:], px[0]], strict=True)], "id int, x0 double, y0 double, x1 double, y1 double")
    return stack.join(resample.filled_polygons(edges, grid), ["row", "col"], "left_semi")


def require_inside(ring: list[tuple[float, float]], region: str, grid: Grid) -> None:
    """Every corner of a polygon must lie on the region's grid."""
    west, south, east, north = grid.bounds
    for lon, lat in ring:
        x, y = utm.project(lon, lat, grid.epsg, utm.NUMBERS)
        if not (west <= x <= east and south <= y <= north):
            raise ValueError(f"region {region}: the polygon's corner ({lon:g}, {lat:g}) lies outside of it")


def scored(stack: DataFrame, scorer: scoring.Scorer) -> DataFrame:
    """The extension point: a scorer turns the stack into a column of whole scores; other numbers are cast."""
    return stack.withColumn("score", F.coalesce(scorer(stack).cast("int"), F.lit(0)))


def analyze(spark: SparkSession, root: str, region: str = "A", bbox: tuple[float, float, float, float] | None = None, top: int = 5, min_score: int = 1, out_dir: str | None = None, scorer: scoring.Scorer = lambda _: scoring.parity(), grid: Grid | None = None, most_km2: float | None = None, polygon: list[tuple[float, float]] | None = None) -> dict:
    """The sites document of a box or a polygon of (lon, lat); with out_dir also the score layer, a heat map and the report.

    Pixels of the polygon's box outside of it are invalid.
    """
    grid = grid or grid_for(REGIONS[region])
    if polygon:
        require_inside(polygon, region, grid)
        xs, ys = zip(*polygon, strict=True)
        bbox, most_km2 = (min(xs), min(ys), max(xs), max(ys)), MOST_KM2 if most_km2 is None else most_km2
    w = window_of(region, bbox, grid, most_km2)
    loaded = layers.load(spark, root, region, grid, w)
    if polygon:
        inside = polygon_pixels(loaded, polygon, grid).select("row", "col", F.lit(True).alias("inside"))
        loaded = loaded.join(inside, ["row", "col"], "left").withColumn("valid", F.col("valid") & F.coalesce("inside", F.lit(False))).drop("inside")
    stack = materialise(scored(loaded, scorer), "scored")
    scoring.contract(stack, w.width * w.height)
    # Opening and labels see the window's own pixels, whose outside is false.
    local = stack.withColumn("row", F.col("row") - w.row).withColumn("col", F.col("col") - w.col).drop("stripe")
    own = Grid(grid.epsg, grid.x0 + w.col * grid.res, grid.y0 - w.row * grid.res, grid.res, w.width, w.height)
    document = report.payload(region, sites.extract(local, own, top, min_score))
    if out_dir:
        out = Path(out_dir).resolve()  # one place for Spark's files and the driver's
        out.mkdir(parents=True, exist_ok=True)
        local.select("row", "col", "score").write.mode("overwrite").parquet(f"{out.as_uri()}/suitability")
        tiff.write_one(local, ["score"], own, str(out / "suitability.tif"), "uint8", 0, ["suitability_0_100"])
        k = png.step_for(w.width)
        small = resample.decimated(local.select("row", "col", "score"), k).withColumn("rgb", colours.score_rgb(F.col("score")))
        png.picture(small, "rgb", -(-w.width // k), -(-w.height // k), str(out / "suitability_heatmap.png"))
        (out / "sites.json").write_text(json.dumps(document, indent=2))
        report.write(document, str(out / "sites.report.md"))
    return document
