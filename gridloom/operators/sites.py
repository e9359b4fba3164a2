"""Candidate sites: components of good ground with statistics, flags and ranks.

All sites are described by one aggregation by label, not one scan for each label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions import utm
from gridloom.functions.numbers import exact_round, rint
from gridloom.grid import Grid, Window as Pixels
from gridloom.operators import components, morphology
from gridloom.operators.landcover import named
from gridloom.sources.scratch import materialise

# flags' words and limits, in their order.
FLAGS = (
    ("mostly-edge: slope and land cover least reliable here (DSM artefact)", lambda: F.col("edge_fraction") > 0.5),
    ("over 5 km from the nearest drivable road", lambda: F.col("min_road") > 5000),
    ("over 5 km from perennial water", lambda: F.col("min_water") > 5000),
    ("small site: under 1 ha", lambda: F.col("area") < 1.0),
)
MIN_AREA_HA, TOP = 0.5, 5
FIELDS = ("lat", "lon", "score", "score_max", "area_ha", "mean_slope_deg", "max_slope_deg", "dist_road_m", "dist_water_m", "mean_elevation_m", "dominant_landcover", "flags")
PLACES = {"lat": 6, "lon": 6, "score": 1, "score_max": 1, "area_ha": 2, "mean_slope_deg": 2, "max_slope_deg": 2, "dist_road_m": 0, "dist_water_m": 0, "mean_elevation_m": 1}


def candidates(stack: DataFrame, min_score: int = 1) -> DataFrame:
    """The stack with ``mask`` (cleaned) and ``core`` (its erosion)."""
    raw = stack.withColumn("mask", F.coalesce((F.col("score") >= min_score) & F.col("valid"), F.lit(False)))
    return morphology.opened_with_core(raw, "mask")


def labelled(stack: DataFrame, grid: Grid, min_score: int = 1, min_area_ha: float = MIN_AREA_HA) -> DataFrame:
    """Pixels of components that are large enough, with their layers, label and core."""
    found = materialise(candidates(stack, min_score).filter("mask"), "candidates")  # read by the runs and by the statistics
    runs = components.labelled_runs(found.select("row", "col"), grid.width)
    large = runs.groupBy("label").agg(F.sum(F.col("c1") - F.col("c0") + 1).alias("pixels")).filter(F.col("pixels") >= components.least_pixels(min_area_ha, grid.res)).select("label")
    pixels = runs.join(large, "label", "left_semi").select("row", F.explode(F.sequence("c0", "c1")).alias("col"), "label")
    return found.join(pixels, ["row", "col"])


def zonal(pixels: DataFrame) -> DataFrame:
    return pixels.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean_score"), F.max("score").alias("max_score"),
        F.avg("slope").alias("mean_slope"), F.max("slope").alias("max_slope"), F.min("dist_road").alias("min_road"), F.min("dist_water").alias("min_water"),
        F.avg("elevation").alias("mean_elevation"), F.avg("row").alias("mean_row"), F.avg("col").alias("mean_col"),
        (1 - F.avg(F.col("core").cast("int"))).alias("edge_fraction"),
    )


def dominant(pixels: DataFrame) -> DataFrame:
    """The most frequent class of each label; of equals the lowest."""
    counts = pixels.groupBy("label", "landcover").agg(F.count(F.lit(1)).alias("k"))
    return counts.groupBy("label").agg(F.max_by("landcover", F.struct("k", -F.col("landcover"))).alias("dominant"))


def flags() -> Column:
    return F.array_compact(F.array(*[F.when(test(), text) for text, test in FLAGS]))


def described(pixels: DataFrame, grid: Grid, exact: bool = True, origin: Pixels | None = None) -> DataFrame:
    """One row for each label with the site's fields. exact rounds as Python does, else half to even on scaled values."""
    rows = zonal(pixels).join(dominant(pixels), "label").withColumn("area", F.col("n") * (grid.res**2 / 10_000))
    x, y = grid.centre(F.col("mean_row"), F.col("mean_col"))
    lon, lat = utm.unproject(x, y, grid.epsg)
    raw = {"lat": lat, "lon": lon, "score": F.col("mean_score"), "score_max": F.col("max_score").cast("double"), "area_ha": F.col("area"), "mean_slope_deg": F.col("mean_slope"), "max_slope_deg": F.col("max_slope"), "dist_road_m": F.col("min_road"), "dist_water_m": F.col("min_water"), "mean_elevation_m": F.col("mean_elevation")}
    rounded = {k: (exact_round(PLACES[k])(v.cast("double")) if exact else rint(v, PLACES[k])).alias(k) for k, v in raw.items()}
    return rows.select("label", *rounded.values(), named(F.col("dominant")).alias("dominant_landcover"), flags().alias("flags"))


def ranked(sites: DataFrame, top: int = TOP) -> DataFrame:
    """The best sites by rounded score and area; ties keep the order of labels.

    The top rows are found before they are numbered, so only they meet in one task.
    """
    order = [F.desc("score"), F.desc("area_ha"), F.asc("label")]
    best = sites.orderBy(*order).limit(top)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order))).select("rank", *FIELDS)


def extract(stack: DataFrame, grid: Grid, top: int = TOP, min_score: int = 1, min_area_ha: float = MIN_AREA_HA, exact: bool = True) -> DataFrame:
    """Scored stack to ranked sites."""
    pixels = materialise(labelled(stack, grid, min_score, min_area_ha), "sites")  # read by the means and by the classes
    return ranked(described(pixels, grid, exact), top)
