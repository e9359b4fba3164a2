"""The registered queries: each applies library operators to virtual rasters over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import colours, utm
from gridloom.functions.numbers import bucket, exact_round, normalised_numeral, numerals, rint
from gridloom.grid import REGIONS, Grid, grid_for
from gridloom.operators import components, composite, distance, landcover, morphology, resample, scenes, scoring, sites, splits, stats, terrain
from gridloom.plans import report
from gridloom.sources import virtual
from gridloom.sources.scratch import materialise
from gridloom.sources.virtual import GRID, SIDE, layers, looks, table

SLOPE_RES = 30.0
NUDGE = 1e-7  # sums differ in their last bits by order; this keeps values that end in a half from falling either way
BLOCK, BUFFER_PX, PATCH = 32, 6, 16
VAL_BLOCKS = ((0, 1), (2, 3), (3, 0))
CODES = (10, 20, 30, 40, 50, 60, 70, 80, 90, 95, 100)
BANDS = ("red", "nir")


def _composite(spark: SparkSession, d: str) -> DataFrame:
    return composite.on_grid(composite.median_composite(looks(spark, d), BANDS), GRID, BANDS)


def _slope(spark: SparkSession, d: str, base: DataFrame | None = None) -> DataFrame:
    return terrain.horn_slope(layers(spark, d) if base is None else base, "elevation", GRID, SLOPE_RES).withColumn("slope", rint(F.col("slope"), 4))


def _parity(spark: SparkSession, d: str) -> DataFrame:
    """Slope, cover and the plain score; distances play no part in it."""
    return _slope(spark, d).withColumn("valid", F.col("slope").isNotNull()).withColumn("score", scoring.parity())


def _distances(base: DataFrame, feature: str) -> DataFrame:
    return distance.nearest(base.withColumn("f", F.col(feature) | ((F.col("row") == 0) & (F.col("col") == 0))), "f", GRID)


def _stack(spark: SparkSession, d: str) -> DataFrame:
    """All five layers, the rise over the nearest water, validity and the plain score."""
    base = materialise(layers(spark, d), "layers")  # five readers, one scan of the observations
    water = _distances(base, "water")
    rise = distance.above_nearest(base, water).select("row", "col", F.col("distance").alias("dist_water"), "rise")
    road = _distances(base, "road").select("row", "col", F.col("distance").alias("dist_road"))
    return _slope(spark, d, base).join(rise, ["row", "col"]).join(road, ["row", "col"]).withColumn("valid", scoring.valid()).withColumn("score", scoring.parity())


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    return sites.labelled(_stack(spark, d), GRID)


def _components(spark: SparkSession, d: str) -> DataFrame:
    mask = sites.candidates(_parity(spark, d)).filter("mask")
    return components.components(mask.select("row", "col"), SIDE, stripe=32)


def _split(spark: SparkSession) -> DataFrame:
    return splits.build(spark, GRID, VAL_BLOCKS, BLOCK, BUFFER_PX)


def _scenes(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select(F.col("event_id").alias("id"), F.concat(F.lit("T"), F.col("user_id") % 8).alias("tile"), F.col("value").alias("cloud"), "ts", "event_type", "props")


def composite_median(spark, d):
    return _composite(spark, d)


def composite_quality(spark, d):
    return composite.quality(_composite(spark, d), 16)


def landcover_recode(spark, d):
    code = F.element_at(F.array(*map(F.lit, CODES)), (F.col("q").cast("int") % len(CODES)) + 1)
    return looks(spark, d).select(code.alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n")).withColumn("class", landcover.merged(F.col("code")))


def landcover_histogram(spark, d):
    return landcover.histogram(layers(spark, d))


def missing_classes(spark, d):
    """Classes that the whole layer lacks, of a layer whose fifth class counts as its second."""
    return landcover.missing(layers(spark, d).withColumn("landcover", F.when(F.col("landcover") == 5, 2).otherwise(F.col("landcover"))))


def elevation_summary(spark, d):
    rows = layers(spark, d).withColumn("elevation", rint(F.col("elevation"), 4))
    return terrain.summary(rows, "elevation", above=(520.0,), up_to=(505.0,))


def horn_slope(spark, d):
    return _slope(spark, d).select("row", "col", "slope")


def slope_exceedance(spark, d):
    return terrain.summary(_slope(spark, d), "slope", (50, 90, 99), above=(5.0, 10.0, 15.0))


def coarse_slope(spark, d):
    out = resample.slope_by_coarse(layers(spark, d).select("row", "col", "elevation"), "elevation", GRID, 3, 1, "nearest")
    return out.select("row", "col", rint(F.col("slope") + NUDGE, 4).alias("slope"))


def layer_stack_valid(spark, d):
    """Three layers align on row and col; a pixel is valid where all of them hold a value."""
    holes = composite.median_composite(looks(spark, d), BANDS).select("row", "col", F.nullif("red", F.lit(0)).alias("red"))
    base = layers(spark, d).select("row", "col", F.when(F.col("landcover") != 2, F.col("landcover")).alias("landcover"), "elevation")
    both = base.join(holes, ["row", "col"], "left")
    return both.select("row", "col", (F.col("landcover").isNotNull() & F.col("red").isNotNull() & F.col("elevation").isNotNull()).alias("valid"))


def window_clip(spark, d):
    w = GRID.window_for((186140.0 + 155, 3378690.0 - 905, 186140.0 + 605, 3378690.0 - 235))
    return layers(spark, d).filter(w.condition()).select("row", "col", rint(F.col("elevation"), 4).alias("elevation"))


def mosaic_first_wins(spark, d):
    tiles = looks(spark, d).groupBy("row", "col", F.col("scene").alias("rank")).agg(F.min("red").alias("red"))
    return scenes.mosaic(tiles, "red").select("row", "col", "red", F.col("rank").alias("tile_rank"))


def tile_resolution(spark, d):
    c = table(spark, d, "customer")
    boxes = c.select("c_custkey", (F.col("c_custkey") % 340 - 170.3).alias("west"), (F.col("c_custkey") % 150 - 75.6).alias("south")).withColumn("east", F.col("west") + 1.5).withColumn("north", F.col("south") + 0.7)
    out = scenes.tiles(boxes)
    return out.select("c_custkey", "lat", "lon", scenes.dem_tile_name(F.col("lat"), F.col("lon")).alias("name"))


def cover_tile_resolution(spark, d):
    s = table(spark, d, "supplier")
    boxes = s.select("s_suppkey", (F.col("s_suppkey") % 340 - 170.3).alias("west"), (F.col("s_suppkey") % 150 - 75.6).alias("south")).withColumn("east", F.col("west") + 4).withColumn("north", F.col("south") + 2.5)
    out = scenes.tiles(boxes, 3)
    return out.select("s_suppkey", "lat", "lon", scenes.cover_tile_name(F.col("lat"), F.col("lon")).alias("name"))


def road_filter(spark, d):
    kinds = F.create_map(*[F.lit(x) for p in {"view": "primary", "signup": "footway", "purchase": "track", "error": "steps", "click": "residential"}.items() for x in p])
    tagged = table(spark, d, "events").select("event_id", F.create_map(F.lit("highway"), F.try_element_at(kinds, F.col("event_type"))).alias("tags"))
    return tagged.filter(scenes.is_road(F.col("tags"))).select("event_id", F.element_at("tags", "highway").alias("highway"))


def water_filter(spark, d):
    p = F.col("p_size")
    tags = F.map_from_arrays(F.array(F.lit("waterway"), F.lit("natural"), F.lit("landuse")), F.array(F.when(p % 5 == 0, "river").when(p % 5 == 1, "stream"), F.when(p % 7 == 0, "water"), F.when(p % 11 == 0, "basin").when(p % 11 == 1, "farm")))
    rows = table(spark, d, "part").select("p_partkey", tags.alias("tags"))
    return rows.filter(scenes.is_water(F.col("tags"))).select("p_partkey")


def bbox_overlap(spark, d):
    """Scene footprints against stripes of 20 rows."""
    o = table(spark, d, "supplier")
    left, bottom = (F.col("s_suppkey") * 7 % 120).cast("double"), (F.col("s_suppkey") * 13 % 110).cast("double")
    boxes = o.select("s_suppkey", left.alias("left"), bottom.alias("bottom"), (left + 20).alias("right"), (bottom + F.col("s_suppkey") % 40).alias("top"))
    slabs = spark.createDataFrame([(k, 0.0, float(128 - (k + 1) * 16), 128.0, float(128 - k * 16)) for k in range(8)], "stripe int, left double, bottom double, right double, top double")
    return composite.overlapping(boxes, slabs).select("s_suppkey", "stripe")


def coverage_grid(spark, d):
    return distance.coverage(layers(spark, d), "water", GRID, 10, 0.5)


def distance_edt(spark, d):
    return _distances(layers(spark, d), "water").select("row", "col", rint(F.col("distance"), 4).alias("distance"))


def nearest_water_elevation(spark, d):
    base = materialise(layers(spark, d), "layers")
    out = distance.above_nearest(base, _distances(base, "water"))
    return out.select("row", "col", "near_row", "near_col", rint(F.col("rise"), 4).alias("rise"))


def binary_opening(spark, d):
    return sites.candidates(_parity(spark, d)).select("row", "col", "mask")


def edge_fraction(spark, d):
    return sites.zonal(_labelled(spark, d)).select("label", rint(F.col("edge_fraction"), 4).alias("edge_fraction"))


def connected_components(spark, d):
    return _components(spark, d)


def component_area_filter(spark, d):
    return components.sizes(_components(spark, d)).filter(F.col("pixels") >= components.least_pixels(0.5, GRID.res))


def zonal_stats(spark, d):
    z = sites.zonal(_labelled(spark, d))
    return z.select("label", "n", *[rint(F.col(c).cast("double"), 3).alias(c) for c in ("mean_score", "max_score", "mean_slope", "max_slope", "min_road", "min_water", "mean_elevation", "mean_row", "mean_col")])


def dominant_class(spark, d):
    return sites.dominant(_labelled(spark, d)).select("label", "dominant", landcover.named(F.col("dominant")).alias("name"))


def site_flags(spark, d):
    z = sites.zonal(_labelled(spark, d)).withColumn("area", F.col("n") * 0.01)
    return z.select("label", F.array_join(sites.flags(), "; ").alias("flags"))


def top_sites(spark, d):
    """The flagship: scored stack, cleaned, labelled, described and ranked."""
    best = sites.extract(_stack(spark, d), GRID, exact=False)
    return best.withColumn("flags", F.array_join("flags", "; "))


def suitability_parity(spark, d):
    return _parity(spark, d).select("row", "col", "score")


def suitability_weighted(spark, d):
    return _stack(spark, d).select("row", "col", scoring.weighted().alias("score"))


def score_summary(spark, d):
    return scoring.score_summary(_parity(spark, d))


def sensitivity(spark, d):
    """The best label of each scenario and whether it is the unchanged weights' best; all scenarios in one aggregation."""
    rows = _labelled(spark, d)
    named = [("base", dict(scoring.WEIGHTS)), *scoring.scenarios()]
    scores = rows.groupBy("label").agg(*[F.avg(scoring.weighted(w)).alias(f"s{i}") for i, (_, w) in enumerate(named)])
    long = scores.select("label", F.explode(F.array(*[F.struct(F.lit(n).alias("scenario"), rint(F.col(f"s{i}"), 6).alias("s")) for i, (n, _) in enumerate(named)])).alias("x")).select("label", "x.*")
    best = long.groupBy("scenario").agg(F.max_by("label", F.struct("s", -F.col("label"))).alias("best"), F.max("s").alias("score"))
    base = best.filter("scenario = 'base'").select(F.col("best").alias("base_best"))
    return best.crossJoin(F.broadcast(base)).select("scenario", "best", rint(F.col("score"), 3).alias("score"), (F.col("best") == F.col("base_best")).alias("same"))


def heatmap_rgb(spark, d):
    out = _parity(spark, d).select("row", "col", colours.score_rgb(F.col("score")).alias("c"))
    return out.select("row", "col", *[F.col("c")[i].alias(n) for i, n in enumerate("rgb")])


def class_rgb(spark, d):
    out = layers(spark, d).select("row", "col", colours.class_rgb(F.col("landcover")).alias("c"))
    return out.select("row", "col", *[F.col("c")[i].alias(n) for i, n in enumerate("rgb")])


def quicklook_stretch(spark, d):
    c = _composite(spark, d).select("row", "col", F.nullif("red", F.lit(0)).cast("double").alias("v"))
    ends = c.agg(F.percentile("v", F.lit(0.02)).alias("lo"), F.percentile("v", F.lit(0.98)).alias("hi"))  # one row
    return c.crossJoin(F.broadcast(ends)).select("row", "col", colours.stretched(F.col("v"), F.col("lo"), F.col("hi")).alias("byte"))


def decimate_average(spark, d):
    out = resample.averaged(layers(spark, d), "elevation", 4)
    return out.select("row", "col", rint(F.col("elevation") + NUDGE, 4).alias("elevation"))


def decimate_nearest(spark, d):
    return resample.decimated(_parity(spark, d).select("row", "col", "score"), 3)


def stripe_partition(spark, d):
    return looks(spark, d).groupBy(F.expr("CAST(row DIV 24 AS INT)").alias("stripe")).agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first_row"), F.max("row").alias("last_row"))


def split_expand_buffer(spark, d):
    return _split(spark)


def patch_origins(spark, d):
    parts = [splits.patch_origins(_split(spark), GRID, v, PATCH, s).withColumn("split", F.lit(v)).withColumn("stride", F.lit(s)) for v in (splits.TRAIN, splits.VAL) for s in (PATCH, PATCH // 2)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def class_balance(spark, d):
    return splits.class_balance(_split(spark), layers(spark, d))


def split_shares(spark, d):
    return splits.shares(_split(spark))


def band_stats(spark, d):
    return stats.band_statistics(_composite(spark, d), BANDS)


def train_vs_region_stats(spark, d):
    both = _composite(spark, d).join(_split(spark), ["row", "col"])
    table_ = stats.band_statistics(both, BANDS, {"train": F.col("split") == splits.TRAIN, "whole": F.lit(True)})
    return stats.drift(table_)


def scene_search(spark, d):
    e = _scenes(spark, d).withColumns({"west": (F.col("id") % 10).cast("double"), "south": (F.col("id") % 7).cast("double")}).withColumns({"east": F.col("west") + 1, "north": F.col("south") + 1})
    return scenes.search(e, (2.0, 1.0, 4.5, 3.0), "2024-01-05 00:00:00", "2024-01-20 00:00:00", 40.0).select("id", "tile", "cloud")


def scene_topn(spark, d):
    return scenes.select_per_tile(_scenes(spark, d)).select("tile", "id", "cloud")


def scene_report(spark, d):
    return scenes.report(scenes.select_per_tile(_scenes(spark, d)))


def scene_properties(spark, d):
    old = F.create_map(F.lit("s2:mgrs_tile"), F.col("tile"), F.lit("proj:epsg"), F.lit("32644"))
    new = F.create_map(F.lit("grid:code"), F.concat(F.lit("MGRS-"), F.col("tile")), F.lit("proj:code"), F.lit("EPSG:32646"))
    rows = _scenes(spark, d).withColumn("p", F.when(F.col("id") % 2 == 0, old).otherwise(new))
    return rows.groupBy(scenes.tile_of(F.col("p")).alias("tile"), scenes.epsg_of(F.col("p")).alias("epsg")).agg(F.count(F.lit(1)).alias("n"))


def tile_starvation(spark, d):
    s = _scenes(spark, d).withColumn("tile", F.concat("event_type", F.lit("-"), F.col("id") % 97))
    return scenes.starved_tiles(s, s.filter("cloud < 8"))


def manifest_json(spark, d):
    kept = scenes.select_per_tile(_scenes(spark, d)).select("id", "tile", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("datetime"), F.col("cloud").alias("cloud_pct"))
    rows = scenes.manifest(kept, "A", "events", "2024-01-01/2024-01-31")
    text = scenes.manifest_json(rows)
    back = text.select(F.from_json("value", scenes.MANIFEST.replace("id:string", "id:long")).alias("m"))
    return back.select("m.region", "m.scene_count", F.posexplode("m.scenes").alias("place", "s")).select("region", "scene_count", "place", F.col("s.id").alias("id"), F.col("s.tile").alias("tile"), F.col("s.datetime").alias("datetime"))


def _numerals(spark, d, name, *key):
    """Each numeral of a table's texts, once for each key. Only numbers go to Python, not texts; unlike numbers can end in one numeral."""
    found = table(spark, d, name).select(*key, F.explode(numerals(F.col("text"))).alias("x"))
    return found.select(*key, normalised_numeral(F.col("x")).alias("numeral")).distinct()


def numeral_extract(spark, d):
    return _numerals(spark, d, "documents", "doc_id")


def numeral_verify(spark, d):
    """Numerals of documents that the benchmark's texts don't hold, by anti-join."""
    own = numeral_extract(spark, d).groupBy("numeral").agg(F.count(F.lit(1)).alias("docs"))
    return own.join(_numerals(spark, d, "benchmark"), "numeral", "left_anti")


def verdict_bucket(spark, d):
    word = bucket(F.col("l_quantity") * 2, report.VERDICTS)
    return table(spark, d, "lineitem").groupBy(word.alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


def _pairs(spark, d):
    return table(spark, d, "embeddings").select(F.col("label").alias("label"), F.when(F.col("vec_id") % 3 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("int").alias("pred"))


def confusion_matrix(spark, d):
    return stats.confusion(_pairs(spark, d))


def miou_f1(spark, d):
    return stats.agreement(stats.confusion(_pairs(spark, d)))


def class_weights(spark, d):
    return stats.class_weights(layers(spark, d))


def wet_label_agreement(spark, d):
    return stats.wet_agreement(layers(spark, d).join(_composite(spark, d), ["row", "col"]), nir_below=5000)


def window_values(spark, d):
    return layers(spark, d).filter("row BETWEEN 60 AND 67 AND col BETWEEN 60 AND 67 AND landcover != 0").select("landcover").distinct()


def utm_forward(spark, d):
    e = table(spark, d, "events").select("event_id", (77.75 + (F.col("event_id") % 600) / 1000.0).alias("lon"), (29.9 + (F.col("event_id") % 587) / 1000.0).alias("lat"))
    x, y = utm.project(F.col("lon"), F.col("lat"), 32644)
    return e.select("event_id", rint(x, 2).alias("x"), rint(y, 2).alias("y"))


def utm_inverse(spark, d):
    e = table(spark, d, "events").select("event_id", (186140.0 + (F.col("event_id") % 5953) * 10).alias("x"), (3310650.0 + (F.col("event_id") % 6800) * 10).alias("y"))
    lon, lat = utm.unproject(F.col("x"), F.col("y"), 32644)
    return e.select("event_id", rint(lon, 6).alias("lon"), rint(lat, 6).alias("lat"))


def _segments(spark, d):
    s = table(spark, d, "supplier")
    k = F.col("s_suppkey")
    return s.select(k.alias("id"), (k * 17 % 1280 / 10.0 + 0.05).alias("x0"), (k * 29 % 1280 / 10.0 + 0.05).alias("y0"), (k * 43 % 1280 / 10.0 + 0.03).alias("x1"), (k * 71 % 1280 / 10.0 + 0.03).alias("y1"))


def rasterize_segments(spark, d):
    return resample.touched_by_segments(_segments(spark, d), GRID)


# The whole raster as one of 30 m pixels, and a grid of 20 m pixels over it.
SOURCE = Grid(32644, 186140.0 - 7, 3378690.0 + 11, 30.0, SIDE, SIDE)
FINE = Grid(32644, 186140.0, 3378690.0, 20.0, 190, 190)


def resample_bilinear(spark, d):
    coarse = layers(spark, d).select("row", "col", F.when(~((F.col("row") == 20) & (F.col("col") == 20)), F.col("elevation")).alias("elevation"))
    out = resample.resample(coarse, "elevation", SOURCE, FINE, "bilinear")
    return out.select("row", "col", rint(F.col("elevation") + NUDGE, 4).alias("elevation"))


def resample_cubic(spark, d):
    out = resample.resample(layers(spark, d).select("row", "col", "elevation"), "elevation", SOURCE, FINE, "cubic")
    return out.select("row", "col", rint(F.col("elevation") + NUDGE, 4).alias("elevation"))


def resample_nearest(spark, d):
    return resample.resample(layers(spark, d).select("row", "col", "landcover"), "landcover", SOURCE, FINE, "nearest").withColumn("landcover", F.col("landcover").cast("int"))


def _triangles(spark: SparkSession, d: str) -> DataFrame:
    """The edges of a small triangle for each supplier, in grid pixels."""
    k = F.col("s_suppkey")
    x, y = k * 17 % 1100 / 10.0 + 0.05, k * 29 % 1100 / 10.0 + 0.05
    corners = [(x, y), (x + k % 13 + 1.13, y + 2.31), (x + 3.17, y + k % 11 + 4.23)]
    edges = [F.struct(*[c.alias(n) for c, n in zip((*a, *b), ("x0", "y0", "x1", "y1"), strict=True)]) for a, b in zip(corners, [*corners[1:], corners[0]], strict=True)]
    return table(spark, d, "supplier").select(k.alias("id"), F.explode(F.array(*edges)).alias("e")).select("id", "e.*")


def polygon_fill(spark, d):
    """Pixels of triangles by the even-odd rule and by touch."""
    return resample.filled_polygons(_triangles(spark, d), GRID)


def scene_footprints(spark, d):
    """Boxes of a neighbouring zone as bounds in the grid's zone."""
    k = F.col("s_suppkey")
    left, bottom = (700_000 + k * 37 % 900 * 100).cast("double"), (3_300_000 + k * 53 % 700 * 100).cast("double")
    boxes = table(spark, d, "supplier").select(k.alias("id"), F.lit(32643).alias("epsg"), left.alias("left"), bottom.alias("bottom"), (left + 1000 + k % 50 * 100).alias("right"), (bottom + 2000.0).alias("top"))
    return resample.footprints(boxes, GRID).select("id", *[rint(F.col(c), 2).alias(c) for c in ("left", "bottom", "right", "top")])


def exact_rounding(spark, d):
    """Whole eighths, which binary numbers hold exactly, to two places."""
    rows = table(spark, d, "lineitem").select((F.col("l_quantity") / 8).alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    return rows.select("v", exact_round(2)(F.col("v")).alias("rounded"), "n")


def region_grids(spark, d):
    """The grids that follow from the regions' boxes."""
    grids = [(r.id, g.epsg, g.x0, g.y0, g.res, g.width, g.height) for r in REGIONS.values() for g in [grid_for(r)]]
    return spark.createDataFrame(grids, "id string, epsg int, x0 double, y0 double, res double, width int, height int")


def seeded_blocks(spark, d):
    """The validation blocks that the seed draws, against those that are frozen."""
    rows = [(r.id, *b) for r in REGIONS.values() for b in splits.chosen_blocks(splits.block_shape(grid_for(r).height, grid_for(r).width))]
    return spark.createDataFrame(rows, "id string, block_row int, block_col int")


def clean_pixels(spark, d):
    """Erosion alone: cores of the plain score's good ground."""
    rows = _parity(spark, d).withColumn("core", F.col("score") > 0)
    return morphology.eroded(rows, "core").select("row", "col", "core")


def region_catalog(spark, d):
    from gridloom.grid import region_table

    return region_table(spark).select("id", "name", "epsg", F.col("bbox.west").alias("west"), F.col("bbox.north").alias("north"))


NAMES = tuple("""composite_median composite_quality landcover_recode landcover_histogram missing_classes elevation_summary horn_slope slope_exceedance coarse_slope
layer_stack_valid window_clip mosaic_first_wins tile_resolution cover_tile_resolution road_filter water_filter bbox_overlap coverage_grid distance_edt
nearest_water_elevation binary_opening clean_pixels edge_fraction connected_components component_area_filter zonal_stats dominant_class site_flags top_sites
suitability_parity suitability_weighted score_summary sensitivity heatmap_rgb class_rgb quicklook_stretch decimate_average decimate_nearest stripe_partition
split_expand_buffer patch_origins class_balance split_shares band_stats train_vs_region_stats scene_search scene_topn scene_report scene_properties
tile_starvation manifest_json numeral_extract numeral_verify verdict_bucket confusion_matrix miou_f1 class_weights wet_label_agreement window_values
utm_forward utm_inverse rasterize_segments resample_bilinear resample_cubic resample_nearest region_catalog polygon_fill scene_footprints exact_rounding region_grids seeded_blocks""".split())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: globals()[name] for name in NAMES}


__all__ = ["NAMES", "queries", "virtual", *NAMES]
