"""Scene catalogs: filters, property fallbacks, selection, manifests, and tile names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MAX_CLOUD, PER_TILE = 30.0, 12  # Fixed values: the catalog's cloud limit and the scenes kept for a tile.
SCENE = "id:string, datetime:string, tile:string, epsg:int, cloud_pct:double, nodata_pct:double, assets:map<string,string>"
MANIFEST = f"region string, collection string, date_range string, max_scene_cloud_pct double, max_scenes_per_tile int, scene_count int, scenes array<struct<{SCENE}>>"


def search(catalog: DataFrame, bbox: tuple[float, float, float, float], since: str, until: str, max_cloud: float = MAX_CLOUD) -> DataFrame:
    """Scenes whose box meets bbox, in a closed interval, with cloud strictly below the limit; all three reach the scan."""
    west, south, east, north = bbox
    meets = (F.col("west") <= east) & (F.col("east") >= west) & (F.col("south") <= north) & (F.col("north") >= south)
    return catalog.filter(meets & F.col("ts").between(F.lit(since), F.lit(until)) & (F.col("cloud") < max_cloud))


def property_of(properties: Column, keys: list[tuple[str, str]]) -> Column:
    """The first property of keys that exists, less its prefix; none is an error."""
    found = [F.regexp_replace(F.try_element_at(properties, F.lit(k)), f"^{prefix}", "") for k, prefix in keys]
    return F.coalesce(*found, F.raise_error(F.lit(f"none of {', '.join(k for k, _ in keys)}")))


def tile_of(properties: Column) -> Column:
    return property_of(properties, [("grid:code", "MGRS-"), ("s2:mgrs_tile", "")])


def epsg_of(properties: Column) -> Column:
    return property_of(properties, [("proj:epsg", ""), ("proj:code", "EPSG:")]).cast("int")


def select_per_tile(scenes: DataFrame, per_tile: int = PER_TILE) -> DataFrame:
    """The clearest scenes of each tile; of equal clouds the smaller id. Ranks stop at per_tile inside each task first."""
    order = Window.partitionBy("tile").orderBy("cloud", "id")
    return scenes.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= per_tile).drop("nth")


def starved_tiles(scenes: DataFrame, kept: DataFrame) -> DataFrame:
    """Tiles of all scenes that have none left."""
    return scenes.select("tile").distinct().join(kept.select("tile").distinct(), "tile", "left_anti")


def report(kept: DataFrame) -> DataFrame:
    """Scenes, cloud range and months by tile."""
    months = kept.groupBy("tile", F.month("ts").alias("m")).agg(F.count(F.lit(1)).alias("k"), F.min("cloud").alias("lo"), F.max("cloud").alias("hi"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("m", "k"))), lambda x: F.concat(x["m"].cast("string"), F.lit("x"), x["k"].cast("string"))), " ")
    return months.groupBy("tile").agg(F.sum("k").alias("scenes"), F.min("lo").alias("min_cloud"), F.max("hi").alias("max_cloud"), text.alias("months"))


def manifest(kept: DataFrame, region: str, collection: str, date_range: str, max_cloud: float = MAX_CLOUD, per_tile: int = PER_TILE) -> DataFrame:
    """One row: the manifest's fields with scenes by tile and time. kept is at most per_tile rows for each tile."""
    fields = [c for c in ("id", "datetime", "tile", "epsg", "cloud_pct", "nodata_pct", "assets") if c in kept.columns]
    key = lambda s: F.struct(s["tile"], s["datetime"], s["id"])
    scenes = F.array_sort(F.collect_list(F.struct(*fields)), lambda a, b: F.when(key(a) < key(b), -1).when(key(a) > key(b), 1).otherwise(0))
    return kept.agg(scenes.alias("scenes")).select(
        F.lit(region).alias("region"), F.lit(collection).alias("collection"), F.lit(date_range).alias("date_range"), F.lit(float(max_cloud)).alias("max_scene_cloud_pct"),
        F.lit(per_tile).alias("max_scenes_per_tile"), F.size("scenes").alias("scene_count"), "scenes",
    )


def manifest_json(rows: DataFrame) -> DataFrame:
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row for each scene of a manifest file, with the header's fields beside it."""
    return spark.read.schema(MANIFEST).json(path, multiLine=True).withColumn("scene", F.explode("scenes")).drop("scenes").select("*", "scene.*").drop("scene")


def corner(value: Column, positive: str, negative: str, digits: int) -> Column:
    return F.concat(F.when(value >= 0, positive).otherwise(negative), F.lpad(F.abs(value).cast("string"), digits, "0"))


def tiles(boxes: DataFrame, step: int = 1) -> DataFrame:
    """south and west corners of the tiles of ``step`` degrees that each box (west, south, east, north) needs, with their name part."""
    low = lambda c: (F.floor(F.col(c) / step) * step).cast("int")
    lat = boxes.withColumn("lat", F.explode(F.sequence(low("south"), low("north"), F.lit(step))))
    both = lat.withColumn("lon", F.explode(F.sequence(low("west"), low("east"), F.lit(step))))
    return both.withColumn("corner", F.concat(corner(F.col("lat"), "N", "S", 2), F.lit("_" if step == 1 else ""), corner(F.col("lon"), "E", "W", 3)))


def dem_tile_name(lat: Column, lon: Column) -> Column:
    return F.concat(F.lit("Copernicus_DSM_COG_10_"), corner(lat, "N", "S", 2), F.lit("_00_"), corner(lon, "E", "W", 3), F.lit("_00_DEM"))


def cover_tile_name(lat: Column, lon: Column) -> Column:
    return F.concat(F.lit("ESA_WorldCover_10m_2021_v200_"), corner(lat, "N", "S", 2), corner(lon, "E", "W", 3), F.lit("_Map"))


def mosaic(tiles: DataFrame, value: str) -> DataFrame:
    """One value for each pixel, from the first tile (least rank) that has one; combines on the map side."""
    seen = tiles.filter(F.col(value).isNotNull())
    return seen.groupBy("row", "col").agg(F.min_by(value, "rank").alias(value), F.min("rank").alias("rank"))


# Tags that count as roads and as perennial water.
ROADS = (
    "motorway", "trunk", "primary", "secondary", "tertiary", "unclassified", "residential", "service", "track",
    "motorway_link", "trunk_link", "primary_link", "secondary_link", "tertiary_link",
)
WATERWAYS, WATER_NATURAL, WATER_LANDUSE = ("river", "canal"), ("water",), ("reservoir", "basin")


def is_road(tags: Column) -> Column:
    return F.coalesce(F.try_element_at(tags, F.lit("highway")).isin(*ROADS), F.lit(False))


def is_water(tags: Column) -> Column:
    tag = lambda k: F.try_element_at(tags, F.lit(k))
    return F.coalesce(tag("waterway").isin(*WATERWAYS), F.lit(False)) | F.coalesce(tag("natural").isin(*WATER_NATURAL), F.lit(False)) | F.coalesce(tag("landuse").isin(*WATER_LANDUSE), F.lit(False))
