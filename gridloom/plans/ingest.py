"""From staged files to the layer tables: what each command of the command line does."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.grid import Grid, Region, Window, grid_for
from gridloom.operators import scenes, splits
from gridloom.plans import build, compositing
from gridloom.sources import layers, osm, tiff

PAD, PROBE, WINDOW = 0.05, 128, ("2026-01-01", "2026-04-30")  # Fixed values: degrees around a region's box, a probe's side, the imagery window.
PROBE_BOX = (78.00, 30.30, 78.03, 30.33)  # Fixed values: where roads are counted to test an extract.
COLLECTION = "sentinel-2-l2a"


def mosaic_of(spark: SparkSession, paths: Sequence[str], value: str) -> tuple[DataFrame, Grid]:
    """One value for each pixel of several files on one lattice, the first file's first, and the grid that holds them all."""
    grids = [tiff.read_header(p).grid for p in paths]
    base = grids[0]
    for p, g in zip(paths, grids, strict=True):
        off = ((g.x0 - base.x0) / base.res, (base.y0 - g.y0) / base.res)
        if (g.epsg, round(g.res / base.res, 9)) != (base.epsg, 1.0) or any(abs(k - round(k)) > 1e-3 for k in off):
            raise ValueError(f"{p} isn't on the lattice of {paths[0]}")
    west, north = min(g.x0 for g in grids), max(g.y0 for g in grids)
    east, south = max(g.bounds[2] for g in grids), min(g.bounds[1] for g in grids)
    whole = Grid(base.epsg, west, north, base.res, round((east - west) / base.res), round((north - south) / base.res))
    parts = None
    for rank, (p, g) in enumerate(zip(paths, grids, strict=True)):
        down, right = round((north - g.y0) / base.res), round((g.x0 - west) / base.res)
        rows = tiff.read(spark, p).select((F.col("row") + down).alias("row"), (F.col("col") + right).alias("col"), F.col("band1").alias(value), F.lit(rank).alias("rank"))
        parts = rows if parts is None else parts.unionByName(rows)
    return (parts.drop("rank") if len(paths) == 1 else scenes.mosaic(parts, value).select("row", "col", value)), whole


def terrain(spark: SparkSession, region: Region, paths: Sequence[str], root: str, grid: Grid | None = None) -> DataFrame:
    mosaic, source = mosaic_of(spark, paths, "elevation")
    return build.build_terrain(mosaic, source, grid or grid_for(region), root, region.id)


def landcover(spark: SparkSession, region: Region, paths: Sequence[str], root: str, grid: Grid | None = None) -> DataFrame:
    mosaic, source = mosaic_of(spark, paths, "code")
    return build.build_landcover(mosaic.withColumn("code", F.col("code").cast("int")), source, grid or grid_for(region), root, region.id)


def distances(spark: SparkSession, region: Region, extract: str, root: str, grid: Grid | None = None) -> dict[str, DataFrame]:
    """Roads and water of an extract as two distance layers; closed ways that are water count with their inside."""
    box = osm.padded(region.bbox, PAD)
    road, water = build.roads_and_water()
    wet = osm.lines_of(spark, extract, water, box)
    first, last = F.element_at("points", 1), F.element_at("points", -1)
    closed = (first["lon"] == last["lon"]) & (first["lat"] == last["lat"])
    areas = wet.filter(closed & F.try_element_at("tags", F.lit("waterway")).isNull())
    own = grid or grid_for(region)
    return {
        "dist_road": build.build_distance(osm.lines_of(spark, extract, road, box), own, root, region.id, "dist_road"),
        "dist_water": build.build_distance(wet, own, root, region.id, "dist_water", areas),
    }


def composite(spark: SparkSession, region: Region, looks: str, out: str, bands: Sequence[str], stripe: int = compositing.STRIPE, stripes: int | None = None, max_scenes: int | None = None, grid: Grid | None = None) -> list[int]:
    """looks: a table of scene, row, col, scl and bands on the region's grid."""
    return compositing.run(spark.read.parquet(looks), grid or grid_for(region), bands, out, stripe, stripes=stripes, scenes=max_scenes)


def select_scenes(spark: SparkSession, region: Region, catalog: str, out: str) -> DataFrame:
    """Pins the clearest scenes of each tile in a manifest and returns their report. catalog: id, ts, tile, cloud, west to north, and what a manifest lists."""
    found = scenes.search(spark.read.parquet(catalog), region.bbox, f"{WINDOW[0]} 00:00:00", f"{WINDOW[1]} 23:59:59")
    if found.isEmpty():
        raise ValueError("the search returned no scenes: check the window and the cloud limit")
    kept = scenes.select_per_tile(found)
    listed = kept.withColumn("datetime", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).withColumn("cloud_pct", F.col("cloud").cast("double"))
    scenes.manifest_json(scenes.manifest(listed, region.id, COLLECTION, "/".join(WINDOW))).coalesce(1).write.mode("overwrite").text(out)
    return scenes.report(kept).withColumn("starved", F.lit(False)).unionByName(scenes.starved_tiles(found, kept).withColumn("starved", F.lit(True)), allowMissingColumns=True)


def normalisation(spark: SparkSession, region: Region, pixels: str, out: str, bands: Sequence[str], seed: int = splits.SEED, grid: Grid | None = None, block: int = splits.BLOCK, buffer_px: int = splits.BUFFER_PX) -> DataFrame:
    """Freezes the training blocks' statistics of a composite and returns their drift from the whole region's."""
    own = grid or grid_for(region)
    frozen = (seed, block) == (splits.SEED, splits.BLOCK) and grid is None
    blocks = splits.VAL_BLOCKS[region.id] if frozen else splits.chosen_blocks(splits.block_shape(own.height, own.width, block), seed)
    return build.freeze_statistics(spark.read.parquet(pixels), splits.build(spark, own, blocks, block, buffer_px), tuple(bands), out)


def probe_file(spark: SparkSession, path: str, side: int = PROBE) -> DataFrame:
    """The middle of a file: only the tiles under it are read."""
    g = tiff.read_header(path).grid
    return tiff.read(spark, path, Window(max((g.width - side) // 2, 0), max((g.height - side) // 2, 0), min(side, g.width), min(side, g.height)))


def verify_sources(spark: SparkSession, region: Region, catalog: str, dem: str, cover: str, extract: str, box: tuple[float, float, float, float] = PROBE_BOX) -> DataFrame:
    """(name, ok, detail) of the five staged sources, each checked on its own."""
    def pinned() -> str:
        n = scenes.search(spark.read.parquet(catalog), region.bbox, f"{WINDOW[0]} 00:00:00", f"{WINDOW[1]} 23:59:59").count()
        if not n:
            raise ValueError("no scene in the window")
        return f"{n} scenes under {scenes.MAX_CLOUD:g} % cloud"

    def heights() -> str:
        r = probe_file(spark, dem).agg(F.min("band1").alias("low"), F.max("band1").alias("high")).first()
        g = tiff.read_header(dem).grid
        return f"elevation {r.low:.0f}-{r.high:.0f} m, grid {g.height}x{g.width}, EPSG:{g.epsg}"

    def classes() -> str:
        seen = [int(r.band1) for r in probe_file(spark, cover, 2 * PROBE).filter("band1 != 0").select("band1").distinct().orderBy("band1").collect()]
        if not seen:
            raise ValueError("no class in the probe window")
        return f"classes in the probe window {seen}"

    def reachable() -> str:
        kinds = [k for _, _, k in osm.blobs(extract)]
        if "OSMData" not in kinds:
            raise ValueError("no data block")
        return f"{kinds.count('OSMData')} data blocks"

    def ways() -> str:
        n = osm.lines_of(spark, extract, F.try_element_at("tags", F.lit("highway")).isNotNull(), box).count()
        return f"{n} highway ways in the probe box"

    return layers.health(spark, {"scene catalog": pinned, "elevation tile": heights, "land cover tile": classes, "map extract": reachable, "map query": ways})


def summary_line(rows: DataFrame) -> str:
    """A frame of a few rows as lines of JSON."""
    return "\n".join(json.dumps(r.asDict(), default=str) for r in rows.collect())


__all__ = ["composite", "distances", "landcover", "mosaic_of", "normalisation", "select_scenes", "summary_line", "terrain", "verify_sources"]
