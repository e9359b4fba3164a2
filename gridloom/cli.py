"""Command line: python -m gridloom.cli COMMAND, for the steps from staged files to a report."""

from __future__ import annotations

import argparse
import json
from pathlib import Path

from pyspark.sql import SparkSession

from gridloom.grid import REGIONS, grid_for
from gridloom.operators import splits
from gridloom.plans import analyze, compositing, ingest, quicklook, report
from gridloom.ship import ship
from gridloom.sources import tiff

BANDS = ("blue", "green", "red", "nir")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("grid", help="the regions' grids")
    verify = commands.add_parser("verify-sources", help="checks of the staged sources; the exit code tells whether all passed")
    select = commands.add_parser("select-scenes", help="pins the clearest scenes of each tile in a manifest")
    made = commands.add_parser("composite", help="the clear-sky composite, in stripes that resume")
    ground = commands.add_parser("terrain", help="elevation and slope from elevation tiles")
    cover = commands.add_parser("landcover", help="merged classes from land cover tiles")
    ways = commands.add_parser("osm", help="distances to roads and water from an extract")
    look = commands.add_parser("quicklook", help="a picture of a GeoTIFF")
    split = commands.add_parser("split", help="shares and patches of a region's split")
    norm = commands.add_parser("normalisation", help="frozen statistics of the training blocks")
    one = commands.add_parser("analyze", help="ranked sites of a region or a box")
    text = commands.add_parser("report", help="the report of a sites document")
    for p in (verify, select, made, ground, cover, ways, norm):
        p.add_argument("--region", choices=sorted(REGIONS), required=True)
    for name in ("catalog", "dem", "cover", "extract"):
        verify.add_argument(f"--{name}", required=True)
    select.add_argument("--catalog", required=True, help="a table of scenes")
    select.add_argument("--out", required=True, help="the folder of the manifest")
    made.add_argument("--looks", required=True, help="a table of scene, row, col, scl and bands")
    made.add_argument("--out", required=True)
    made.add_argument("--stripe-height", type=int, default=compositing.STRIPE)
    made.add_argument("--stripes", type=int, help="only the first stripes")
    made.add_argument("--max-scenes", type=int, help="only the first scenes")
    for p in (made, norm):
        p.add_argument("--bands", nargs="+", default=list(BANDS))
    for p in (ground, cover):
        p.add_argument("tiles", nargs="+", help="GeoTIFFs on one lattice, the first wins")
    ways.add_argument("extract")
    for p in (ground, cover, ways):
        p.add_argument("--layers", required=True, help="the folder of the layer tables")
    look.add_argument("raster")
    look.add_argument("--bands", nargs="+", help="band names or numbers from 1")
    look.add_argument("--width", type=int, default=1400)
    look.add_argument("--out")
    look.add_argument("--categorical", action="store_true")
    norm.add_argument("--composite", required=True, help="the composite's pixels")
    norm.add_argument("--out", required=True)
    norm.add_argument("--seed", type=int, default=splits.SEED)
    for p in (split, one):
        p.add_argument("--region", choices=sorted(REGIONS), default="A")
    split.add_argument("--block-px", type=int, default=splits.BLOCK)
    split.add_argument("--buffer-px", type=int, default=splits.BUFFER_PX)
    split.add_argument("--patch-px", type=int, default=splits.PATCH)
    split.add_argument("--seed", type=int, default=splits.SEED)
    one.add_argument("--layers", required=True, help="the folder of the layer tables")
    one.add_argument("--bbox", type=float, nargs=4, metavar=("WEST", "SOUTH", "EAST", "NORTH"))
    one.add_argument("--top", type=int, default=5)
    one.add_argument("--min-score", type=int, default=1)
    one.add_argument("--out-dir")
    text.add_argument("stats", type=Path)
    text.add_argument("--out", type=Path)
    a = parser.parse_args(argv)
    if a.command == "grid":
        for r in REGIONS.values():
            g = grid_for(r)
            print(f"{r.id} ({r.name}): EPSG:{g.epsg} {g.width} x {g.height} at {g.res:g} m, origin ({g.x0:.0f}, {g.y0:.0f})")
        return 0
    if a.command == "report":
        print(report.write(json.loads(a.stats.read_text()), str(a.out or a.stats.with_suffix(".report.md"))))
        return 0
    spark = SparkSession.builder.appName("gridloom").getOrCreate()
    ship(spark)
    if a.command == "verify-sources":
        rows = ingest.verify_sources(spark, REGIONS[a.region], a.catalog, a.dem, a.cover, a.extract).collect()
        for r in rows:
            print(f"[{' OK ' if r['ok'] else 'FAIL'}] {r['name']}\n      {r['detail']}")
        return int(not all(r["ok"] for r in rows))
    if a.command == "select-scenes":
        print(ingest.summary_line(ingest.select_scenes(spark, REGIONS[a.region], a.catalog, a.out)))
        return 0
    if a.command == "composite":
        done = ingest.composite(spark, REGIONS[a.region], a.looks, a.out, a.bands, a.stripe_height, a.stripes, a.max_scenes)
        print(f"stripes made: {done}")
        return 0
    if a.command in ("terrain", "landcover"):
        print(ingest.summary_line(getattr(ingest, a.command)(spark, REGIONS[a.region], a.tiles, a.layers)))
        return 0
    if a.command == "osm":
        for name, rows in ingest.distances(spark, REGIONS[a.region], a.extract, a.layers).items():
            print(f"{name}: {ingest.summary_line(rows)}")
        return 0
    if a.command == "quicklook":
        out = a.out or str(Path(a.raster).with_suffix(".quicklook.png"))
        width, height = quicklook.quicklook(tiff.read(spark, a.raster), tiff.read_header(a.raster).grid, out, a.bands, a.categorical, a.width)
        print(f"{out}: {width} x {height}")
        return 0
    if a.command == "normalisation":
        print(ingest.summary_line(ingest.normalisation(spark, REGIONS[a.region], a.composite, a.out, a.bands, a.seed)))
        return 0
    if a.command == "split":
        g = grid_for(REGIONS[a.region])
        blocks = splits.VAL_BLOCKS[a.region] if (a.seed, a.block_px) == (splits.SEED, splits.BLOCK) else splits.chosen_blocks(splits.block_shape(g.height, g.width, a.block_px), a.seed)
        table = splits.build(spark, g, blocks, a.block_px, a.buffer_px)
        for r in splits.shares(table).orderBy("split").collect():
            print(f"{('buffer', 'train', 'val')[r['split']]}: {r['pct']:.4f} %")
        for name, value in (("train", splits.TRAIN), ("val", splits.VAL)):
            print(f"{name} patches: {splits.patch_origins(table, g, value, a.patch_px).count()}")
        return 0
    document = analyze.analyze(spark, a.layers, a.region, tuple(a.bbox) if a.bbox else None, a.top, a.min_score, a.out_dir)
    print(report.summarise(document))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
