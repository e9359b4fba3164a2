"""What the plans must look like: exchanges, and predicates that reach the scan."""

import re

from pyspark.sql import functions as F

from gridloom.functions import utm
from gridloom.grid import Grid, Window
from gridloom.operators import halo, morphology, resample, terrain
from gridloom.plans import compositing
from gridloom.sources import layers

G = Grid(32644, 186140.0, 3378690.0, 10.0, 96, 200)


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def shuffles(df):
    text = plan(df)
    tree = text[: text.index("\n\n(1)")] if "\n\n(1)" in text else text
    return len(re.findall(r"\bExchange\b", tree))


def stored(spark, root):
    for name in layers.NAMES:
        rows = G.pixels(spark).withColumn(name, (F.col("row") * 1.0 + F.col("col") if name != "landcover" else F.col("col") % 6).cast("int" if name == "landcover" else "float"))
        layers.write(rows, root, "A", name, G)


def test_layers_align_with_one_shuffle_and_windows_reach_all_scans(spark, tmp_path):
    root = f"file://{tmp_path}"
    stored(spark, root)
    loaded = layers.load(spark, root, "A", G, Window(10, 20, 8, 8))
    assert shuffles(loaded) == 1 and plan(loaded).count("PartitionFilters: [isnotnull(stripe") == 5 and plan(loaded).count("GreaterThanOrEqual(row,20)") == 5
    rows = loaded.collect()
    assert len(rows) == 64 and all(r.valid and r.slope == r.row + r.col and r.landcover == r.col % 6 for r in rows)


def test_neighbourhood_chains_shuffle_once(spark):
    layer = G.pixels(spark).withColumn("v", F.col("row") * 1.0).withColumn("m", F.col("row") % 7 != 0)
    assert shuffles(terrain.horn_slope(layer, "v", G)) == 1
    assert shuffles(morphology.opened(layer, "m")) == 1 and shuffles(morphology.opened_with_core(layer, "m")) == 1


def test_stripes_of_any_height_give_the_same(spark, monkeypatch):
    layer = G.pixels(spark).withColumn("m", F.pmod(F.xxhash64("row", "col"), F.lit(6)) != 0)
    want = {tuple(r) for r in morphology.opened_with_core(layer, "m").collect()}
    for height in (3, 5, 200, 1000):
        dealt = halo.dealt
        monkeypatch.setattr(morphology, "dealt", lambda rows, n, height=height, dealt=dealt: dealt(rows, n, height))
        assert {tuple(r) for r in morphology.opened_with_core(layer, "m").collect()} == want
    assert len(want) == G.width * G.height and any(r[2] for r in want) and any(r[3] for r in want)


def test_resampling_shuffles_the_source_once(spark):
    source = Grid(G.epsg, G.x0 - 7, G.y0 + 11, 30.0, 40, 70)
    layer = source.pixels(spark).withColumn("v", F.col("row") * 2.0 + F.col("col"))
    out = resample.resample(layer, "v", source, G, "cubic")
    assert plan(out).count("FlatMapGroupsInPandas") >= 1
    scanned = re.findall(r"Exchange\n(?:.*\n)*?Arguments: hashpartitioning\((\w+)", plan(out))
    assert sum(k.startswith("tr") for k in scanned) <= 2  # the boxes' own rows, and the source's
    inner = out.filter("row BETWEEN 20 AND 150 AND col BETWEEN 20 AND 70").collect()
    assert len(inner) == 131 * 51
    for r in inner:  # cubic weights give a plane back
        y, x = resample.source_position(G, source, r.row, r.col)
        assert abs(r.v - (2 * y + x)) < 1e-6


def test_tiles_and_zones_make_no_seams(spark, monkeypatch):
    x, y = utm.project(*utm.unproject(G.x0, G.y0, G.epsg, utm.NUMBERS), 32643, utm.NUMBERS)
    source = Grid(32643, x - 300, y + 250, 25.0, 90, 110)
    layer = source.pixels(spark).withColumn("v", F.sin(F.col("row") * 0.3) + F.col("col") * 0.1)
    whole = {(r.row, r.col): r.v for r in resample.resample(layer, "v", source, G, "bilinear").collect()}
    monkeypatch.setattr(resample, "TILE", 13)
    tiled = {(r.row, r.col): r.v for r in resample.resample(layer, "v", source, G, "bilinear").collect()}
    assert whole and whole.keys() == tiled.keys() and max(abs(whole[k] - tiled[k]) for k in whole) < 1e-9


def test_stripes_reach_the_scan_and_grids_sign_apart(spark, tmp_path):
    G.pixels(spark).withColumn("scene", F.lit(1)).write.parquet(f"{tmp_path}/looks")
    rows = spark.read.parquet(f"{tmp_path}/looks").filter(compositing.row_ranges([0, 1, 4], 16))
    assert "LessThanOrEqual(row,31)" in plan(rows) and "GreaterThanOrEqual(row,64)" in plan(rows)
    assert {r.row for r in rows.select("row").distinct().collect()} == {*range(32), *range(64, 80)}
    moved = Grid(G.epsg, G.x0 + 10, G.y0, G.res, G.width, G.height)
    signs = [compositing.signature(["a"], g, 16, (4,), b) for g in (G, moved, Grid(32646, G.x0, G.y0, 10.0, 96, 200)) for b in (("red",), ("red", "nir"))]
    assert len(set(signs)) == 6
