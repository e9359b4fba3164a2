import json
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.grid import REGIONS, Grid, Window, grid_for
from gridloom.operators import composite, resample, scenes
from gridloom.operators.resample import lanes
from gridloom.plans import analyze, build, compositing, quicklook, report
from gridloom.sources import layers, osm, png, tiff
from gridloom.streaming import arrivals

G = Grid(32644, 500000.0, 3000000.0, 10.0, 60, 50)


@pytest.mark.parametrize("dtype", ["uint8", "uint16", "int16", "float32"])
def test_tiff_round_trip_and_windows(spark, tmp_path, dtype):
    g = Grid(32644, 500000.0, 3000000.0, 10.0, 700, 530)
    a = (np.random.default_rng(2).random((2, 530, 700)) * 200).astype(dtype)
    path = str(tmp_path / "a.tif")
    tiff.write(path, a, g, nodata=0 if dtype != "float32" else -9999)
    assert tiff.read_header(path).grid == g
    df = tiff.read(spark, path, Window(500, 505, 100, 20))
    rows = {(r["row"], r["col"]): (r.band1, r.band2) for r in df.collect()}
    assert len(rows) == 2000
    for (r, c), (x, y) in list(rows.items())[::37]:
        for got, want in ((x, a[0, r, c]), (y, a[1, r, c])):
            assert (got is None and want == 0) or got == pytest.approx(float(want))


def test_stripes_of_any_layer(spark, tmp_path):
    a = np.random.default_rng(6).random((50, 60))
    layer = lanes(a, spark, "v").withColumn("v", F.when(F.col("col") != 7, F.col("v")))
    files = tiff.write_stripes(layer, ["v"], G, f"file://{tmp_path}/t", "float32", -9999.0, stripe=20).orderBy("stripe").collect()
    assert [f.file for f in files] == ["stripe-000000.tif", "stripe-000001.tif", "stripe-000002.tif"]
    last = tiff.read(spark, str(tmp_path / "t" / files[2].file))
    assert tiff.read_header(str(tmp_path / "t" / files[2].file)).grid.y0 == G.y0 - 400
    rows = {(r["row"], r["col"]): r.band1 for r in last.collect()}
    assert len(rows) == 600 and rows[(3, 7)] is None and rows[(3, 8)] == pytest.approx(a[43, 8], abs=1e-6)


def test_quicklooks(spark, tmp_path):
    layer = lanes(np.random.default_rng(6).random((50, 60)), spark, "v").withColumn("c", F.lit(2))
    assert quicklook.quicklook(layer.select("row", "col", "v"), G, str(tmp_path / "a.png"), width=20) == (20, 17)
    assert quicklook.quicklook(layer, G, str(tmp_path / "b.png"), ["c"], categorical=True) == (60, 50)
    assert (tmp_path / "a.png").read_bytes()[:4] == b"\x89PNG"


def test_footprints(spark):
    rows = [("a", 32643, 699960.0, 3290220.0, 809760.0, 3400020.0), ("b", 32644, 199980.0, 3290220.0, 309780.0, 3400020.0)]
    df = spark.createDataFrame(rows, "id string, epsg int, left double, bottom double, right double, top double")
    got = {r.id: r for r in resample.footprints(df, G).collect()}
    assert [round(got["b"][c], 3) for c in ("left", "bottom", "right", "top")] == [199980.0, 3290220.0, 309780.0, 3400020.0]
    assert 110_000 < got["a"].left < 150_000 and got["a"].right > got["a"].left + 100_000


def test_band_names():
    assert tiff.bands_named(["a"], None) == [1] and tiff.bands_named(["a", "b", "c", "d"], None) == [1, 2, 3]
    assert tiff.bands_named(["a", "b"], ["b", 1]) == [2, 1]
    with pytest.raises(ValueError):
        tiff.bands_named(["a"], ["z"])


def test_png(spark, tmp_path):
    frame = lanes(np.arange(6).reshape(2, 3), spark, "v").withColumn("rgb", F.array("v", F.lit(7), F.lit(9)))
    png.picture(frame, "rgb", 3, 2, str(tmp_path / "p.png"))
    data = (tmp_path / "p.png").read_bytes()
    at = data.index(b"IDAT")
    n = struct.unpack(">I", data[at - 4 : at])[0]
    assert np.frombuffer(zlib.decompress(data[at + 4 : at + 4 + n]), np.uint8).reshape(2, 10)[1, 1:4].tolist() == [3, 7, 9]
    with pytest.raises(ValueError):
        png.picture(frame, "rgb", 10**5, 10**5, str(tmp_path / "q.png"))


def _v(n):
    out = b""
    while True:
        out += bytes([n & 127 | (128 if n > 127 else 0)])
        n >>= 7
        if not n:
            return out


def _f(k, data):
    return _v(k << 3 | 2) + _v(len(data)) + data if isinstance(data, bytes) else _v(k << 3) + _v(data)


def test_osm_lines(spark, tmp_path):
    z = lambda x: x << 1 if x >= 0 else (-x << 1) - 1
    deltas = lambda xs: b"".join(_v(z(b - a)) for a, b in zip([0, *xs], xs))
    strings = [b"", b"highway", b"primary", b"name", b"X"]
    dense = _f(1, deltas([10, 11, 15])) + _f(8, deltas([300000000, 300010000, 300020000])) + _f(9, deltas([780000000, 780010000, 780020000])) + _f(10, b"\0" + _v(3) + _v(4) + b"\0" + b"\0")
    way = _f(1, 77) + _f(2, _v(1)) + _f(3, _v(2)) + _f(8, deltas([10, 15, 11]))
    block = _f(1, b"".join(_f(1, s) for s in strings)) + _f(2, _f(2, dense)) + _f(2, _f(3, way))
    body = b""
    for kind, raw in ((b"OSMHeader", b""), (b"OSMData", block)):
        blob = _f(2, len(raw)) + _f(3, zlib.compress(raw))
        head = _f(1, kind) + _f(3, len(blob))
        body += struct.pack(">I", len(head)) + head + blob
    (tmp_path / "x.osm.pbf").write_bytes(body)
    rows = osm.read(spark, str(tmp_path / "x.osm.pbf"))
    assert {(r.kind, r.id) for r in rows.collect()} == {("node", 10), ("node", 11), ("node", 15), ("way", 77)}
    line = osm.lines(rows, scenes.is_road(F.col("tags")), (77.9, 29.9, 78.1, 30.1)).first()
    assert line.tags == {"highway": "primary"} and [round(p.lat, 4) for p in line.points] == [30.0, 30.002, 30.001]
    assert osm.lines(rows, scenes.is_road(F.col("tags")), (0.0, 0.0, 1.0, 1.0)).count() == 0
    assert rows.filter("id = 11").first().tags == {"name": "X"}


def _layers(spark, root, g=G):
    r, c = F.col("row"), F.col("col")
    base = g.pixels(spark)
    for name, value in {"slope": F.abs(c - 30) * 0.6, "landcover": F.when(r < 5, 6).otherwise(2), "elevation": 500.0 + r, "dist_road": c * 10.0, "dist_water": r * 10.0}.items():
        layers.write(base.withColumn(name, value), root, "A", name, g)


def test_layers_check_missing_and_windows(spark, tmp_path):
    root = f"file://{tmp_path}"
    assert layers.missing(spark, root, "A") == list(layers.NAMES)
    with pytest.raises(FileNotFoundError):
        layers.load(spark, root, "A", G)
    _layers(spark, root)
    assert layers.missing(spark, root, "A") == [] and layers.load(spark, root, "A", G, Window(3, 4, 5, 6)).count() == 30
    with pytest.raises(ValueError, match="not on the grid"):
        layers.load(spark, root, "A", Grid(32644, 500005.0, 3000000.0, 10.0, 60, 50))
    with pytest.raises(ValueError, match="expected all"):
        layers.write(G.pixels(spark).filter("row > 0").withColumn("slope", F.lit(1.0)), root, "A", "slope", G)
    assert layers.probe(spark, root, "A", "elevation", G, 4).count() == 16
    plan = layers.scan(spark, root, "A", "elevation", Window(3, 4, 5, 6)).select("elevation")._jdf.queryExecution().executedPlan().toString()
    assert "stripe" in plan.split("PartitionFilters: ")[1].split("]")[0] and "GreaterThanOrEqual(row,4)" in plan and "elevation" in plan.split("ReadSchema: ")[1]
    table = layers.health(spark, {"good": lambda: 1, "bad": lambda: 1 / 0})
    assert {(r.name, r.ok) for r in table.collect()} == {("good", True), ("bad", False)}


def test_analyze_end_to_end(spark, tmp_path):
    root = f"file://{tmp_path}/layers"
    _layers(spark, root)
    document = analyze.analyze(spark, root, "A", out_dir=str(tmp_path / "out"), grid=G)
    assert document["sites"] and {p.name for p in (tmp_path / "out").iterdir()} >= {"suitability_heatmap.png", "suitability.tif", "sites.json", "sites.report.md", "suitability"}
    again = json.loads((tmp_path / "out" / "sites.json").read_text())
    assert again == json.loads(json.dumps(document)) and not report.invented((tmp_path / "out" / "sites.report.md").read_text(), again)
    assert spark.read.parquet(str(tmp_path / "out" / "suitability")).count() == 3000
    part = analyze.polygon_pixels(layers.load(spark, root, "A", G), [(81.0, 27.0)] * 3, G)
    assert part.count() == 0
    from gridloom.functions import utm

    ring = [utm.unproject(500000.0 + x, 3000000.0 - y, 32644, utm.NUMBERS) for x, y in ((105, 105), (505, 105), (505, 405), (105, 405))]
    inside = analyze.analyze(spark, root, "A", polygon=ring, grid=G)
    assert sum(s["area_ha"] for s in inside["sites"]) <= 12.8
    with pytest.raises(ValueError, match="limit"):
        analyze.window_of("A", (78.0, 30.0, 78.2, 30.2), grid_for(REGIONS["A"]), analyze.MOST_KM2)


def test_composites_resume_by_signature(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(int(s), int(r), int(c), 4, int(rng.integers(1, 99))) for s in range(3) for r in range(50) for c in range(0, 60, 3)]
    looks = spark.createDataFrame(rows, "scene int, row int, col int, scl int, red int")
    path = f"file://{tmp_path}/composite"
    assert compositing.run(looks, G, ["red"], path, stripe=16, stripes=2) == [0, 1]
    assert compositing.run(looks, G, ["red"], path, stripe=16) == [2, 3]
    assert compositing.run(looks, G, ["red"], path, stripe=16) == []
    want = composite.on_grid(composite.median_composite(looks, ["red"]), G, ["red"])
    assert spark.read.parquet(path + "/pixels").select("row", "col", "red", "clear").exceptAll(want).count() == 0
    assert compositing.run(looks.filter("scene < 2"), G, ["red"], path, stripe=16) == [0, 1, 2, 3]


def test_streams_follow_arriving_scenes(spark, tmp_path):
    schema = "scene int, row int, col int, scl int, red int, ts timestamp"
    rows = [(s, r, c, 4 + s, 10 * s + r, None) for s in range(3) for r in range(20) for c in range(10)]
    looks = spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("scene")))
    g = Grid(32644, 0.0, 0.0, 10.0, 10, 20)
    looks.filter("scene < 2").coalesce(1).write.parquet(str(tmp_path / "in"))
    go = lambda: arrivals.follow(arrivals.looks_stream(spark, str(tmp_path / "in"), schema), g, ["red"], str(tmp_path / "looks"), str(tmp_path / "made"), str(tmp_path / "check"), 8).awaitTermination()
    go()
    looks.filter("scene = 2").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    go()
    want = composite.on_grid(composite.median_composite(looks, ["red"]), g, ["red"])
    got = spark.read.parquet(str(tmp_path / "made")).select("row", "col", "red", "clear")
    assert got.exceptAll(want).count() == 0 and got.count() == 200
    counts = arrivals.clear_counts(looks, 8)
    assert counts.agg(F.sum("clear")).first()[0] == 600


def test_builders(spark, tmp_path):
    root = f"file://{tmp_path}/b"
    src, g = Grid(32644, 499900.0, 3000100.0, 30.0, 20, 20), Grid(32644, 500000.0, 3000000.0, 10.0, 30, 24)
    z = lanes(np.add.outer(np.arange(20.0), np.arange(20.0)) * 3, spark, "elevation")
    s = build.build_terrain(z, src, g, root, "A").first()
    assert s["n"] == 720 and s["high"] < 15
    h = build.build_landcover(z.withColumn("code", F.lit(40)), src, g, root, "A").collect()
    assert [(r.landcover, r.pixels) for r in h] == [(3, 720)]
    from gridloom.functions import utm

    ring = [utm.unproject(500000.0 + x, 3000000.0 - y, 32644, utm.NUMBERS) for x, y in ((5.0, 5.0), (295.0, 235.0), (5.0, 235.0), (295.0, 5.0), (5.0, 5.0))]
    lines = spark.createDataFrame([(1, [dict(k=i, lon=a, lat=b) for i, (a, b) in enumerate(ring)]), (2, None)], "id long, points array<struct<k:int,lon:double,lat:double>>")
    with pytest.raises(ValueError, match="dist_road"):
        build.build_distance(lines, g, root, "A", "dist_road")
    assert build.build_distance(lines, g, root, "A", "dist_water").first()["low"] == 0.0
    both = g.pixels(spark).withColumn("split", F.when(F.col("row") < 12, 1).otherwise(2))
    bands = g.pixels(spark).withColumn("red", F.col("row") + 1)
    drift = build.freeze_statistics(bands, both, ("red",), f"{root}/stats").first()
    assert drift["gap"] == 6.0 and build.frozen_statistics(spark, f"{root}/stats").count() == 2
    with pytest.raises(FileNotFoundError):
        build.frozen_statistics(spark, f"{root}/none")
    text = json.loads(build.split_document(both, g, bands.withColumn("landcover", F.lit(2)), patch=6))
    assert text["patches"] == {"train": 10, "val": 10}


def test_manifest_round_trip(spark, tmp_path):
    rows = [(f"s{i}", f"2026-01-{i + 1:02d}T00:00:00Z", "43RGP", 32643, 1.5 * i, None, {"red": "x"}) for i in range(3)]
    kept = spark.createDataFrame(rows, "id string, datetime string, tile string, epsg int, cloud_pct double, nodata_pct double, assets map<string,string>")
    scenes.manifest_json(scenes.manifest(kept, "A", "c", "2026-01-01/2026-04-30")).coalesce(1).write.text(str(tmp_path / "m"))
    back = scenes.read_manifest(spark, str(tmp_path / "m"))
    assert [(r.id, r.scene_count, r.assets["red"]) for r in back.orderBy("id").collect()] == [("s0", 3, "x"), ("s1", 3, "x"), ("s2", 3, "x")]


SITE = dict(rank=1, lat=30.1, lon=78.2, score=71.5, score_max=88.0, area_ha=4.25, mean_slope_deg=2.1, max_slope_deg=4.0, dist_road_m=340, dist_water_m=120, mean_elevation_m=512.3, dominant_landcover="shrub+grass", flags=["small site: under 1 ha"])


def test_reports():
    document = {"region": "A", **report.PROVENANCE, "caveats": report.CAVEATS, "sites": [SITE]}
    text = report.render(document)
    assert not report.invented(text, document) and "Cautions: small site: under 1 ha." in text and "340" in text
    assert report.invented(text + " 1250", document) == ["1250"]
    assert "No candidate sites" in report.render({"region": "A", "sites": []})
    assert [report.verdict(x) for x in (95, 70, 55, 31, 5)] == ["strong", "strong", "workable", "marginal", "poor"]
    assert report.summarise({"sites": []}) == "no candidate sites met the minimum area and score"
    assert "#1  score  71.5" in report.summarise(document)
