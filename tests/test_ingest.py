"""From staged files to layers: formats, push-down, commands, and the score raster."""

import json
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom import cli
from gridloom.functions import utm
from gridloom.grid import REGIONS, Grid
from gridloom.operators import scenes
from gridloom.operators.resample import lanes
from gridloom.plans import analyze, ingest
from gridloom.sources import layers, osm, tiff

A = REGIONS["A"]
G = Grid(32644, 210000.0, 3340000.0, 10.0, 60, 50)


def lzw(data):
    """A plain packer: codes of the file format, with the early change of width."""
    table, width, bits, have, out = {bytes([i]): i for i in range(256)}, 9, 0, 0, bytearray()
    top = 258

    def put(code):
        nonlocal bits, have
        bits, have = bits << width | code, have + width
        while have >= 8:
            have -= 8
            out.append(bits >> have & 255)
        bits &= (1 << have) - 1

    put(256)
    word = b""
    for b in data:
        more = word + bytes([b])
        if more in table:
            word = more
            continue
        put(table[word])
        table[more], top, word = top, top + 1, bytes([b])
        if top == 1 << width and width < 12:
            width += 1
        if top >= 4095:
            put(256)
            table, width, top = {bytes([i]): i for i in range(256)}, 9, 258
    if word:
        put(table[word])
    put(257)
    return bytes(out + bytes([bits << (8 - have) & 255]) if have else out)


@pytest.mark.parametrize("data", [b"", b"a", b"ab" * 9000, bytes(range(256)) * 40, np.random.default_rng(1).integers(0, 9, 30_000).astype(np.uint8).tobytes(), np.random.default_rng(2).integers(0, 256, 20_000).astype(np.uint8).tobytes()])
def test_lzw_unpacks(data):
    assert tiff.unpack_lzw(lzw(data)) == data


@pytest.mark.parametrize("compression", [tiff.LZW, tiff.ZSTD])
def test_other_compressions_are_read(spark, tmp_path, monkeypatch, compression):
    import zstandard

    a = np.random.default_rng(3).integers(0, 500, (1, 70, 90)).astype("uint16")
    pack = {tiff.LZW: lzw, tiff.ZSTD: lambda b: zstandard.ZstdCompressor().compress(b)}[compression]
    monkeypatch.setattr(tiff, "DEFLATE", compression)
    monkeypatch.setattr(tiff, "encode", lambda t: pack(np.diff(t, axis=1, prepend=np.zeros((len(t), 1), t.dtype)).astype(t.dtype).tobytes()))
    blob = tiff.to_bytes(a, Grid(32644, 0.0, 0.0, 10.0, 90, 70))
    monkeypatch.undo()
    (tmp_path / "x.tif").write_bytes(blob)
    rows = tiff.read(spark, str(tmp_path / "x.tif")).toPandas()
    got = np.zeros((70, 90))
    got[rows["row"], rows["col"]] = rows["band1"]
    assert (got == a[0]).all()


@pytest.mark.parametrize("big", [False, True])
def test_one_file_of_any_layer(spark, tmp_path, monkeypatch, big):
    monkeypatch.setattr(tiff, "TILE", 16)
    g = Grid(32646, 579260.0, 3003940.0, 10.0, 75, 41)
    layer = g.pixels(spark).filter("NOT (row BETWEEN 16 AND 31 AND col BETWEEN 32 AND 47)").withColumn("a", (F.col("row") * 75 + F.col("col")).cast("double")).withColumn("b", F.when(F.col("col") % 2 == 0, F.col("row")))
    path = str(tmp_path / "one.tif")
    tiff.write_one(layer.repartition(7), ["a", "b"], g, f"file://{path}", "float32", -9999.0, ["first", "second"], big)
    h = tiff.read_header(path)
    assert (h.grid, h.bands, h.nodata) == (g, 2, -9999.0) and open(path, "rb").read(3)[2] == (43 if big else 42)
    rows = {(r.row, r.col): (r.band1, r.band2) for r in tiff.read(spark, path).collect()}
    assert len(rows) == 75 * 41 and {p.name for p in tmp_path.iterdir()} == {"one.tif"}
    for (r, c), (a, b) in rows.items():
        hole = 16 <= r <= 31 and 32 <= c <= 47
        assert a == (None if hole else r * 75 + c) and b == (None if hole or c % 2 else r)


def test_scores_are_a_raster_on_the_parent_grid(spark, tmp_path):
    root = f"file://{tmp_path}/layers"
    r, c = F.col("row"), F.col("col")
    for name, value in {"slope": F.abs(c - 30) * 0.6, "landcover": F.when(r < 5, 6).otherwise(2), "elevation": 500.0 + r, "dist_road": c * 10.0, "dist_water": r * 10.0}.items():
        layers.write(G.pixels(spark).withColumn(name, value), root, "A", name, G)
    box = [*utm.unproject(G.x0 + 104, G.y0 - 408, G.epsg, utm.NUMBERS), *utm.unproject(G.x0 + 507, G.y0 - 16, G.epsg, utm.NUMBERS)]
    analyze.analyze(spark, root, "A", tuple(box), out_dir=str(tmp_path / "out"), grid=G)
    for name in ("suitability.tif", "suitability_heatmap.png", "sites.json"):
        assert (tmp_path / "out" / name).stat().st_size > 0
    h = tiff.read_header(str(tmp_path / "out" / "suitability.tif"))
    assert (h.grid.epsg, h.grid.res, h.dtype, h.nodata) == (G.epsg, G.res, "u1", 0)
    assert (h.grid.x0 - G.x0) % G.res == 0 and (G.y0 - h.grid.y0) % G.res == 0 and h.grid.width < G.width
    scores = [x.band1 for x in tiff.read(spark, str(tmp_path / "out" / "suitability.tif")).collect()]
    assert max(s for s in scores if s) <= 100 and None in scores
    ring = [(box[0], box[1]), (box[2], box[1]), (box[2] + 1, box[3])]
    with pytest.raises(ValueError, match="outside"):
        analyze.analyze(spark, root, "A", polygon=ring, grid=G)


def test_tiles_become_layers(spark, tmp_path):
    """Two elevation tiles side by side in degrees, and a land cover tile on the grid."""
    lon, lat = utm.unproject(G.x0, G.y0, G.epsg, utm.NUMBERS)
    step = 0.0003
    west = Grid(4326, lon - 20 * step, lat + 20 * step, step, 24, 60)
    east = Grid(4326, west.x0 + 24 * step, west.y0, step, 40, 60)
    plane = lambda g: np.add.outer(np.zeros(g.height), (g.x0 - west.x0) / step + np.arange(g.width))[None].astype("float32")
    for name, g in (("w", west), ("e", east)):
        tiff.write(str(tmp_path / f"{name}.tif"), plane(g) * 10, g, -9999.0)
    root, paths = f"file://{tmp_path}/layers", [str(tmp_path / "w.tif"), str(tmp_path / "e.tif")]
    mosaic, whole = ingest.mosaic_of(spark, paths, "elevation")
    assert (whole.width, whole.height) == (64, 60) and mosaic.filter("elevation != col * 10").count() == 0 and mosaic.count() == 64 * 60
    s = ingest.terrain(spark, A, paths, root, G).first()
    assert s["n"] == G.width * G.height and 10 < s["low"] <= s["high"] < 25
    codes = np.where(np.arange(60)[None, :] < 30, 40, 80) * np.ones((50, 1))
    tiff.write(str(tmp_path / "c.tif"), codes[None].astype("uint8"), G, 0)
    shares = {r.landcover: r.pixels for r in ingest.landcover(spark, A, [str(tmp_path / "c.tif")], root, G).collect()}
    assert shares[3] == 1500 and shares[6] == 1500
    with pytest.raises(ValueError, match="lattice"):
        ingest.mosaic_of(spark, [paths[0], str(tmp_path / "c.tif")], "x")


def _v(n):
    out = b""
    while True:
        out += bytes([n & 127 | (128 if n > 127 else 0)])
        n >>= 7
        if not n:
            return out


def _f(k, data):
    return _v(k << 3 | 2) + _v(len(data)) + data if isinstance(data, bytes) else _v(k << 3) + _v(data)


def extract(path, nodes, ways):
    """A small map extract: nodes {id: (lon, lat)}, ways [(id, tags, refs)]."""
    z = lambda x: x << 1 if x >= 0 else (-x << 1) - 1
    deltas = lambda xs: b"".join(_v(z(b - a)) for a, b in zip([0, *xs], xs))
    strings = ["", *sorted({s for _, tags, _ in ways for kv in tags.items() for s in kv})]
    dense = _f(1, deltas(list(nodes))) + _f(8, deltas([round(p[1] * 1e7) for p in nodes.values()])) + _f(9, deltas([round(p[0] * 1e7) for p in nodes.values()]))
    block = _f(1, b"".join(_f(1, s.encode()) for s in strings)) + _f(2, _f(2, dense))
    for n, tags, refs in ways:
        block += _f(2, _f(3, _f(1, n) + _f(2, b"".join(_v(strings.index(k)) for k in tags)) + _f(3, b"".join(_v(strings.index(v)) for v in tags.values())) + _f(8, deltas(refs))))
    body = b""
    for kind, raw in ((b"OSMHeader", b""), (b"OSMData", block)):
        blob = _f(2, len(raw)) + _f(3, zlib.compress(raw))
        head = _f(1, kind) + _f(3, len(blob))
        body += struct.pack(">I", len(head)) + head + blob
    path.write_bytes(body)


def places(spread):
    return [utm.unproject(G.x0 + x, G.y0 - y, G.epsg, utm.NUMBERS) for x, y in spread]


def test_extracts_become_distances_and_filters_reach_them(spark, tmp_path):
    road = places([(5, 60), (595, 60), (595, 185), (5, 185), (5, 310), (595, 310), (595, 435), (5, 435)])
    pond = places([(105, 105), (205, 105), (205, 205), (105, 205)])
    far = [(70.0, 10.0), (70.1, 10.1)]
    nodes = dict(enumerate([*road, *pond, *far], 1))
    path = tmp_path / "x.osm.pbf"
    extract(path, nodes, [(77, {"highway": "primary"}, [1, 2, 3, 4, 5, 6, 7, 8]), (78, {"natural": "water"}, [9, 10, 11, 12, 9]), (79, {"highway": "track"}, [13, 14])])
    rows = osm.read(spark, str(path))
    text = rows.filter((F.col("kind") == "node") & F.col("lon").between(70, 71) & F.col("lat").between(9, 11))
    assert text.count() == 2 and rows.filter("kind IN ('way', 'relation')").count() == 3 and rows.count() == 17
    reader = osm.Reader({"path": str(path), "kinds": "node", "box": "70,9,71,11"})
    assert sum(1 for p in reader.partitions() for _ in reader.read(p)) == 2 and osm.read(spark, str(path), ["way"]).count() == 3
    box = (70.05, 9.0, 71.0, 11.0)
    for lines in (osm.lines(rows, scenes.is_road(F.col("tags")), box), osm.lines_of(spark, str(path), scenes.is_road(F.col("tags")), box)):
        assert [(r.id, len(r.points)) for r in lines.collect()] == [(79, 2)]  # a way that enters the box keeps its points outside of it
    out = ingest.distances(spark, A, str(path), f"file://{tmp_path}/layers", G)
    assert out["dist_road"].first()["low"] == 0.0 and out["dist_water"].first()["low"] == 0.0
    water = layers.scan(spark, f"file://{tmp_path}/layers", "A", "dist_water")
    assert water.filter("row BETWEEN 11 AND 19 AND col BETWEEN 11 AND 19 AND dist_water > 0").count() == 0  # the pond's inside
    assert water.filter("row = 40 AND col = 15").first().dist_water == 200.0


def catalog(spark, path):
    rows = [(f"s{i}", f"T{i % 2}", 5.0 * i, f"2026-0{1 + i % 4}-10 00:00:00", 77.0, 29.0, 79.0, 31.0) for i in range(9)]
    spark.createDataFrame(rows, "id string, tile string, cloud double, ts string, west double, south double, east double, north double").withColumn("ts", F.to_timestamp("ts")).write.parquet(path)


def test_commands(spark, tmp_path, capsys):
    catalog(spark, f"{tmp_path}/catalog")
    lon, lat = utm.unproject(G.x0, G.y0, G.epsg, utm.NUMBERS)
    tiff.write(str(tmp_path / "dem.tif"), np.full((1, 90, 90), 700.0, "float32"), Grid(4326, lon, lat, 0.0003, 90, 90), -9999.0)
    tiff.write(str(tmp_path / "cover.tif"), np.full((1, 50, 60), 40, "uint8"), G, 0)
    extract(tmp_path / "x.osm.pbf", {1: (78.01, 30.31), 2: (78.02, 30.32)}, [(5, {"highway": "primary"}, [1, 2])])
    staged = ["--region", "A", "--catalog", f"{tmp_path}/catalog", "--dem", f"{tmp_path}/dem.tif", "--cover", f"{tmp_path}/cover.tif", "--extract"]
    assert cli.main(["verify-sources", *staged, f"{tmp_path}/x.osm.pbf"]) == 0
    said = capsys.readouterr().out
    assert said.count("[ OK ]") == 5 and "elevation 700-700 m" in said and "1 highway ways" in said and "[40]" in said
    assert cli.main(["verify-sources", *staged, f"{tmp_path}/none.pbf"]) == 1 and capsys.readouterr().out.count("[FAIL]") == 2
    assert cli.main(["select-scenes", "--region", "A", "--catalog", f"{tmp_path}/catalog", "--out", f"{tmp_path}/manifest"]) == 0
    assert {json.loads(x)["scenes"] for x in capsys.readouterr().out.splitlines()} == {3}
    assert scenes.read_manifest(spark, f"{tmp_path}/manifest").filter("cloud_pct < 30").count() == 6
    assert cli.main(["quicklook", f"{tmp_path}/cover.tif", "--categorical", "--width", "30"]) == 0 and (tmp_path / "cover.quicklook.png").stat().st_size > 0
    capsys.readouterr()
    for command in ("composite", "terrain", "landcover", "osm", "normalisation"):
        with pytest.raises(SystemExit):
            cli.main([command, "--help"])


def test_composites_take_the_first_scenes_and_their_statistics_freeze(spark, tmp_path):
    rows = [(s, r, c, 4, 10 * s + r) for s in (1, 2, 3) for r in range(50) for c in range(60)]
    spark.createDataFrame(rows, "scene int, row int, col int, scl int, red int").write.parquet(f"{tmp_path}/looks")
    assert ingest.composite(spark, A, f"{tmp_path}/looks", f"file://{tmp_path}/made", ["red"], 16, 2, 1, G) == [0, 1]
    assert spark.read.parquet(f"{tmp_path}/made/pixels").filter("red != row + 10").count() == 0
    assert ingest.composite(spark, A, f"{tmp_path}/looks", f"file://{tmp_path}/made", ["red"], 16, None, None, G) == [0, 1, 2, 3]
    drift = ingest.normalisation(spark, A, f"{tmp_path}/made/pixels", f"file://{tmp_path}/stats", ["red"], grid=G, block=10, buffer_px=2)
    assert drift.count() == 1 and spark.read.json(f"file://{tmp_path}/stats").count() == 2
    assert lanes(np.eye(2), spark).count() == 4
