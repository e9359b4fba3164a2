import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions import colours
from gridloom.functions.numbers import exact_round, normalised_numeral, numerals_of
from gridloom.grid import Grid
from gridloom.operators import components, composite, distance, landcover, morphology, resample, scenes, scoring, sites, splits, stats, terrain
from gridloom.operators.resample import lanes


def grid(h, w, res=10.0):
    return Grid(32644, 500000.0, 3000000.0, res, w, h)


def array(df, h, w, name):
    out = np.full((h, w), np.nan)
    for r in df.select("row", "col", F.col(name).cast("double").alias("v")).collect():
        out[r["row"], r["col"]] = np.nan if r["v"] is None else r["v"]
    return out


def test_flat_ground_has_no_slope_and_ramps_recover_their_angle(spark):
    assert not array(terrain.horn_slope(lanes(np.full((20, 20), 412.0), spark, "z"), "z", grid(20, 20)), 20, 20, "slope").any()
    for angle in (5, 15, 30, 45):
        z = np.tile(np.arange(12) * 30.0 * math.tan(math.radians(angle)), (12, 1))
        s = array(terrain.horn_slope(lanes(z, spark, "z"), "z", grid(12, 12, 30.0)), 12, 12, "slope")
        assert np.allclose(s[1:-1, 1:-1], angle, atol=1e-4)


def test_missing_neighbours_make_slope_missing(spark):
    z = lanes(np.arange(25.0).reshape(5, 5), spark, "z").withColumn("z", F.when((F.col("row") != 2) | (F.col("col") != 2), F.col("z")))
    s = array(terrain.horn_slope(z, "z", grid(5, 5)), 5, 5, "slope")
    assert np.isnan(s[1:4, 1:4]).all() and not np.isnan(s[0]).any()


def test_recode(spark):
    codes = [10, 20, 30, 40, 50, 60, 80, 90, 70, 200, 95, 100]
    df = spark.createDataFrame([(c,) for c in codes], "c int").select("c", landcover.merged(F.col("c")).alias("m"))
    assert {r.c: r.m for r in df.collect()} == dict(zip(codes, [1, 2, 2, 3, 4, 5, 6, 6, 0, 0, 6, 5]))


def brute_distance(mask):
    at = np.argwhere(mask)
    r, c = np.indices(mask.shape)
    d = (r[..., None] - at[:, 0]) ** 2 + (c[..., None] - at[:, 1]) ** 2
    key = d * 10_000_000 + at[:, 0] * 1000 + at[:, 1]
    best = at[key.argmin(axis=2)]
    return np.sqrt(d.min(axis=2)) * 10.0, best[..., 0], best[..., 1]


@pytest.mark.parametrize("share", [0.002, 0.05])
def test_distances_equal_brute_force(spark, share):
    mask = np.random.default_rng(3).random((40, 70)) < share
    mask[17, 5] = True
    found = distance.nearest(lanes(mask, spark, "f"), "f", grid(40, 70), stripe=16)
    d, r, c = brute_distance(mask)
    assert np.allclose(array(found, 40, 70, "distance"), d)
    assert (array(found, 40, 70, "near_row") == r).all() and (array(found, 40, 70, "near_col") == c).all()


def test_distance_cases(spark):
    mask = np.zeros((11, 11), bool)
    mask[5, 5] = True
    d = array(distance.nearest(lanes(mask, spark, "f"), "f", grid(11, 11)), 11, 11, "distance")
    assert d[5, 5] == 0 and d[5, 0] == 50 and d[0, 0] == pytest.approx(math.hypot(50, 50))
    with pytest.raises(Exception, match="no feature"):
        distance.nearest(lanes(np.zeros((4, 4), bool), spark, "f"), "f", grid(4, 4)).collect()


def test_coverage(spark):
    every7 = (np.arange(10_000) % 7 == 0).reshape(100, 100)
    corner = np.zeros((100, 100), bool)
    corner[:25, :25] = True
    single = np.zeros((100, 100), bool)
    single[12::25, 12::25] = True
    row = lambda m, floor: distance.coverage(lanes(m, spark, "f"), "f", grid(100, 100), 4, floor)
    assert row(every7, 0.9).first()["covered"] and row(single, 1.0).first()["share"] == 1.0
    assert row(corner, 0.5).first()["share"] == 1 / 16
    with pytest.raises(ValueError):
        distance.require_coverage(row(corner, 0.9), "roads", True)
    with pytest.warns(UserWarning):
        distance.require_coverage(row(corner, 0.9), "water", False)


@pytest.mark.parametrize("n,cells", [(7, 4), (10, 4), (100, 7), (5953, 10), (3, 5)])
def test_cells_are_numpys_array_split(spark, n, cells):
    want = [i for i, part in enumerate(np.array_split(np.arange(n), cells)) for _ in part]
    assert [r.c for r in spark.range(n).select("id", distance.cell_of(F.col("id"), n, cells).alias("c")).orderBy("id").collect()] == want


def test_opening_and_erosion(spark):
    m = np.random.default_rng(1).random((30, 26)) < 0.8
    m[3, 3] = True
    pad = np.pad(m, 1)
    squares = [pad[i : i + 30, j : j + 26] for i in range(3) for j in range(3)]
    core = np.logical_and.reduce(squares)
    pad = np.pad(core, 1)
    want = np.logical_or.reduce([pad[i : i + 30, j : j + 26] for i in range(3) for j in range(3)])
    layer = lanes(m, spark, "m")
    assert (array(morphology.eroded(layer, "m"), 30, 26, "m") == core).all()
    assert (array(morphology.opened(layer, "m"), 30, 26, "m") == want).all()


def flood(mask):
    label = np.full(mask.shape, -1)
    for r, c in np.argwhere(mask):
        if label[r, c] < 0:
            todo, first = [(r, c)], r * mask.shape[1] + c
            label[r, c] = first
            while todo:
                y, x = todo.pop()
                for dy in (-1, 0, 1):
                    for dx in (-1, 0, 1):
                        a, b = y + dy, x + dx
                        if 0 <= a < mask.shape[0] and 0 <= b < mask.shape[1] and mask[a, b] and label[a, b] < 0:
                            label[a, b] = first
                            todo.append((a, b))
    return label


@pytest.mark.parametrize("share,stripe", [(0.4, 7), (0.55, 5), (0.3, 64)])
def test_components_equal_flood_fill_across_stripes(spark, share, stripe):
    mask = np.random.default_rng(int(share * 100)).random((41, 90)) < share
    found = components.components(lanes(mask, spark, "m").filter("m"), 90, stripe)
    got = array(found, 41, 90, "label")
    assert (np.where(np.isnan(got), -1, got) == flood(mask)).all()


def test_snakes_join_over_many_stripes(spark):
    mask = np.zeros((40, 40), bool)
    mask[::2] = True
    mask[1::4, 39] = mask[3::4, 0] = True
    assert components.components(lanes(mask, spark, "m").filter("m"), 40, 3).select("label").distinct().count() == 1


def stack(spark, score, **over):
    h, w = score.shape
    values = {"slope": 3.0, "landcover": 2, "elevation": 500.0, "dist_road": 100.0, "dist_water": 100.0} | over
    df = lanes(score, spark, "score").withColumn("valid", F.lit(True))
    return df.withColumns({k: F.lit(v) for k, v in values.items()}), grid(h, w)


def test_site_ranking_area_flags_and_floor(spark):
    s = np.zeros((100, 100), int)
    s[5:35, 5:35] = 40
    s[60:75, 60:75] = 90
    s[90:95, 5:10] = 99
    found = sites.extract(*stack(spark, s)).collect()
    assert [(r["rank"], r.score, r.area_ha) for r in found] == [(1, 90.0, 2.25), (2, 40.0, 9.0)] and found[0].flags == []
    far = np.zeros((100, 100), int)
    far[20:40, 20:40] = 60
    r = sites.extract(*stack(spark, far, dist_road=7000.0, dist_water=6000.0)).first()
    assert r.area_ha == 4.0 and len(r.flags) == 2 and "road" in r.flags[0]
    sliver = np.zeros((100, 100), int)
    sliver[10:70, 10:13] = 50
    r = sites.extract(*stack(spark, sliver)).first()
    assert r.flags[0].startswith("mostly-edge")
    assert sites.extract(*stack(spark, np.zeros((20, 20), int))).count() == 0


def test_diagonal_blocks_are_one_site_and_top_n(spark):
    s = np.zeros((40, 40), int)
    s[5:15, 5:15] = s[15:25, 15:25] = 50
    assert sites.extract(*stack(spark, s)).count() == 1
    s = np.zeros((120, 120), int)
    for k in range(5):
        s[5 + 20 * k : 20 + 20 * k, 5:20] = 50 + k
    assert [r.score for r in sites.extract(*stack(spark, s), top=3).orderBy("rank").collect()] == [54.0, 53.0, 52.0]


def test_centroid(spark):
    s = np.zeros((50, 50), int)
    s[10:30, 20:40] = 50
    frame, g = stack(spark, s)
    from gridloom.functions import utm

    r = sites.extract(frame, g).first()
    lon, lat = utm.unproject(g.x0 + 30 * 10.0, g.y0 - 20 * 10.0, g.epsg, utm.NUMBERS)
    assert (r.lon, r.lat) == (round(lon, 6), round(lat, 6))


def test_splits(spark):
    assert [tuple(map(tuple, splits.chosen_blocks(splits.block_shape(6804, 5953)))), tuple(map(tuple, splits.chosen_blocks(splits.block_shape(5603, 7004))))] == [splits.VAL_BLOCKS["A"], splits.VAL_BLOCKS["B"]]
    g = grid(60, 50)
    got = array(splits.build(spark, g, [(1, 1)], 20, 4), 60, 50, "split")
    want = np.ones((60, 50))
    want[16:44, 16:44] = 0
    want[20:40, 20:40] = 2
    assert (got == want).all()
    assert array(splits.build(spark, g, [(1, 1)], 20, 0), 60, 50, "split").min() == 1


@pytest.mark.parametrize("patch,stride", [(8, 8), (8, 4), (8, 3), (16, 16)])
def test_patches_equal_the_plain_loop(spark, patch, stride):
    g = grid(40, 48)
    split = splits.build(spark, g, [(0, 1), (2, 0)], 16, 2)
    a = array(split, 40, 48, "split")
    for value in (1, 2):
        want = {(r, c) for r in range(0, 40 - patch + 1, stride) for c in range(0, 48 - patch + 1, stride) if (a[r : r + patch, c : c + patch] == value).all()}
        assert {(x["row"], x["col"]) for x in splits.patch_origins(split, g, value, patch, stride).collect()} == want


@pytest.mark.parametrize("region,counts", [("A", (397, 104)), ("B", (380, 100))])
def test_published_patch_counts(spark, region, counts):
    """All patches of the real grids, from rectangles alone."""
    from gridloom.grid import REGIONS, grid_for

    g = grid_for(REGIONS[region])
    a = np.ones((g.height, g.width), np.int8)
    val = np.zeros_like(a, bool)
    for r, c in splits.VAL_BLOCKS[region]:
        a[max(r * 1024 - 256, 0) : (r + 1) * 1024 + 256, max(c * 1024 - 256, 0) : (c + 1) * 1024 + 256] = 0
        val[r * 1024 : (r + 1) * 1024, c * 1024 : (c + 1) * 1024] = True
    a[val] = 2
    n = lambda v: sum((a[r : r + 256, c : c + 256] == v).all() for r in range(0, g.height - 255, 256) for c in range(0, g.width - 255, 256))
    assert (n(1), n(2)) == counts


def test_balance_and_statistics(spark):
    labels = lanes(np.array([[0, 0, 1, 1]]), spark, "landcover")
    split = lanes(np.array([[1, 1, 1, 1]]), spark, "split")
    assert [tuple(r) for r in splits.class_balance(split, labels).collect()] == [(1, 1, 100.0)]
    b = stats.band_statistics(lanes(np.array([[100, 200, 300, 400, 0]]), spark, "b"), ["b"]).first()
    assert (b["count"], b["mean"], b["std"], b["p50"]) == (4, 250.0, round(float(np.std([100, 200, 300, 400])), 3), 250.0)


def test_composite_counts_clear_looks_and_skips_fill(spark):
    rows = [(0, 0, 4, 10, 5), (0, 0, 5, 13, 0), (0, 0, 8, 99, 9), (0, 0, 7, 0, 7), (0, 1, 9, 50, 5)]
    df = spark.createDataFrame(rows, "row int, col int, scl int, red int, nir int")
    made = composite.on_grid(composite.median_composite(df, ["red", "nir"]), grid(1, 2), ["red", "nir"])
    assert {tuple(r) for r in made.collect()} == {(0, 0, 12, 6, 3), (0, 1, 0, 0, 0)}


def test_touching_footprints_do_not_overlap(spark):
    s = spark.createDataFrame([(1, 0.0, 0.0, 10.0, 10.0), (2, 0.0, 5.0, 10.0, 15.0)], "id int, left double, bottom double, right double, top double")
    slabs = spark.createDataFrame([(0, 0.0, 10.0, 10.0, 20.0), (1, 0.0, 0.0, 10.0, 10.0)], "stripe int, left double, bottom double, right double, top double")
    assert {(r.id, r.stripe) for r in composite.overlapping(s, slabs).collect()} == {(1, 1), (2, 0), (2, 1)}


def numpy_resample(a, kind, src, dst):
    out = np.full((dst.height, dst.width), np.nan)
    taps = resample.TAPS[kind]
    for r in range(dst.height):
        for c in range(dst.width):
            y = (src.y0 - (dst.y0 - (r + 0.5) * dst.res)) / src.res - 0.5
            x = ((dst.x0 + (c + 0.5) * dst.res) - src.x0) / src.res - 0.5
            first = (lambda v: math.floor(v + 0.5)) if taps == 1 else (lambda v: math.floor(v) - (taps // 2 - 1))
            s = t = 0.0
            for i in range(first(y), first(y) + taps):
                for j in range(first(x), first(x) + taps):
                    if 0 <= i < a.shape[0] and 0 <= j < a.shape[1] and not np.isnan(a[i, j]):
                        def w(d):
                            if taps == 1:
                                return 1.0
                            if taps == 2:
                                return 1 - d
                            return 1.5 * d**3 - 2.5 * d**2 + 1 if d <= 1 else -0.5 * d**3 + 2.5 * d**2 - 4 * d + 2
                        k = w(abs(y - i)) * w(abs(x - j))
                        s, t = s + k * a[i, j], t + k
            if t:
                out[r, c] = s / t
    return out


@pytest.mark.parametrize("kind", ["nearest", "bilinear", "cubic"])
def test_resampling_equals_the_plain_loop(spark, kind):
    a = np.random.default_rng(5).random((9, 8)) * 100
    a[4, 4] = np.nan
    src, dst = Grid(32644, 1000.0, 2000.0, 30.0, 8, 9), Grid(32644, 1013.0, 1985.0, 10.0, 20, 21)
    layer = lanes(a, spark, "v").withColumn("v", F.nanvl("v", F.lit(None)))
    got = array(resample.resample(layer, "v", src, dst, kind), 21, 20, "v")
    assert np.allclose(got, numpy_resample(a, kind, src, dst), equal_nan=True)


def test_decimation(spark):
    a = np.arange(36.0).reshape(6, 6)
    assert (array(resample.averaged(lanes(a, spark, "v"), "v", 3), 2, 2, "v") == a.reshape(2, 3, 2, 3).mean(axis=(1, 3))).all()
    assert (array(resample.decimated(lanes(a, spark, "v"), 4), 2, 2, "v") == a[::4, ::4]).all()


def test_segments_touch_what_sampling_finds_and_polygons_fill(spark):
    rng = np.random.default_rng(8)
    seg = [(k, *(rng.random(4) * 20 - 1).tolist()) for k in range(30)]
    got = {(r["row"], r["col"]) for r in resample.touched_by_segments(spark.createDataFrame(seg, "id int, x0 double, y0 double, x1 double, y1 double"), grid(18, 18)).collect()}
    sampled = {(math.floor(y0 + (y1 - y0) * t), math.floor(x0 + (x1 - x0) * t)) for _, x0, y0, x1, y1 in seg for t in np.linspace(0, 1, 4000)}
    sampled = {(r, c) for r, c in sampled if 0 <= r < 18 and 0 <= c < 18}
    assert sampled <= got and len(got - sampled) <= 3  # corners that sampling steps over
    ring = [(2.0, 2.0), (12.0, 3.0), (10.0, 12.0), (3.0, 10.0)]
    edges = [(1, *a, *b) for a, b in zip(ring, [*ring[1:], ring[0]])]
    filled = {(r["row"], r["col"]) for r in resample.filled_polygons(spark.createDataFrame(edges, "id int, x0 double, y0 double, x1 double, y1 double"), grid(18, 18)).collect()}

    def inside(r, c):
        x, y, odd = c + 0.5, r + 0.5, False
        for _, x0, y0, x1, y1 in edges:
            if (y0 > y) != (y1 > y) and x < x0 + (x1 - x0) * (y - y0) / (y1 - y0):
                odd = not odd
        return odd

    assert {(r, c) for r in range(18) for c in range(18) if inside(r, c)} <= filled


def test_scores(spark):
    rows = [(0.0, 2, True, 100), (5.0, 2, True, 80), (15.0, 2, True, 40), (15.1, 2, True, 0), (3.0, 4, True, 0), (3.0, 6, True, 0), (3.3, 2, True, 86), (3.0, 2, False, 0)]
    df = spark.createDataFrame(rows, "slope double, landcover int, valid boolean, want int").withColumn("score", scoring.parity())
    assert all(r.score == r.want for r in df.collect())
    assert sum(scoring.WEIGHTS.values()) == pytest.approx(1.0) and all(sum(w.values()) == pytest.approx(1.0) for _, w in scoring.scenarios())
    with pytest.raises(ValueError):
        scoring.contract(spark.createDataFrame([(101,)], "score int"), 1)


def test_colour_ramp_is_the_interpolated_table(spark):
    stops, colour = zip(*colours.RAMP)
    df = spark.range(0, 103).select("id", colours.score_rgb(F.col("id").cast("int")).alias("c"))
    for r in df.collect():
        want = list(colours.EXCLUDED) if r.id == 0 else [int(np.interp(min(r.id, 100), stops, [x[i] for x in colour])) for i in range(3)]
        assert r.c == want, r.id


def test_stretch(spark):
    df = spark.createDataFrame([(None,), (0.0,), (50.0,), (200.0,)], "v double")
    assert [r[0] for r in df.select(colours.stretched(F.col("v"), F.lit(0.0), F.lit(100.0))).collect()] == [0, 0, 127, 255]
    assert [r[0] for r in df.select(colours.stretched(F.col("v"), F.lit(50.0), F.lit(50.0))).collect()] == [0, 0, 0, 255]


def test_scene_rules(spark):
    rows = [(i, "T1", 5.0, f"2026-01-{i + 1:02d} 00:00:00") for i in range(15)] + [(99, "T2", 31.0, "2026-02-01 00:00:00")]
    df = spark.createDataFrame(rows, "id int, tile string, cloud double, ts string").withColumn("ts", F.to_timestamp("ts"))
    kept = scenes.select_per_tile(df.filter("cloud < 30"))
    assert sorted(r.id for r in kept.collect()) == list(range(12))
    assert [r.tile for r in scenes.starved_tiles(df, kept).collect()] == ["T2"]
    p = spark.createDataFrame([({"grid:code": "MGRS-43RGP", "proj:code": "EPSG:32643"},), ({"s2:mgrs_tile": "44RKU", "proj:epsg": "32644"},)], "p map<string,string>")
    assert [tuple(r) for r in p.select(scenes.tile_of(F.col("p")), scenes.epsg_of(F.col("p"))).collect()] == [("43RGP", 32643), ("44RKU", 32644)]
    with pytest.raises(Exception, match="none of"):
        spark.createDataFrame([({"x": "y"},)], "p map<string,string>").select(scenes.tile_of(F.col("p"))).collect()


def test_tiles(spark):
    box = spark.createDataFrame([(77.75, 29.90, 78.35, 30.50), (-72.5, -5.2, -71.5, -4.9)], "west double, south double, east double, north double")
    got = {r.n for r in scenes.tiles(box).select(scenes.dem_tile_name(F.col("lat"), F.col("lon")).alias("n")).collect()}
    assert {f"Copernicus_DSM_COG_10_N{a}_00_E{o:03d}_00_DEM" for a in (29, 30) for o in (77, 78)} <= got and "Copernicus_DSM_COG_10_S05_00_W072_00_DEM" in got
    assert {(r.lat, r.lon) for r in scenes.tiles(box, 3).collect()} == {(27, 75), (27, 78), (30, 75), (30, 78), (-6, -75), (-6, -72)}


def test_mosaic_and_rounding(spark):
    t = spark.createDataFrame([(0, 0, 1, 5), (0, 0, 0, None), (0, 0, 2, 7), (0, 1, 2, 9)], "row int, col int, rank int, v int")
    assert {(r["col"], r.v) for r in scenes.mosaic(t, "v").collect()} == {(0, 5), (1, 9)}
    values = [2.675, 2.5, 0.125, 1e-9, -2.675]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", exact_round(2)("v").alias("r"))
    assert all(r.r == round(r.v, 2) for r in df.collect())


def test_numerals(spark):
    df = spark.createDataFrame([("1",), ("1.0",), ("1.00",), ("2.50",), ("0.1234567",)], "t string").select(normalised_numeral(F.col("t")).alias("n"))
    assert [r.n for r in df.collect()] == ["1", "1", "1", "2.5", "0.123457"]
    assert numerals_of({"a1": [2.0, True, "x 3.5"], "b": None}) == {"1", "2", "3.5"}


def test_confusion_scores(spark):
    m = stats.confusion(spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1)], "label int, pred int"))
    got = {r["class"]: (r.iou, r.f1) for r in stats.agreement(m).collect()}
    assert got == {0: (0.5, 0.666667), 1: (0.666667, 0.8)}
