"""The registered queries once more, as SQL for an independent engine over the same tables."""

from __future__ import annotations

from gridloom.functions import utm
from gridloom.functions.colours import PALETTE, RAMP
from gridloom.operators import scenes, scoring, sites, splits
from gridloom.operators.landcover import MERGE, NAMES
from gridloom.plans import queries as q


def rint(x: str, places: int = 0) -> str:
    return f"(round_even(({x}) * {10.0**places}, 0) / {10.0**places})" if places else f"round_even({x}, 0)"


def case(x: str, table: dict, other: str) -> str:
    return f"CASE {x} " + " ".join(f"WHEN {k!r} THEN {v!r}" for k, v in table.items()) + f" ELSE {other} END"


COMMON = {
    "looks": """SELECT CAST(l_orderkey % 128 AS INT) AS "row", CAST(l_partkey % 128 AS INT) AS col, l_linenumber AS scene, CAST(l_quantity AS INT) % 12 AS scl,
        CAST(floor(l_extendedprice / 10) AS INT) AS red, CAST(floor(l_extendedprice / 7) AS INT) AS nir, l_quantity AS q FROM lineitem""",
    "grid": 'SELECT CAST(id // 128 AS INT) AS "row", CAST(id % 128 AS INT) AS col FROM range(16384) t(id)',
    "seen": """SELECT "row", col, avg(q) AS mean_q, bool_or(q >= 50 AND scene = 1) AS is_built, bool_or(scene = 7 AND q >= 48) AS is_water, bool_or(scene = 3 AND q >= 49) AS is_road FROM looks GROUP BY "row", col""",
    "layers": """SELECT "row", col, 500.0::DOUBLE + (1 + 3 * ("row" // 32)) * abs("row" % 32 - 16) + (1 + 2 * (col // 48)) * abs(col % 48 - 24) + coalesce(mean_q, 0) / 50 AS elevation,
        CASE WHEN coalesce(is_built, false) THEN 4 ELSE 1 + (("row" // 8) * 7 + (col // 8) * 13) % 6 END AS landcover, coalesce(is_water, false) AS water, coalesce(is_road, false) AS road
        FROM grid LEFT JOIN seen USING ("row", col)""",
    "around": """SELECT "row", col, landcover, elevation, z, coalesce(lag(z) OVER r, z) AS l, coalesce(lead(z) OVER r, z) AS t FROM (SELECT *, elevation AS z FROM layers) WINDOW r AS (PARTITION BY "row" ORDER BY col)""",
    "nine": """SELECT "row", col, landcover, elevation, l AS ml, t AS mr, coalesce(lag(l) OVER c, l) AS tl, coalesce(lag(z) OVER c, z) AS tm, coalesce(lag(t) OVER c, t) AS tr,
        coalesce(lead(l) OVER c, l) AS bl, coalesce(lead(z) OVER c, z) AS bm, coalesce(lead(t) OVER c, t) AS br FROM around WINDOW c AS (PARTITION BY col ORDER BY "row")""",
    "gradient": """SELECT "row", col, landcover, elevation, ((tr + 2 * mr + br) - (tl + 2 * ml + bl)) / 240.0 AS dx, ((bl + 2 * bm + br) - (tl + 2 * tm + tr)) / 240.0 AS dy FROM nine""",
    "sloped": f"""SELECT "row", col, landcover, elevation, {rint('degrees(atan(sqrt(dx * dx + dy * dy)))', 4)} AS slope FROM gradient""",
    "plain": """SELECT *, CASE WHEN slope > 15 OR landcover IN (4, 6) THEN 0 ELSE CAST(trunc(least(100.0, greatest(1.0, 100 - 4 * slope))) AS INT) END AS score FROM sloped""",
    "e1": """SELECT "row", col, least(coalesce(lag(m) OVER r, 0), m, coalesce(lead(m) OVER r, 0)) AS m FROM (SELECT "row", col, CAST(score >= 1 AS INT) AS m FROM plain) WINDOW r AS (PARTITION BY "row" ORDER BY col)""",
    "e2": """SELECT "row", col, least(coalesce(lag(m) OVER c, 0), m, coalesce(lead(m) OVER c, 0)) AS m FROM e1 WINDOW c AS (PARTITION BY col ORDER BY "row")""",
    "d1": """SELECT "row", col, greatest(coalesce(lag(m) OVER c, 0), m, coalesce(lead(m) OVER c, 0)) AS m FROM e2 WINDOW c AS (PARTITION BY col ORDER BY "row")""",
    "cleaned": """SELECT "row", col, greatest(coalesce(lag(m) OVER r, 0), m, coalesce(lead(m) OVER r, 0)) AS m FROM d1 WINDOW r AS (PARTITION BY "row" ORDER BY col)""",
    "c1": """SELECT "row", col, m, least(coalesce(lag(m) OVER r, 0), m, coalesce(lead(m) OVER r, 0)) AS k FROM cleaned WINDOW r AS (PARTITION BY "row" ORDER BY col)""",
    "cored": """SELECT "row", col, m, least(coalesce(lag(k) OVER c, 0), k, coalesce(lead(k) OVER c, 0)) AS k FROM c1 WINDOW c AS (PARTITION BY col ORDER BY "row")""",
    "cells": """SELECT "row", col, k FROM cored WHERE m = 1""",
    "labels_": """SELECT "row", col, CAST("row" * 128 + col AS BIGINT) AS label FROM cells UNION
        SELECT a."row", a.col, min(b.label) FROM recurring.labels_ a CROSS JOIN (SELECT dr, dc FROM range(-1, 2) x(dr), range(-1, 2) y(dc)) JOIN recurring.labels_ b ON b."row" = a."row" + dr AND b.col = a.col + dc GROUP BY a."row", a.col, a.label HAVING min(b.label) < a.label""",
    "large": """SELECT label, count(*) AS pixels FROM labels_ GROUP BY label HAVING count(*) >= 50""",
    "wet": """SELECT "row" AS fr, col AS fc, elevation AS fe FROM layers WHERE water OR ("row" = 0 AND col = 0)""",
    "near_water": """SELECT p."row", p.col, arg_min({'d': (p."row" - fr) ** 2 + (p.col - fc) ** 2, 'fr': fr, 'fc': fc, 'fe': fe}, (CAST((p."row" - fr) * (p."row" - fr) + (p.col - fc) * (p.col - fc) AS BIGINT) * 16384 + fr * 128 + fc)) AS n, any_value(p.elevation) AS elevation FROM layers p, wet GROUP BY p."row", p.col""",
    "roads": """SELECT "row" AS fr, col AS fc FROM layers WHERE road OR ("row" = 0 AND col = 0)""",
    "near_road": """SELECT p."row", p.col, sqrt(min((p."row" - fr) * (p."row" - fr) + (p.col - fc) * (p.col - fc))) * 10 AS dist_road FROM layers p, roads GROUP BY p."row", p.col""",
    "stack": """SELECT p.*, sqrt(n.d) * 10 AS dist_water, w.elevation - n.fe AS rise, dist_road FROM plain p JOIN near_water w USING ("row", col) JOIN near_road USING ("row", col)""",
    "zones": """SELECT s.*, label, k FROM labels_ JOIN large USING (label) JOIN stack s USING ("row", col) JOIN cored USING ("row", col)""",
    "zonal": """SELECT label, count(*) AS n, avg(score) AS mean_score, max(score) AS max_score, avg(slope) AS mean_slope, max(slope) AS max_slope, min(dist_road) AS min_road, min(dist_water) AS min_water,
        avg(elevation) AS mean_elevation, avg("row") AS mean_row, avg(col) AS mean_col, 1 - avg(k) AS edge_fraction FROM zones GROUP BY label""",
    "flagged": "SELECT *, concat_ws('; ', " + ", ".join(f"CASE WHEN {t} THEN '{text}' END" for (text, _), t in zip(sites.FLAGS, ("edge_fraction > 0.5", "min_road > 5000", "min_water > 5000", "n * 0.01 < 1.0"), strict=True)) + ") AS flags FROM zonal",
    "main_class": """SELECT label, landcover AS dominant FROM (SELECT label, landcover, row_number() OVER (PARTITION BY label ORDER BY count(*) DESC, landcover) AS i FROM zones GROUP BY label, landcover) WHERE i = 1""",
    "composed": f"""SELECT "row", col, CAST(coalesce({rint('median(CASE WHEN red <> 0 THEN red END)')}, 0) AS INT) AS red, CAST(coalesce({rint('median(CASE WHEN nir <> 0 THEN nir END)')}, 0) AS INT) AS nir, count(*) AS clear FROM looks WHERE scl IN (4, 5, 6, 7) GROUP BY "row", col""",
    "composite": """SELECT "row", col, coalesce(red, 0) AS red, coalesce(nir, 0) AS nir, coalesce(clear, 0) AS clear FROM grid LEFT JOIN composed USING ("row", col)""",
    "blocks": "SELECT * FROM (VALUES " + ", ".join(str(b) for b in q.VAL_BLOCKS) + ") t(br, bc)",
    "split": f"""SELECT "row", col, CASE WHEN EXISTS (SELECT 1 FROM blocks WHERE "row" // {q.BLOCK} = br AND col // {q.BLOCK} = bc) THEN 2
        WHEN EXISTS (SELECT 1 FROM blocks WHERE "row" BETWEEN br * {q.BLOCK} - {q.BUFFER_PX} AND br * {q.BLOCK} + {q.BLOCK - 1 + q.BUFFER_PX} AND col BETWEEN bc * {q.BLOCK} - {q.BUFFER_PX} AND bc * {q.BLOCK} + {q.BLOCK - 1 + q.BUFFER_PX}) THEN 0 ELSE 1 END AS split FROM grid""",
    "scenes": "SELECT event_id AS id, 'T' || (user_id % 8) AS tile, value AS cloud, ts, event_type FROM events",
    "kept": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tile ORDER BY cloud, id) AS nth FROM scenes) WHERE nth <= 12",
    "found": """SELECT DISTINCT doc_id, CASE WHEN x = floor(x) THEN printf('%.0f', x) ELSE rtrim(printf('%.6f', x), '0') END AS numeral
        FROM (SELECT doc_id, CAST(unnest(regexp_extract_all(coalesce(text, ''), '[0-9]+(?:\\.[0-9]+)?')) AS DOUBLE) AS x FROM documents)""",
    "pairs": "SELECT label, CASE WHEN vec_id % 3 = 0 THEN (label + 1) % 10 ELSE label END AS pred FROM embeddings",
}
COMMON |= {
    "coarse": """SELECT ("row" - 1) // 3 + 1 AS r, (col - 1) // 3 + 1 AS c, elevation AS z FROM layers WHERE "row" % 3 = 1 AND col % 3 = 1""",
    "coarse_line": """SELECT r, c, z, lag(z) OVER w AS l, lead(z) OVER w AS t FROM coarse WINDOW w AS (PARTITION BY r ORDER BY c)""",
    "coarse_nine": """SELECT r, c, ((lag(t) OVER w + 2 * t + lead(t) OVER w) - (lag(l) OVER w + 2 * l + lead(l) OVER w)) / 240.0 AS dx, ((lead(l) OVER w + 2 * lead(z) OVER w + lead(t) OVER w) - (lag(l) OVER w + 2 * lag(z) OVER w + lag(t) OVER w)) / 240.0 AS dy FROM coarse_line WINDOW w AS (PARTITION BY c ORDER BY r)""",
    "coarse_sloped": """SELECT r, c, degrees(atan(sqrt(dx * dx + dy * dy))) AS s FROM coarse_nine WHERE dx IS NOT NULL AND dy IS NOT NULL""",
}
KEYED = {"labels_": ' USING KEY ("row", col)'}


def over(final: str) -> str:
    """final with the common tables that it needs, in order."""
    import re

    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in COMMON.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit_body = re.sub(rf"\b{name}\b", "", body)
                visit(visit_body)
                if name not in needed:
                    needed.append(name)

    visit(final)
    tables = ", ".join(f"{n}{'(' + chr(34) + 'row' + chr(34) + ', col, label)' if n in KEYED else ''}{KEYED.get(n, '')} AS {'' if n in KEYED else 'MATERIALIZED '}({COMMON[n]})" for n in needed)
    return f"WITH {'RECURSIVE ' if any(n in KEYED for n in needed) else ''}{tables} {final}" if needed else final


def percentiles(value: str, points: tuple, places: int = 4) -> str:
    return ", ".join(f"{rint(f'quantile_cont({value}, {p / 100})', places)} AS p{p}" for p in points)


def piecewise(x: str, knots: tuple) -> str:
    parts = [f"WHEN {x} < {knots[0][0]} THEN {float(knots[0][1])!r}"]
    parts += [f"WHEN {x} < {x1} THEN {y0!r} + {y1 - y0!r} * ({x} - {x0}) / {float(x1 - x0)!r}" for (x0, y0), (x1, y1) in zip(knots, knots[1:], strict=False)]
    return f"(CASE {' '.join(parts)} ELSE {float(knots[-1][1])!r} END)"


def weighted(w: dict) -> str:
    f = {
        "slope": piecewise("slope", scoring.CURVES["slope"]), "landcover": f"({case('landcover', scoring.COVER, '0.0')})",
        "flood": f"(CASE WHEN rise < {scoring.FLOOD_RISE} AND dist_water <= {scoring.FLOOD_REACH} THEN {scoring.FLOOD_FACTOR} ELSE 1.0 END)",
        "road": piecewise("dist_road", scoring.CURVES["road"]), "water": piecewise("dist_water", scoring.CURVES["water"]),
    }
    total = " + ".join(f"{w[k]!r}::DOUBLE * {v}" for k, v in f.items())
    return f"(CASE WHEN slope > 15 OR landcover IN (0, 4, 6) THEN 0 ELSE CAST(greatest(1, least(100, {rint(rint(f'100 * ({total})', 6))})) AS INT) END)"


class Sql:
    """Arithmetic that writes itself down, so that the projection's series become SQL."""

    def __init__(self, text: object):
        self.text = text if isinstance(text, str) else repr(float(text))

    def _with(self, op: str, other: object, flip: bool = False) -> Sql:
        a, b = (self.text, other.text if isinstance(other, Sql) else repr(float(other)))
        return Sql(f"({b} {op} {a})" if flip else f"({a} {op} {b})")

    def __add__(self, o): return self._with("+", o)  # noqa: E704
    def __radd__(self, o): return self._with("+", o, True)  # noqa: E704
    def __sub__(self, o): return self._with("-", o)  # noqa: E704
    def __rsub__(self, o): return self._with("-", o, True)  # noqa: E704
    def __mul__(self, o): return self._with("*", o)  # noqa: E704
    def __rmul__(self, o): return self._with("*", o, True)  # noqa: E704
    def __truediv__(self, o): return self._with("/", o)  # noqa: E704
    def __rtruediv__(self, o): return self._with("/", o, True)  # noqa: E704


class SqlFunctions:
    def __getattr__(self, name: str):
        return lambda *args: Sql(f"{name}({', '.join((a if isinstance(a, Sql) else Sql(a)).text for a in args)})")


def projected(lon: str, lat: str) -> tuple[str, str]:
    x, y = utm.project(Sql(lon), Sql(lat), 32644, SqlFunctions())
    return x.text, y.text


def unprojected(x: str, y: str) -> tuple[str, str]:
    lon, lat = utm.unproject(Sql(x), Sql(y), 32644, SqlFunctions())
    return lon.text, lat.text


def rgb(score: str, channel: int) -> str:
    parts = [f"WHEN least({score}, 100) < {hi} THEN CAST(trunc({a[channel]} + {b[channel] - a[channel]} * (least({score}, 100) - {lo}) / {float(hi - lo)}) AS INT)" for (lo, a), (hi, b) in zip(RAMP, RAMP[1:], strict=False)]
    return f"CASE WHEN {score} = 0 THEN {(38, 38, 42)[channel]} {' '.join(parts)} ELSE {RAMP[-1][1][channel]} END"


def resampled(kind: str, value: str, where: str, outer: str) -> str:
    """The source's rows and columns around each target centre, weighed and averaged over those that exist."""
    s = q.SOURCE
    r = f"(({s.y0!r}::DOUBLE - (3378690.0::DOUBLE - (g.\"row\" + 0.5::DOUBLE) * 20.0::DOUBLE)) / 30.0::DOUBLE - 0.5::DOUBLE)"
    c = f"(((186140.0::DOUBLE + (g.col + 0.5::DOUBLE) * 20.0::DOUBLE) - {s.x0!r}::DOUBLE) / 30.0::DOUBLE - 0.5::DOUBLE)"
    taps = {"nearest": 1, "bilinear": 2, "cubic": 4}[kind]
    start = (lambda x: f"floor({x} + 0.5)") if taps == 1 else (lambda x: f"floor({x}) - {taps // 2 - 1}")

    def weight(d: str) -> str:
        if kind == "nearest":
            return "1.0"
        if kind == "bilinear":
            return f"(1 - {d})"
        return f"(CASE WHEN {d} <= 1 THEN (1.5 * {d} - 2.5) * {d} * {d} + 1 ELSE ((-0.5 * {d} + 2.5) * {d} - 4) * {d} + 2 END)"

    w = f"{weight('abs(r - sr)')} * {weight('abs(c - sc)')}"
    return over(f"""SELECT "row", col, {outer.format(v='s / nullif(t, 0)')} AS {value} FROM (SELECT a."row", a.col, sum(w * v) AS s, sum(w) AS t FROM
        (SELECT *, {w} AS w FROM (SELECT g."row", g.col, {r} AS r, {c} AS c, CAST({start(r)} + i AS BIGINT) AS sr, CAST({start(c)} + j AS BIGINT) AS sc FROM (SELECT CAST(k // {q.FINE.width} AS INT) AS "row", CAST(k % {q.FINE.width} AS INT) AS col FROM range({q.FINE.width * q.FINE.height}) t(k)) g, range({taps}) x(i), range({taps}) y(j))) a
        JOIN (SELECT "row" AS sr, col AS sc, {value} AS v FROM layers WHERE {where}) b USING (sr, sc) GROUP BY a."row", a.col) WHERE s / nullif(t, 0) IS NOT NULL""")


def tile_sql(table: str, key: str, east: float, north: float, step: int, head: str, tail: str, middle: str) -> str:
    corner = lambda v, p, n, k: f"(CASE WHEN {v} >= 0 THEN '{p}' ELSE '{n}' END || lpad(CAST(abs({v}) AS VARCHAR), {k}, '0'))"
    lo = lambda x: f"CAST(floor(({x}) / {step}) * {step} AS INT)"
    return f"""SELECT {key}, CAST(lat AS INT) AS lat, CAST(lon AS INT) AS lon, '{head}' || {corner('lat', 'N', 'S', 2)} || '{middle}' || {corner('lon', 'E', 'W', 3)} || '{tail}' AS name FROM
        (SELECT {key}, w, e, unnest(range({lo('s')}, {lo('n')} + 1, {step})) AS lat FROM (SELECT {key}, ({key} % 340 - 170.3)::DOUBLE AS w, ({key} % 340 - 170.3)::DOUBLE + {east} AS e, ({key} % 150 - 75.6)::DOUBLE AS s, ({key} % 150 - 75.6)::DOUBLE + {north} AS n FROM {table})) a,
        LATERAL (SELECT unnest(range({lo('a.w')}, {lo('a.e')} + 1, {step})) AS lon) b"""


def patches(value: int, stride: int) -> str:
    p = q.PATCH
    last = (128 - p) // stride
    return f"""SELECT CAST(o.i * {stride} AS INT) AS "row", CAST(o.j * {stride} AS INT) AS col, {value} AS split, {stride} AS stride FROM (SELECT i, j FROM range({last + 1}) a(i), range({last + 1}) b(j)) o
        JOIN split s ON s."row" BETWEEN o.i * {stride} AND o.i * {stride} + {p - 1} AND s.col BETWEEN o.j * {stride} AND o.j * {stride} + {p - 1} WHERE s.split = {value} GROUP BY o.i, o.j HAVING count(*) = {p * p}"""


def band_rows(where: str, scope: str) -> str:
    one = lambda b: f"SELECT '{b}' AS band, CAST({b} AS DOUBLE) AS v FROM composite JOIN split USING (\"row\", col) WHERE {b} <> 0 AND {where}"
    return f"SELECT '{scope}' AS scope, band, count(*) AS count, {rint('avg(v)', 3)} AS mean, {rint('stddev_pop(v)', 3)} AS std, min(v) AS min, max(v) AS max, {percentiles('v', (1, 2, 50, 98, 99), 3)} FROM ({one('red')} UNION ALL {one('nir')}) GROUP BY band"


def sensitivity() -> str:
    named = [("base", dict(scoring.WEIGHTS)), *scoring.scenarios()]
    rows = " UNION ALL ".join(f"SELECT '{n}' AS scenario, label, {rint('avg(' + weighted(w) + ')', 6)} AS s FROM zones GROUP BY label" for n, w in named)
    return over(f"""SELECT scenario, label AS best, {rint('s', 3)} AS score, label = first_value(label) OVER (ORDER BY scenario <> 'base') AS same FROM
        (SELECT *, row_number() OVER (PARTITION BY scenario ORDER BY s DESC, label) AS i FROM ({rows})) WHERE i = 1""")


def polygons() -> str:
    """Centres inside by crossings to the left, and pixels that an edge's part in a row touches."""
    x, y = "(s_suppkey * 17 % 1100 / 10.0::DOUBLE + 0.05::DOUBLE)", "(s_suppkey * 29 % 1100 / 10.0::DOUBLE + 0.05::DOUBLE)"
    corners = [(x, y), (f"({x} + s_suppkey % 13 + 1.13::DOUBLE)", f"({y} + 2.31::DOUBLE)"), (f"({x} + 3.17::DOUBLE)", f"({y} + s_suppkey % 11 + 4.23::DOUBLE)")]
    edges = " UNION ALL ".join(f"SELECT s_suppkey AS id, {a[0]} AS x0, {a[1]} AS y0, {b[0]} AS x1, {b[1]} AS y1 FROM supplier" for a, b in zip(corners, [*corners[1:], corners[0]], strict=True))
    at = lambda v: f"x0 + (x1 - x0) * ({v} - y0) / (y1 - y0)"
    return f"""WITH e AS ({edges}), inside AS (SELECT id, r, c FROM (SELECT id, r, {at('(r + 0.5::DOUBLE)')} AS x FROM e, range(128) t(r) WHERE least(y0, y1) <= r + 0.5 AND r + 0.5 < greatest(y0, y1)) JOIN range(128) u(c) ON x <= c + 0.5::DOUBLE GROUP BY id, r, c HAVING count(*) % 2 = 1),
        touched AS (SELECT r, unnest(range(CAST(greatest(0, floor(least(a, b))) AS BIGINT), CAST(least(127, floor(greatest(a, b))) AS BIGINT) + 1)) AS c FROM
            (SELECT r, {at('greatest(least(y0, y1), r)')} AS a, {at('least(greatest(y0, y1), r + 1)')} AS b FROM e, range(128) t(r) WHERE r BETWEEN floor(least(y0, y1)) AND floor(greatest(y0, y1))))
        SELECT DISTINCT CAST(r AS INT) AS "row", CAST(c AS INT) AS col FROM (SELECT r, c FROM inside UNION ALL SELECT r, c FROM touched)"""


def footprints() -> str:
    """Each box's edges walked in 22 steps, from zone 43 by degrees to zone 44."""
    lon, lat = utm.unproject(Sql("x"), Sql("y"), 32643, SqlFunctions())
    east, north = projected("lon", "lat")
    box = 'SELECT s_suppkey AS id, (700000 + s_suppkey * 37 % 900 * 100)::DOUBLE AS l, (3300000 + s_suppkey * 53 % 700 * 100)::DOUBLE AS b, (700000 + s_suppkey * 37 % 900 * 100 + 1000 + s_suppkey % 50 * 100)::DOUBLE AS r, (3300000 + s_suppkey * 53 % 700 * 100 + 2000)::DOUBLE AS t FROM supplier'
    ring = " UNION ALL ".join(f"SELECT id, {x} AS x, {y} AS y FROM (SELECT *, k / 22.0::DOUBLE AS f FROM ({box}), range(23) s(k))" for x, y in (("l + f * (r - l)", "b"), ("l + f * (r - l)", "t"), ("l", "b + f * (t - b)"), ("r", "b + f * (t - b)")))
    ends = ", ".join(rint(f"{how}({c})", 2) + f' AS "{n}"' for how, c, n in (("min", "e", "left"), ("min", "n", "bottom"), ("max", "e", "right"), ("max", "n", "top")))
    return f"WITH ring AS MATERIALIZED ({ring}), degrees_ AS MATERIALIZED (SELECT id, {lon.text} AS lon, {lat.text} AS lat FROM ring), placed AS MATERIALIZED (SELECT id, {east} AS e, {north} AS n FROM degrees_) SELECT id, {ends} FROM placed GROUP BY id"


def oracle_sql() -> dict[str, str]:
    zonal = ", ".join(f"{rint(f'CAST({c} AS DOUBLE)', 3)} AS {c}" for c in ("mean_score", "max_score", "mean_slope", "max_slope", "min_road", "min_water", "mean_elevation", "mean_row", "mean_col"))
    x, y = "(186140.0::DOUBLE + (mean_col + 0.5) * 10.0)", "(3378690.0::DOUBLE - (mean_row + 0.5) * 10.0)"
    lon, lat = unprojected(x, y)
    fx, fy = projected("(77.75::DOUBLE + (event_id % 600) / 1000.0::DOUBLE)", "(29.9::DOUBLE + (event_id % 587) / 1000.0::DOUBLE)")
    ix, iy = unprojected("(186140.0::DOUBLE + (event_id % 5953) * 10)", "(3310650.0::DOUBLE + (event_id % 6800) * 10)")
    names = case("dominant", NAMES, "CAST(dominant AS VARCHAR)")
    at = lambda v: f"(x0 + (x1 - x0) * ({v} - y0) / nullif(y1 - y0, 0))"
    seg = "(CAST({k} AS DOUBLE))"
    return {
        "composite_median": over('SELECT "row", col, red, nir, clear FROM composite'),
        "composite_quality": over(f'SELECT "row" // 16 AS stripe, median(clear) AS median_clear, {rint("100 * avg(CAST(clear = 0 AS INT))", 4)} AS empty_pct FROM composite GROUP BY "row" // 16'),
        "landcover_recode": over(f"SELECT code, count(*) AS n, {case('code', MERGE, '0')} AS class FROM (SELECT [{', '.join(map(str, q.CODES))}][CAST(q AS INT) % 11 + 1] AS code FROM looks) GROUP BY code"),
        "landcover_histogram": over(f"SELECT landcover, count(*) AS pixels, {rint('100.0::DOUBLE * count(*) / sum(count(*)) OVER ()', 4)} AS share_pct FROM layers GROUP BY landcover"),
        "missing_classes": over("SELECT landcover, name FROM (VALUES " + ", ".join(f"({k}, '{NAMES[k]}')" for k in range(1, 7)) + ') t(landcover, name) WHERE landcover NOT IN (SELECT CASE WHEN landcover = 5 THEN 2 ELSE landcover END FROM layers)'),
        "elevation_summary": over(f"SELECT count(e) AS n, min(e) AS low, max(e) AS high, {percentiles('e', (1, 25, 50, 75, 99))}, {rint('100 * avg(CAST(e > 520 AS INT))', 4)} AS above_520, {rint('100 * avg(CAST(e <= 505 AS INT))', 4)} AS up_to_505 FROM (SELECT {rint('elevation', 4)} AS e FROM layers)"),
        "horn_slope": over('SELECT "row", col, slope FROM sloped'),
        "slope_exceedance": over(f"SELECT count(slope) AS n, min(slope) AS low, max(slope) AS high, {percentiles('slope', (50, 90, 99))}, " + ", ".join(f"{rint(f'100 * avg(CAST(slope > {c} AS INT))', 4)} AS above_{c}" for c in (5, 10, 15)) + " FROM sloped"),
        "coarse_slope": over(f"""SELECT g."row", g.col, {rint('s + 1e-7', 4)} AS slope FROM grid g LEFT JOIN (SELECT "row", col, sum(w * s) / nullif(sum(w), 0) AS s FROM
            (SELECT "row", col, r, c, (1 - abs(y - r)) * (1 - abs(x - c)) AS w FROM (SELECT "row", col, y, x, CAST(floor(y) AS BIGINT) + i AS r, CAST(floor(x) AS BIGINT) + j AS c FROM
            (SELECT "row", col, (30 + ("row" + 0.5::DOUBLE) * 10) / 30.0 - 0.5 AS y, (30 + (col + 0.5::DOUBLE) * 10) / 30.0 - 0.5 AS x FROM grid), range(2) a(i), range(2) b(j))) JOIN coarse_sloped USING (r, c) GROUP BY "row", col) USING ("row", col)"""),
        "layer_stack_valid": over('SELECT "row", col, landcover <> 2 AND coalesce(red, 0) <> 0 AS valid FROM layers LEFT JOIN composed USING ("row", col)'),
        "window_clip": over(f'SELECT "row", col, {rint("elevation", 4)} AS elevation FROM layers WHERE "row" BETWEEN 23 AND 89 AND col BETWEEN 15 AND 59'),
        "mosaic_first_wins": over('SELECT "row", col, red, rank AS tile_rank FROM (SELECT "row", col, scene AS rank, min(red) AS red, row_number() OVER (PARTITION BY "row", col ORDER BY scene) AS i FROM looks GROUP BY "row", col, scene) WHERE i = 1'),
        "tile_resolution": tile_sql("customer", "c_custkey", 1.5, 0.7, 1, "Copernicus_DSM_COG_10_", "_00_DEM", "_00_"),
        "cover_tile_resolution": tile_sql("supplier", "s_suppkey", 4, 2.5, 3, "ESA_WorldCover_10m_2021_v200_", "_Map", ""),
        "road_filter": "SELECT event_id, h AS highway FROM (SELECT event_id, CASE event_type WHEN 'view' THEN 'primary' WHEN 'signup' THEN 'footway' WHEN 'purchase' THEN 'track' WHEN 'error' THEN 'steps' WHEN 'click' THEN 'residential' END AS h FROM events) WHERE h IN (" + ", ".join(f"'{r}'" for r in scenes.ROADS) + ")",
        "water_filter": "SELECT p_partkey FROM part WHERE p_size % 5 = 0 OR p_size % 7 = 0 OR p_size % 11 = 0",
        "bbox_overlap": "SELECT s_suppkey, CAST(stripe AS INT) AS stripe FROM (SELECT s_suppkey, s_suppkey * 7 % 120 AS l, s_suppkey * 13 % 110 AS b, s_suppkey * 13 % 110 + s_suppkey % 40 AS t FROM supplier), range(8) r(stripe) WHERE l < 128 AND l + 20 > 0 AND b < 128 - stripe * 16 AND t > 128 - (stripe + 1) * 16",
        "coverage_grid": over(f"""SELECT count(*) AS occupied, {rint('count(*) / 100.0::DOUBLE', 4)} AS share, count(*) / 100.0 >= 0.5 AS covered FROM (SELECT DISTINCT CASE WHEN "row" < 104 THEN "row" // 13 ELSE 8 + ("row" - 104) // 12 END AS a, CASE WHEN col < 104 THEN col // 13 ELSE 8 + (col - 104) // 12 END AS b FROM layers WHERE water)"""),
        "distance_edt": over(f'SELECT "row", col, {rint("sqrt(n.d) * 10", 4)} AS distance FROM near_water'),
        "nearest_water_elevation": over(f'SELECT "row", col, n.fr AS near_row, n.fc AS near_col, {rint("elevation - n.fe", 4)} AS rise FROM near_water'),
        "binary_opening": over('SELECT "row", col, m = 1 AS mask FROM cleaned'),
        "clean_pixels": over('SELECT "row", col, m = 1 AS core FROM e2'),
        "edge_fraction": over(f"SELECT label, {rint('edge_fraction', 4)} AS edge_fraction FROM zonal"),
        "connected_components": over('SELECT "row", col, label FROM labels_'),
        "component_area_filter": over("SELECT label, pixels FROM large"),
        "zonal_stats": over(f"SELECT label, n, {zonal} FROM zonal"),
        "dominant_class": over(f"SELECT label, dominant, {names} AS name FROM main_class"),
        "site_flags": over("SELECT label, flags FROM flagged"),
        "top_sites": over(f"""SELECT CAST(row_number() OVER (ORDER BY score DESC, area_ha DESC, label) AS INT) AS rank, * EXCLUDE (label) FROM (SELECT label, {rint(lat, 6)} AS lat, {rint(lon, 6)} AS lon, {rint('mean_score', 1)} AS score, {rint('max_score', 1)} AS score_max,
            {rint('n * 0.01::DOUBLE', 2)} AS area_ha, {rint('mean_slope', 2)} AS mean_slope_deg, {rint('max_slope', 2)} AS max_slope_deg, {rint('min_road')} AS dist_road_m, {rint('min_water')} AS dist_water_m, {rint('mean_elevation', 1)} AS mean_elevation_m, {names} AS dominant_landcover, flags
            FROM flagged JOIN main_class USING (label)) ORDER BY rank LIMIT 5"""),
        "suitability_parity": over('SELECT "row", col, score FROM plain'),
        "suitability_weighted": over(f'SELECT "row", col, {weighted(scoring.WEIGHTS)} AS score FROM stack'),
        "score_summary": over(f"SELECT {rint('100 * avg(CAST(score = 0 AS INT))', 4)} AS excluded_pct_of_all, {rint('100 * avg(CAST(score = 0 AS INT))', 4)} AS excluded_pct_of_valid, quantile_cont(score, 0.5) FILTER (score > 0) AS p50, quantile_cont(score, 0.9) FILTER (score > 0) AS p90, max(score) FILTER (score > 0) AS top FROM plain"),
        "sensitivity": sensitivity(),
        "heatmap_rgb": over(f'SELECT "row", col, {rgb("score", 0)} AS r, {rgb("score", 1)} AS g, {rgb("score", 2)} AS b FROM plain'),
        "class_rgb": over('SELECT "row", col, ' + ", ".join(f"{case('landcover', {k: v[i] for k, v in PALETTE.items()}, '0')} AS {n}" for i, n in enumerate("rgb")) + " FROM layers"),
        "quicklook_stretch": over('SELECT "row", col, CAST(trunc(coalesce(least(255.0, greatest(0.0, (nullif(red, 0) - lo) / (CASE WHEN hi <= lo THEN 1 ELSE hi - lo END) * 255)), 0.0)) AS INT) AS byte FROM composite, (SELECT quantile_cont(nullif(red, 0), 0.02) AS lo, quantile_cont(nullif(red, 0), 0.98) AS hi FROM composite)'),
        "decimate_average": over(f'SELECT "row" // 4 AS "row", col // 4 AS col, {rint("avg(elevation) + 1e-7", 4)} AS elevation FROM layers GROUP BY "row" // 4, col // 4'),
        "decimate_nearest": over('SELECT "row" // 3 AS "row", col // 3 AS col, score FROM plain WHERE "row" % 3 = 0 AND col % 3 = 0'),
        "stripe_partition": over('SELECT "row" // 24 AS stripe, count(*) AS n, min("row") AS first_row, max("row") AS last_row FROM looks GROUP BY "row" // 24'),
        "split_expand_buffer": over('SELECT "row", col, split FROM split'),
        "patch_origins": over(" UNION ALL ".join(patches(v, s) for v in (1, 2) for s in (q.PATCH, q.PATCH // 2))),
        "class_balance": over(f'SELECT split, landcover, {rint("100.0::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY split)", 2)} AS pct FROM split JOIN layers USING ("row", col) WHERE landcover <> 0 GROUP BY split, landcover'),
        "split_shares": over(f"SELECT split, {rint('100.0::DOUBLE * count(*) / sum(count(*)) OVER ()', 4)} AS pct FROM split GROUP BY split"),
        "band_stats": over(band_rows("true", "whole")),
        "train_vs_region_stats": over(f"SELECT band, {rint('abs(a.mean - b.mean)', 3)} AS gap, {rint('100 * abs(a.mean - b.mean) / nullif(b.std, 0)', 3)} AS pct_of_std FROM ({band_rows('split = 1', 'train')}) a JOIN ({band_rows('true', 'whole')}) b USING (band)"),
        "scene_search": over("SELECT id, tile, cloud FROM scenes WHERE id % 10 <= 4.5 AND id % 10 + 1 >= 2 AND id % 7 <= 3 AND id % 7 + 1 >= 1 AND ts BETWEEN '2024-01-05 00:00:00' AND '2024-01-20 00:00:00' AND cloud < 40"),
        "scene_topn": over("SELECT tile, id, cloud FROM kept"),
        "scene_report": over("SELECT tile, CAST(sum(k) AS BIGINT) AS scenes, min(lo) AS min_cloud, max(hi) AS max_cloud, string_agg(m || 'x' || k, ' ' ORDER BY m) AS months FROM (SELECT tile, month(ts) AS m, count(*) AS k, min(cloud) AS lo, max(cloud) AS hi FROM kept GROUP BY tile, month(ts)) GROUP BY tile"),
        "scene_properties": over("SELECT tile, CASE WHEN id % 2 = 0 THEN 32644 ELSE 32646 END AS epsg, count(*) AS n FROM scenes GROUP BY ALL"),
        "tile_starvation": over("SELECT DISTINCT event_type || '-' || (id % 97) AS tile FROM scenes WHERE event_type || '-' || (id % 97) NOT IN (SELECT event_type || '-' || (id % 97) FROM scenes WHERE cloud < 8)"),
        "manifest_json": over("SELECT 'A' AS region, CAST(count(*) OVER () AS INT) AS scene_count, CAST(row_number() OVER (ORDER BY tile, strftime(ts, '%Y-%m-%d %H:%M:%S'), id) - 1 AS INT) AS place, id, tile, strftime(ts, '%Y-%m-%d %H:%M:%S') AS datetime FROM kept"),
        "numeral_extract": over("SELECT doc_id, numeral FROM found"),
        "numeral_verify": over(f"SELECT numeral, count(*) AS docs FROM found WHERE numeral NOT IN (SELECT numeral FROM ({COMMON['found'].replace('doc_id', 'item_id').replace('documents', 'benchmark')})) GROUP BY numeral"),
        "verdict_bucket": "SELECT CASE WHEN l_quantity * 2 >= 70 THEN 'strong' WHEN l_quantity * 2 >= 50 THEN 'workable' WHEN l_quantity * 2 >= 30 THEN 'marginal' ELSE 'poor' END AS verdict, count(*) AS n FROM lineitem GROUP BY 1",
        "confusion_matrix": over("SELECT label, pred, count(*) AS n FROM pairs GROUP BY label, pred"),
        "miou_f1": over(f"SELECT c AS class, {rint('h / (l + p - h)::DOUBLE', 6)} AS iou, {rint('2 * h / (l + p)::DOUBLE', 6)} AS f1 FROM (SELECT c, (SELECT count(*) FROM pairs WHERE label = c) AS l, (SELECT count(*) FROM pairs WHERE pred = c) AS p, (SELECT count(*) FROM pairs WHERE label = c AND pred = c) AS h FROM (SELECT label AS c FROM pairs UNION SELECT pred FROM pairs))"),
        "class_weights": over(f"SELECT landcover, {rint('median(n) OVER () / n', 6)} AS weight FROM (SELECT landcover, count(*) AS n FROM layers WHERE landcover <> 0 GROUP BY landcover)"),
        "wet_label_agreement": over(f'SELECT count(*) AS pixels, {rint("100 * avg(CAST(nir < 5000 AS INT))", 4)} AS agree_pct FROM layers JOIN composite USING ("row", col) WHERE landcover = 6 AND nir > 0'),
        "window_values": over('SELECT DISTINCT landcover FROM layers WHERE "row" BETWEEN 60 AND 67 AND col BETWEEN 60 AND 67 AND landcover <> 0'),
        "utm_forward": f"SELECT event_id, {rint(fx, 2)} AS x, {rint(fy, 2)} AS y FROM events",
        "utm_inverse": f"SELECT event_id, {rint(ix, 6)} AS lon, {rint(iy, 6)} AS lat FROM events",
        "rasterize_segments": f"""SELECT DISTINCT CAST(r AS INT) AS "row", CAST(c AS INT) AS col FROM (SELECT r, unnest(range(CAST(greatest(0, floor(least(a, b))) AS BIGINT), CAST(least(127, floor(greatest(a, b))) AS BIGINT) + 1)) AS c FROM
            (SELECT r, CASE WHEN y0 = y1 THEN x0 ELSE {at('greatest(least(y0, y1), r)')} END AS a, CASE WHEN y0 = y1 THEN x1 ELSE {at('least(greatest(y0, y1), r + 1)')} END AS b FROM
            (SELECT {seg.format(k='s_suppkey * 17 % 1280')} / 10.0 + 0.05::DOUBLE AS x0, {seg.format(k='s_suppkey * 29 % 1280')} / 10.0 + 0.05::DOUBLE AS y0, {seg.format(k='s_suppkey * 43 % 1280')} / 10.0 + 0.03::DOUBLE AS x1, {seg.format(k='s_suppkey * 71 % 1280')} / 10.0 + 0.03::DOUBLE AS y1 FROM supplier) s, range(128) t(r)
            WHERE r BETWEEN floor(least(y0, y1)) AND floor(greatest(y0, y1))))""",
        "polygon_fill": polygons(),
        "scene_footprints": footprints(),
        "exact_rounding": "SELECT v, round_even(v, 2) AS rounded, count(*) AS n FROM (SELECT l_quantity / 8 AS v FROM lineitem) GROUP BY v",
        "region_grids": "SELECT * FROM (VALUES ('A', 32644, 186140::DOUBLE, 3378690::DOUBLE, 10::DOUBLE, 5953, 6804), ('B', 32646, 579260::DOUBLE, 3003940::DOUBLE, 10::DOUBLE, 7004, 5603)) t(id, epsg, x0, y0, res, width, height)",
        "seeded_blocks": "SELECT * FROM (VALUES " + ", ".join(f"('{r}', {a}, {b})" for r, blocks in splits.VAL_BLOCKS.items() for a, b in blocks) + ") t(id, block_row, block_col)",
        "resample_bilinear": resampled("bilinear", "elevation", 'NOT ("row" = 20 AND col = 20)', rint("{v} + 1e-7", 4)),
        "resample_cubic": resampled("cubic", "elevation", 'true', rint("{v} + 1e-7", 4)),
        "resample_nearest": resampled("nearest", "landcover", 'true', "CAST({v} AS INT)"),
        "region_catalog": "SELECT * FROM (VALUES ('A', 'dehradun', 32644, 77.75::DOUBLE, 30.5::DOUBLE), ('B', 'majuli', 32646, 93.8::DOUBLE, 27.15::DOUBLE)) t(id, name, epsg, west, north)",
    }
