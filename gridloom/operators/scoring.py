"""Suitability scores: whole numbers from 1 to 100, and 0 for excluded or invalid pixels."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.numbers import rint

Scorer = Callable[[DataFrame], Column]
# Weights, and our curves' knots where the design gives only rules.
WEIGHTS = {"slope": 0.30, "landcover": 0.30, "flood": 0.20, "road": 0.10, "water": 0.10}
CURVES = {"slope": ((0, 1.0), (5, 1.0), (10, 0.5), (15, 0.0)), "road": ((0, 1.0), (5000, 0.3), (10000, 0.0)), "water": ((0, 0.2), (200, 1.0), (1500, 1.0), (5000, 0.0))}
COVER = {1: 0.2, 2: 1.0, 3: 0.6, 5: 1.0}
MAX_SLOPE, EXCLUDED_COVER, FLOOD_RISE, FLOOD_REACH, FLOOD_FACTOR = 15.0, (0, 4, 6), 5.0, 1000.0, 0.1


def valid(layers: tuple[str, ...] = ("slope", "landcover", "elevation", "dist_road", "dist_water")) -> Column:
    """All layers hold a value."""
    out = F.lit(True)
    for name in layers:
        out = out & F.col(name).isNotNull()
    return out


def parity() -> Column:
    """The plain scorer: 100 less 4 a degree, cut to 1..100 and truncated; steep, built, wet and invalid ground is 0."""
    raw = F.least(F.lit(100.0), F.greatest(F.lit(1.0), 100 - 4 * F.col("slope"))).cast("int")
    out = (F.col("slope") > MAX_SLOPE) | F.col("landcover").isin(4, 6) | ~F.col("valid")
    return F.when(F.coalesce(out, F.lit(True)), 0).otherwise(raw)


def piecewise(x: Column, knots: tuple[tuple[float, float], ...]) -> Column:
    """Straight lines between knots, level beyond the ends."""
    out = F.lit(float(knots[-1][1]))
    for (x0, y0), (x1, y1) in reversed(list(zip(knots, knots[1:], strict=False))):
        out = F.when(x < x1, y0 + (y1 - y0) * (x - x0) / float(x1 - x0)).otherwise(out)
    return F.when(x < knots[0][0], float(knots[0][1])).otherwise(out)


def factors() -> dict[str, Column]:
    cover = F.create_map(*[F.lit(v) for pair in COVER.items() for v in pair])
    low = (F.col("rise") < FLOOD_RISE) & (F.col("dist_water") <= FLOOD_REACH)
    return {
        "slope": piecewise(F.col("slope"), CURVES["slope"]),
        "landcover": F.coalesce(F.try_element_at(cover, F.col("landcover")), F.lit(0.0)),
        "flood": F.when(low, FLOOD_FACTOR).otherwise(1.0),
        "road": piecewise(F.col("dist_road"), CURVES["road"]),
        "water": piecewise(F.col("dist_water"), CURVES["water"]),
    }


def weighted(weights: Mapping[str, float] = WEIGHTS) -> Column:
    """The weighted sum of the factors; exclusions apply after it, so no factor can outweigh them."""
    total = sum((weights[k] * f for k, f in factors().items()), F.lit(0.0))
    excluded = (F.col("slope") > MAX_SLOPE) | F.col("landcover").isin(*EXCLUDED_COVER) | ~F.col("valid")
    whole = F.greatest(F.lit(1), F.least(F.lit(100), F.rint(rint(100 * total, 6)).cast("int")))
    return F.when(F.coalesce(excluded, F.lit(True)), 0).otherwise(whole)


def scenarios(by: float = 0.2) -> list[tuple[str, dict[str, float]]]:
    """Each weight up and down by a share, the others keeping their proportions."""
    out = []
    for name in WEIGHTS:
        for sign in (1, -1):
            w = WEIGHTS[name] * (1 + sign * by)
            rest = (1 - w) / (1 - WEIGHTS[name])
            out.append((f"{name}{'+' if sign > 0 else '-'}", {k: w if k == name else v * rest for k, v in WEIGHTS.items()}))
    return out


def contract(scores: DataFrame, pixels: int, column: str = "score") -> None:
    """Fails unless there is a whole score from 0 to 100 for each pixel."""
    row = scores.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(column).isNull() | ~F.col(column).between(0, 100)).alias("bad")).first()
    if row["n"] != pixels or row["bad"]:
        raise ValueError(f"scores: {row['n']} pixels of {pixels}, {row['bad']} outside 0..100")


def score_summary(scores: DataFrame, column: str = "score") -> DataFrame:
    """Share excluded, of all pixels and of valid ones, and percentiles of the scores above 0; one row."""
    s = F.col(column)
    some = F.when(s > 0, s)
    return scores.agg(
        rint(100 * F.avg((s == 0).cast("int")), 4).alias("excluded_pct_of_all"),
        rint(100 * F.count_if((s == 0) & F.col("valid")) / F.count_if("valid"), 4).alias("excluded_pct_of_valid"),
        F.percentile(some, F.lit(0.5)).alias("p50"), F.percentile(some, F.lit(0.9)).alias("p90"), F.max(some).alias("top"),
    )
