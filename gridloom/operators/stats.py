"""Normalisation statistics and agreement between labels, predictions and imagery."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.numbers import rint

POINTS = (1, 2, 50, 98, 99)


def band_statistics(pixels: DataFrame, bands: Sequence[str], scopes: dict[str, Column] | None = None) -> DataFrame:
    """count, mean, population std, extremes and percentiles by scope and band, over values above fill.

    Scopes are conditions; all of them are counted in one pass over (scope, band) groups. The
    exact percentiles combine counts of distinct values on the map side.
    """
    scopes = scopes or {"whole": F.lit(True)}
    tagged = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in scopes.items()]))
    values = F.explode(F.array(*[F.struct(F.lit(b).alias("band"), F.col(b).cast("double").alias("v")) for b in bands]))
    long = pixels.select(tagged.alias("scopes"), values.alias("x")).select(F.explode("scopes").alias("scope"), "x.*")
    return long.filter("v != 0").groupBy("scope", "band").agg(
        F.count("v").alias("count"), rint(F.avg("v"), 3).alias("mean"), rint(F.stddev_pop("v"), 3).alias("std"), F.min("v").alias("min"), F.max("v").alias("max"),
        *[rint(F.percentile("v", F.lit(p / 100)), 3).alias(f"p{p}") for p in POINTS],
    )


def drift(stats: DataFrame, one: str = "train", other: str = "whole") -> DataFrame:
    """The difference of means, and its percentage of the other scope's std."""
    a = stats.filter(F.col("scope") == one).select("band", F.col("mean").alias("m1"))
    b = stats.filter(F.col("scope") == other).select("band", F.col("mean").alias("m2"), F.col("std").alias("s2"))
    gap = F.abs(F.col("m1") - F.col("m2"))
    return a.join(b, "band").select("band", rint(gap, 3).alias("gap"), rint(100 * gap / F.nullif("s2", F.lit(0.0)), 3).alias("pct_of_std"))


def confusion(pairs: DataFrame) -> DataFrame:
    """(label, pred, n)."""
    return pairs.groupBy("label", "pred").agg(F.count(F.lit(1)).alias("n"))


def agreement(matrix: DataFrame) -> DataFrame:
    """Intersection over union and F1 by class, from a confusion matrix of classes squared rows."""
    sides = matrix.select("n", F.explode(F.array(F.struct(F.col("label").alias("k"), F.lit(1).alias("is_label"), F.lit(0).alias("is_pred")), F.struct(F.col("pred").alias("k"), F.lit(0).alias("is_label"), F.lit(1).alias("is_pred")))).alias("s"), (F.col("label") == F.col("pred")).cast("int").alias("hit"))
    by = sides.groupBy(F.col("s.k").alias("class")).agg(F.sum(F.col("n") * F.col("s.is_label")).alias("labelled"), F.sum(F.col("n") * F.col("s.is_pred")).alias("predicted"), F.sum(F.col("n") * F.col("s.is_label") * F.col("hit")).alias("hits"))
    return by.select("class", rint(F.col("hits") / (F.col("labelled") + F.col("predicted") - F.col("hits")), 6).alias("iou"), rint(2 * F.col("hits") / (F.col("labelled") + F.col("predicted")), 6).alias("f1"))


def class_weights(layer: DataFrame, code: str = "landcover") -> DataFrame:
    """Median frequency over a class's own frequency, nodata left out."""
    counts = layer.filter(F.col(code) != 0).groupBy(code).agg(F.count(F.lit(1)).alias("n"))
    middle = counts.agg(F.median("n").alias("m"))
    return counts.crossJoin(F.broadcast(middle)).select(code, rint(F.col("m") / F.col("n"), 6).alias("weight"))


def wet_agreement(pixels: DataFrame, wet: int = 6, nir_below: int = 1200) -> DataFrame:
    """The share of pixels labelled wet whose near infrared is low; one row."""
    seen = pixels.filter((F.col("landcover") == wet) & (F.col("nir") > 0))
    return seen.agg(F.count(F.lit(1)).alias("pixels"), rint(100 * F.avg((F.col("nir") < nir_below).cast("int")), 4).alias("agree_pct"))
