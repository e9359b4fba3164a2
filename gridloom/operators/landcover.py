"""Land-cover codes: merging, histograms and missing classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.numbers import rint

# Source codes to merged classes, and the classes' names.
MERGE = {10: 1, 20: 2, 30: 2, 40: 3, 50: 4, 60: 5, 70: 0, 80: 6, 90: 6, 95: 6, 100: 5}
NAMES = {0: "nodata", 1: "trees", 2: "shrub+grass", 3: "cropland", 4: "built", 5: "bare", 6: "water+wetland"}


def merged(code: Column) -> Column:
    """The merged class of a source code; unknown codes are nodata."""
    table = F.create_map(*[F.lit(x) for pair in MERGE.items() for x in pair])
    return F.coalesce(F.try_element_at(table, code.cast("int")), F.lit(0))


def named(code: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, code.cast("int")), code.cast("string"))


def histogram(layer: DataFrame, code: str = "landcover") -> DataFrame:
    """Pixels and share of all pixels by class, nodata included."""
    counts = layer.groupBy(code).agg(F.count(F.lit(1)).alias("pixels"))
    total = counts.agg(F.sum("pixels").alias("total"))  # one row
    return counts.crossJoin(F.broadcast(total)).select(code, "pixels", rint(100.0 * F.col("pixels") / F.col("total"), 4).alias("share_pct"))


def missing(layer: DataFrame, code: str = "landcover") -> DataFrame:
    """The classes from 1 to 6 that no pixel has."""
    spark = layer.sparkSession
    wanted = spark.createDataFrame([(k, NAMES[k]) for k in range(1, 7)], f"{code} int, name string")
    return wanted.join(layer.select(code).distinct(), code, "left_anti")
