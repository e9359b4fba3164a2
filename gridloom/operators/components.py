"""8-connected components of a sparse mask.

Rows become runs, runs join inside stripes by union-find (one task each, of bounded height),
and stripes join along their borders: overlapping border runs are edges between stripe
labels, and the graph's parts rename them. The label is the component's least linear index.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators.graph import parts
from gridloom.sources.scratch import materialise

STRIPE, BIN = 256, 64


def runs_of(mask: DataFrame) -> DataFrame:
    """(row, c0, c1): maximal runs of neighbouring columns among the mask's cells (row, col)."""
    nth = F.row_number().over(Window.partitionBy("row").orderBy("col"))
    return mask.select("row", "col", (F.col("col") - nth).alias("g")).groupBy("row", "g").agg(F.min("col").alias("c0"), F.max("col").alias("c1")).drop("g")


def join_runs(runs: pd.DataFrame, width: int) -> pd.DataFrame:
    """Labels for the runs of one stripe: runs of neighbouring rows join where they touch, corners included."""
    runs = runs.sort_values(["row", "c0"]).reset_index(drop=True)
    rows, c0, c1 = runs["row"].tolist(), runs["c0"].tolist(), runs["c1"].tolist()
    parent = list(range(len(runs)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    above = 0
    for i in range(len(runs)):
        while above < i and (rows[above] < rows[i] - 1 or rows[above] == rows[i] - 1 and c1[above] < c0[i] - 1):
            above += 1
        j = above
        while j < i and rows[j] == rows[i] - 1 and c0[j] <= c1[i] + 1:
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
            j += 1
    first = [rows[find(i)] * width + c0[find(i)] for i in range(len(runs))]  # roots are first in raster order
    runs["label"] = pd.Series(first, dtype="int64")
    return runs


def labelled_runs(mask: DataFrame, width: int, stripe: int = STRIPE) -> DataFrame:
    """(row, c0, c1, label) with labels that hold across stripes."""
    schema = "stripe int, row int, c0 int, c1 int, label long"
    cells = mask.select(F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"))
    local = runs_of(cells).withColumn("stripe", F.expr(f"CAST(row DIV {stripe} AS INT)")).groupBy("stripe").applyInPandas(lambda pdf: join_runs(pdf, width)[["stripe", "row", "c0", "c1", "label"]], schema)
    local = materialise(local, "runs")
    bins = F.explode(F.sequence(F.floor((F.col("c0") - 1) / BIN), F.floor((F.col("c1") + 1) / BIN)))
    low = local.filter((F.col("row") + 1) % stripe == 0).select((F.col("row") + 1).alias("border"), "c0", "c1", F.col("label").alias("a")).withColumn("bin", bins)
    high = local.filter((F.col("row") % stripe == 0) & (F.col("row") > 0)).select(F.col("row").alias("border"), F.col("c0").alias("d0"), F.col("c1").alias("d1"), F.col("label").alias("b")).select("*", F.explode(F.sequence(F.floor(F.col("d0") / BIN), F.floor(F.col("d1") / BIN))).alias("bin"))
    edges = low.join(high, ["border", "bin"]).filter("c0 <= d1 + 1 AND d0 <= c1 + 1").select("a", "b").distinct()
    names = parts(edges).select(F.col("node").alias("label"), "part")
    return local.join(names, "label", "left").select("row", "c0", "c1", F.coalesce("part", "label").alias("label"))


def components(mask: DataFrame, width: int, stripe: int = STRIPE) -> DataFrame:
    """(row, col, label) for every cell of the mask."""
    return labelled_runs(mask, width, stripe).select("row", F.explode(F.sequence("c0", "c1")).alias("col"), "label")


def sizes(labels: DataFrame) -> DataFrame:
    return labels.groupBy("label").agg(F.count(F.lit(1)).alias("pixels"))


def least_pixels(hectares: float, res: float) -> int:
    return max(round(hectares * 10_000 / res**2), 1)
