"""Composites that follow arriving scenes. An extra: the batch jobs stay the reference.

Looks arrive as Parquet files. Each micro-batch appends them to the looks table and remakes
only the stripes they touch, so a batch's work follows its own size. Repeats of a scene's
look are dropped within the watermark; rewriting a stripe is idempotent, so a replayed
batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridloom.grid import Grid
from gridloom.operators import composite


def looks_stream(spark: SparkSession, path: str, schema: str, late: str = "2 days") -> DataFrame:
    """The stream of looks with a time ``ts``, each scene's look at a pixel once."""
    return spark.readStream.schema(schema).parquet(path).withWatermark("ts", late).dropDuplicatesWithinWatermark(["scene", "row", "col"])


def clear_counts(stream: DataFrame, stripe: int, window: str = "1 day") -> DataFrame:
    """Clear looks by day and stripe, for append output."""
    seen = stream.filter(F.col("scl").isin(*composite.CLEAR))
    return seen.groupBy(F.window("ts", window).alias("day"), F.expr(f"CAST(row DIV {stripe} AS INT)").alias("stripe")).agg(F.count(F.lit(1)).alias("clear"))


def follow(stream: DataFrame, grid: Grid, bands: Sequence[str], looks_path: str, composite_path: str, checkpoint: str, stripe: int = 512) -> StreamingQuery:
    """Keeps a composite table by stripe up to date; once started, it takes what there is and stops."""
    number = F.expr(f"CAST(row DIV {stripe} AS INT)")

    def update(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("stripe", number).withColumn("batch", F.lit(batch_id))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "stripe").parquet(looks_path)
        known = spark.read.parquet(looks_path)
        touched = [r["stripe"] for r in known.filter(F.col("batch") == batch_id).select("stripe").distinct().collect()]  # at most the grid's stripes
        if not touched:
            return
        own = known.filter(F.col("stripe").isin(touched))
        made = composite.on_grid(composite.median_composite(own, bands), grid, bands).withColumn("stripe", number).filter(F.col("stripe").isin(touched))
        made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("stripe").parquet(composite_path)

    return stream.writeStream.foreachBatch(update).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
