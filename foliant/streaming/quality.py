"""Text quality of blocks as they arrive, and the share of bad ones over time. An addition to the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators.quality import with_quality


def block_stream(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def scored(stream: DataFrame) -> DataFrame:
    """Row by row, so it needs no state."""
    return with_quality(stream)


def bad_share(stream: DataFrame, time: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Blocks and bad blocks per window and source; windows close when the watermark passes them."""
    q = with_quality(stream).withWatermark(time, late)
    g = q.groupBy(F.window(time, window), "source").agg(F.count("*").alias("blocks"), F.count_if(F.col("status") == "bad").alias("bad"))
    return g.select(F.col("window.start").alias("start"), "source", "blocks", "bad")


def write(stream: DataFrame, path: str, checkpoint: str):
    """Reads what there is and stops; the next call goes on from the checkpoint."""
    return stream.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
