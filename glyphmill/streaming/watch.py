"""Structured Streaming over the manifest of a data set that grows: running counts and progress."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def manifest_stream(spark: SparkSession, path: str) -> DataFrame:
    """id, category, renderer and line_count of each manifest line as files arrive."""
    lines = spark.readStream.text(path).filter(F.trim("value") != "").select(F.try_parse_json("value").alias("v"))
    get = lambda n, kind="string": F.try_variant_get("v", f"$.{n}", kind).alias(n)
    return lines.select(get("id"), get("category"), F.coalesce(get("renderer"), F.lit("None")).alias("renderer"), get("line_count", "int"))


def running_counts(manifest: DataFrame) -> DataFrame:
    """Samples and lines by category and renderer; partial sums meet before the shuffle."""
    return manifest.groupBy("category", "renderer").agg(F.count("*").alias("n_samples"), F.sum("line_count").alias("n_lines"))


def pace(completed: Column, total: Column, seconds: Column) -> tuple[Column, Column]:
    """(samples a second, seconds left); elapsed time counts as a millisecond at least, and nothing done leaves it unknown."""
    rate = completed / F.greatest(seconds, F.lit(0.001))
    return rate, F.when(rate > 0, (total - completed) / rate)


def progress(manifest: DataFrame, total: int, tell: Callable[[dict], None], checkpoint: str):
    """Calls tell after each micro-batch with the samples completed so far. Returns the started query."""
    done = {"n": 0, "seen": -1}

    def batch(df: DataFrame, epoch: int) -> None:
        if epoch > done["seen"]:  # a batch that is run again counts once
            done["n"], done["seen"] = done["n"] + df.count(), epoch
            tell({"phase": "generate", "completed": done["n"], "total": total})

    return manifest.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
