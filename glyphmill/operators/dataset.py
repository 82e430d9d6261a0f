"""Lines back to one canonical record a sample, and the counts of a data set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from . import augment, content, layout


def canonical(lines: DataFrame, difficulty: str, requested: int) -> DataFrame:
    """id, category, image_file, width, height, content (array of lines), metadata; the one shuffle of the line path."""
    line = F.struct("id", "group_id", G.as_array(F.col("b")).alias("bbox_2d"), "text", "translated_text", "source_language", "kind")
    per = lines.groupBy("sample_id", "seed", "category", "width", "height").agg(F.array_sort(F.collect_list(line)).alias("content"), F.any_value("meta").alias("meta"), F.any_value("aug").alias("augmentation"))
    meta = F.struct("meta.*", F.col("sample_id"), F.col("seed"), F.sort_array(F.array_distinct(F.transform("content", lambda x: x["source_language"]))).alias("source_languages"), F.lit("cache/content").alias("content_cache"), F.col("augmentation"), F.lit(difficulty).alias("difficulty"), F.lit(requested).alias("requested_blocks"), F.size("content").alias("rendered_line_count"))
    return per.select(F.col("sample_id").alias("id"), "category", F.concat(F.lit("images/"), "sample_id", F.lit(".png")).alias("image_file"), "width", "height", "content", meta.alias("metadata"))


def generate(rows: DataFrame, payload: DataFrame, difficulty: str, requested: int, augmented: bool) -> DataFrame:
    placed = layout.lines(content.blocks(payload, rows), difficulty)
    return canonical(augment.apply(placed, augmented), difficulty, requested)


def counts(records: DataFrame, by) -> dict[str, int]:
    return {r["k"]: r["n"] for r in records.groupBy(by.alias("k")).agg(F.count("*").alias("n")).orderBy("k").collect()}
