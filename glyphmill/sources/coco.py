"""COCO annotation files: annotations joined to their images and categories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = """info struct<description string, version string, year string, date_created string>,
licenses array<struct<id bigint, url string, name string>>,
categories array<struct<id bigint, name string, supercategory string>>,
images array<struct<id bigint, license bigint, file_name string, height int, width int, date_captured string>>,
annotations array<struct<id bigint, image_id bigint, category_id bigint, bbox array<double>, area double, iscrowd int>>"""


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row an annotation: box (x, y, width, height) and canonical box (x1, y1, x2, y2), image and category."""
    doc = spark.read.schema(SCHEMA).option("multiLine", True).json(path)
    flat = lambda name: doc.select(F.explode(name).alias("r")).select("r.*")
    a = flat("annotations")
    i = flat("images").select(F.col("id").alias("image_id"), "file_name", "width", "height", F.to_timestamp("date_captured").alias("captured"))
    c = flat("categories").select(F.col("id").alias("category_id"), F.col("name").alias("category"))
    x, y, w, h = (F.get("bbox", k) for k in range(4))
    whole = F.array(*[F.bround(v, 0).cast("int") for v in (x, y, x + w, y + h)])
    return a.join(i, "image_id").join(c, "category_id").select("id", "image_id", "file_name", "width", "height", "captured", "category", "bbox", whole.alias("bbox_2d"), "area", F.abs(F.col("area") - w * h).alias("area_gap"))
