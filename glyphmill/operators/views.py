"""Projections of one canonical record: vlm, ocr, trans, chat, manifest, canonical."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INSTRUCTION = "Read every line of text in this image. Give each line with its box and its Vietnamese translation as JSON."


def json(c: Column) -> Column:
    return F.to_json(c, {"ignoreNullFields": "false"})


def _content(*fields: str) -> Column:
    return F.transform("content", lambda x: F.struct(*[x[f].alias(f) for f in fields]))


def vlm() -> Column:
    return F.struct(F.col("category"), _content("bbox_2d", "text", "translated_text").alias("content"))


def ocr() -> Column:
    return _content("bbox_2d", "text")


def trans() -> Column:
    return _content("id", "text", "translated_text")


def canonical() -> Column:
    image = F.struct(F.col("image_file").alias("file_name"), F.col("width"), F.col("height"))
    return F.struct("id", "category", image.alias("image"), _content("id", "group_id", "bbox_2d", "text", "translated_text", "source_language", "kind").alias("content"), "metadata")


def paths() -> Column:
    return F.struct(*[F.concat(F.lit(f"annotations/{v}/"), F.col("id"), F.lit(".json")).alias(v) for v in ("canonical", "vlm", "ocr", "trans")])


def manifest() -> Column:
    languages = F.sort_array(F.array_distinct(F.transform("content", lambda x: x["source_language"])))
    return F.struct("id", "category", F.col("image_file").alias("image"), "width", "height", F.size("content").alias("line_count"), languages.alias("languages"), F.col("metadata.renderer").alias("renderer"), F.col("metadata.augmentation").alias("augmentation"), paths().alias("paths"))


def wrapped(view: Column) -> Column:
    return F.struct(F.col("id"), F.col("image_file").alias("image"), view.alias("output"))


def chat() -> Column:
    """The record as JSON text: a user's content is a list of parts, the assistant's a string."""
    text = lambda c: F.substring(json(F.struct(c.alias("a"))), F.lit(6), F.length(json(F.struct(c.alias("a")))) - 6)  # noqa: E731  a string as JSON
    return F.concat(F.lit('{"id":'), text(F.col("id")), F.lit(',"image":'), text(F.col("image_file")), F.lit(',"messages":[{"role":"user","content":[{"type":"image","image":'), text(F.col("image_file")),
                    F.lit('},{"type":"text","text":'), text(F.lit(INSTRUCTION)), F.lit('}]},{"role":"assistant","content":'), text(json(vlm())), F.lit("}]}"))
