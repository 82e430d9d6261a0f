"""Generate and validate data sets; the functions behind the command lines."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .constants import BLOCKS, DEFAULT_COUNT, DEFAULT_MODELS, DEFAULT_SEED, PROVIDERS
from .operators import content, dataset
from .operators import validate as checks
from .sources import files, images

RENDERERS = ("auto", "playwright", "pillow")


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _located(path: str) -> str:
    import os

    return path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}"


def _put(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _path(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def validate_dataset(spark: SparkSession, path: str) -> dict:
    """Counts and ordered errors of a written data set. A missing manifest raises FileNotFoundError."""
    path = _located(path)
    fs, p = _path(spark, f"{path}/manifest.jsonl")
    if not fs.exists(p):
        raise FileNotFoundError(f"Missing manifest: {path}/manifest.jsonl")
    samples, chat = files.read_dataset(spark, path)
    samples = samples.cache()
    try:
        errors = [r.message for r in checks.ordered(checks.sample_errors(samples).unionByName(checks.chat_errors(chat, samples))).collect()]
        body = F.try_variant_get(F.try_parse_json("canonical"), "$.content", "array<variant>")
        language = samples.filter("width IS NOT NULL").select(F.explode(body).alias("x")).select(F.coalesce(checks._said(F.try_variant_get("x", "$.source_language", "variant")), F.lit("unknown")).alias("language"))
        return {
            "sample_count": samples.count(), "category_counts": dataset.counts(samples, F.col("category")), "language_counts": dataset.counts(language, F.col("language")),
            "renderer_counts": dataset.counts(samples, F.col("renderer")), "error_count": len(errors), "errors": errors,
        }
    finally:
        samples.unpersist()


def generate_records(spark: SparkSession, count: int = DEFAULT_COUNT, seed: int = DEFAULT_SEED, *, augment: bool = True, difficulty: str = "normal", blocks_per_sample: int | None = None, content_provider: str = "fallback", content_model: str | None = None, fetch: content.Provider | None = None, cache: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(canonical records, content payloads), lazily; the payloads are a cache for a later run."""
    if difficulty not in BLOCKS:
        raise ValueError("difficulty must be one of: normal, dense")
    requested = BLOCKS[difficulty] if blocks_per_sample is None else blocks_per_sample
    rows = content.samples(spark, count, seed)
    payload = content.payloads(rows, requested, content_provider, content_model, fetch, cache)
    return dataset.generate(rows, payload, difficulty, requested, augment), payload


def generate_dataset(
    spark: SparkSession, output_dir: str, count: int = DEFAULT_COUNT, seed: int = DEFAULT_SEED, *, augment: bool = True, clean: bool = False, difficulty: str = "normal", blocks_per_sample: int | None = None,
    content_provider: str | None = None, content_model: str | None = None, fetch: content.Provider | None = None, game_renderer: str = "auto", sample_files: bool = False, use_cache: bool = True, progress: Callable[[dict], None] | None = None,
) -> dict:
    """Generate, write and validate a data set; returns its summary, which is also written.

    Provider and model that aren't given are those of the session (glyphmill.content.provider and .model), if it has any.
    """
    content_provider = content_provider or spark.conf.get("glyphmill.content.provider", "fallback")
    content_model = content_model or spark.conf.get("glyphmill.content.model", None)
    if content_provider not in PROVIDERS:
        raise ValueError(f"content provider must be one of {', '.join(PROVIDERS)}")
    if game_renderer not in RENDERERS:
        raise ValueError(f"game renderer must be one of {', '.join(RENDERERS)}")
    out = _located(output_dir)
    tell = progress or (lambda event: None)
    fs, root = _path(spark, out)
    if clean and fs.exists(root):
        fs.delete(root, True)
    kept, cache = f"{out}/cache/content", None
    if use_cache and fs.exists(_path(spark, kept)[1]):
        cache = spark.read.schema(content.PAYLOAD).parquet(kept)
    records, payload = generate_records(spark, count, seed, augment=augment, difficulty=difficulty, blocks_per_sample=blocks_per_sample, content_provider=content_provider, content_model=content_model, fetch=fetch, cache=cache)
    if use_cache:
        new = payload if cache is None else payload.join(cache.select("cache_key"), "cache_key", "left_anti").select(*content.PAYLOAD.names)
        new.select(*content.PAYLOAD.names).write.mode("append").parquet(kept)
    records = records.repartitionByRange(F.substring_index("id", "_", -1)).sortWithinPartitions(F.substring_index("id", "_", -1)).cache()
    try:
        for view in files.VIEWS:  # files of an earlier run would be taken for this one's
            if not sample_files and files.exists(spark, f"{out}/annotations/{view}"):
                fs.delete(_path(spark, f"{out}/annotations/{view}")[1], True)
        files.write_views(records, out)
        images.write_images(records, out)
        if sample_files:
            files.write_sample_files(records, out)
        tell({"phase": "generate", "completed": count, "total": count})
        language = records.select(F.explode("content").alias("x")).select("x.source_language")
        summary = {
            "requested_count": count, "seed": seed, "augment": augment, "use_llm": content_provider != "fallback", "content_provider": content_provider, "content_model": content_model or DEFAULT_MODELS.get(content_provider), "game_renderer": game_renderer,
            "blocks_per_sample": BLOCKS[difficulty] if blocks_per_sample is None else blocks_per_sample, "difficulty": difficulty,
            "category_counts": dataset.counts(records, F.col("category")), "renderer_counts": dataset.counts(records, F.coalesce("metadata.renderer", F.lit("unknown"))), "language_counts": dataset.counts(language, F.col("source_language")),
        }
    finally:
        records.unpersist()
    tell({"phase": "validate", "completed": count, "total": count})
    summary["validation"] = validate_dataset(spark, out)
    _put(spark, f"{out}/summary.json", json.dumps(summary, ensure_ascii=False, indent=2))
    tell({"phase": "done", "completed": count, "total": count, "validation_errors": summary["validation"]["error_count"]})
    return summary
