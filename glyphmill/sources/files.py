"""JSON-lines views of a data set, written and read in parallel; per-sample files where they are wanted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import views as V

VIEWS = ("canonical", "vlm", "ocr", "trans")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def write_jsonl(rows: DataFrame, column: str, path: str, append: bool = False) -> None:
    """One JSON text a row. Part files follow each other in the order of rows."""
    rows.select(F.col(column).alias("value")).write.mode("append" if append else "overwrite").text(path)


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """record (JSON text) of every line that isn't blank, with ord, its place: file, split, line."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("line"))
    lines = spark.read.text(path).select("value", place.alias("ord"))
    return lines.filter(F.trim("value") != "").select(F.col("value").alias("record"), "ord")


def write_views(records: DataFrame, out: str, append: bool = False) -> None:
    """manifest, chat and the four views of canonical records (cached by the caller), each sorted by its one order."""
    named = lambda c: V.json(c)
    columns = {"manifest.jsonl": named(V.manifest()), "chat_vlm.jsonl": V.chat(), "annotations/vlm.jsonl": named(V.wrapped(V.vlm())), "annotations/ocr.jsonl": named(V.wrapped(V.ocr())), "annotations/trans.jsonl": named(V.wrapped(V.trans())), "annotations/canonical.jsonl": named(V.wrapped(V.canonical()))}
    for name, c in columns.items():
        write_jsonl(records.select(c.alias("value")), "value", f"{out}/{name}", append)


def write_sample_files(records: DataFrame, out: str) -> int:
    """annotations/VIEW/ID.json for each sample and view; meant for data sets that people browse. Returns the number written."""
    import pyarrow as pa
    import pyarrow.fs

    bodies = records.select("id", V.json(V.canonical()).alias("canonical"), V.json(V.vlm()).alias("vlm"), V.json(V.ocr()).alias("ocr"), V.json(V.trans()).alias("trans"))

    def put(batches):
        import json

        fs, root = pyarrow.fs.FileSystem.from_uri(out)
        for batch in batches:
            for row in batch.to_pylist():
                for view in VIEWS:
                    fs.create_dir(f"{root}/annotations/{view}", recursive=True)
                    with fs.open_output_stream(f"{root}/annotations/{view}/{row['id']}.json") as f:
                        f.write(json.dumps(json.loads(row[view]), ensure_ascii=False, indent=2).encode())
            yield pa.RecordBatch.from_pydict({"n": [len(VIEWS) * batch.num_rows]})

    return bodies.mapInArrow(put, "n bigint").agg(F.sum("n")).first()[0] or 0


def read_dataset(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(samples with all views as JSON text, chat) of a written data set, as operators.validate takes them.

    A view of a sample is the file that the manifest's paths name, else its line in annotations/VIEW.jsonl; with neither
    it is null, which the checks report.
    """
    from .images import sizes

    m = read_jsonl(spark, f"{path}/manifest.jsonl").withColumn("v", F.parse_json("record"))  # a broken line fails, as it must
    get = lambda n, kind="string": F.try_variant_get("v", f"$.{n}", kind).alias(n)
    for view in VIEWS:
        name = F.coalesce(F.try_variant_get("v", f"$.paths.{view}", "string"), F.concat(F.lit(f"annotations/{view}/"), get("id"), F.lit(".json")))
        m = m.withColumn(f"{view}_path", name)
    manifest = m.select(F.col("ord").alias("sample_ord"), get("id"), get("category"), get("image"), F.coalesce(F.try_variant_get("v", "$.renderer", "string"), F.lit("None")).alias("renderer"), *[f"{view}_path" for view in VIEWS])
    for view in VIEWS:
        manifest = manifest.withColumn(view, F.lit(None).cast("string"))
        if exists(spark, f"{path}/annotations/{view}"):
            whole = spark.read.text(f"{path}/annotations/{view}", wholetext=True, pathGlobFilter="*.json")
            whole = whole.select(F.substring_index(F.col("_metadata.file_path"), "/", -3).alias(f"{view}_path"), F.col("value").alias("body"))
            manifest = manifest.join(whole, f"{view}_path", "left").withColumn(view, F.col("body")).drop("body")
        manifest = manifest.drop(f"{view}_path")
        if not exists(spark, f"{path}/annotations/{view}.jsonl"):
            continue
        # `output` is kept as it stands in the text, so that 10 and 10.0 stay apart.
        rows = read_jsonl(spark, f"{path}/annotations/{view}.jsonl").withColumn("v", F.parse_json("record"))
        lines = rows.select(F.try_variant_get("v", "$.id", "string").alias("id"), F.regexp_extract("record", r'(?s)"output"\s*:\s*(.*)\}\s*$', 1).alias("body"))
        manifest = manifest.join(lines, "id", "left").withColumn(view, F.coalesce(view, "body")).drop("body")
    found = manifest.join(sizes(spark, f"{path}/images").withColumnRenamed("name", "image"), "image", "left")
    return found, read_jsonl(spark, f"{path}/chat_vlm.jsonl").select(F.col("ord").alias("chat_ord"), "record")
