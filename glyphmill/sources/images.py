"""PNG pages: drawn from line boxes without an image library, and read by their headers."""

from __future__ import annotations

import struct
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def png(width: int, height: int, boxes: list, shade: int = 236) -> bytes:
    """A grey page with darker line boxes."""
    import numpy as np

    page = np.full((height, width + 1), shade, np.uint8)
    page[:, 0] = 0  # filter byte of each row
    for x1, y1, x2, y2 in boxes:
        page[y1:y2, x1 + 1 : x2 + 1] = 90
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(page.tobytes(), 6)) + chunk(b"IEND", b"")


def write_images(records: DataFrame, out: str) -> int:
    """images/ID.png of every canonical record; returns their number."""
    import pyarrow as pa
    import pyarrow.fs

    def put(batches):
        fs, root = pyarrow.fs.FileSystem.from_uri(out)
        fs.create_dir(f"{root}/images", recursive=True)
        for batch in batches:
            for r in batch.to_pylist():
                with fs.open_output_stream(f"{root}/{r['image_file']}") as f:
                    f.write(png(r["width"], r["height"], r["boxes"]))
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    boxes = F.transform("content", lambda x: x["bbox_2d"]).alias("boxes")
    return records.select("image_file", "width", "height", boxes).mapInArrow(put, "n bigint").agg(F.sum("n")).first()[0] or 0


def sizes(spark: SparkSession, folder: str) -> DataFrame:
    """name (images/FILE), width and height of each PNG, from its header."""
    number = lambda at: F.conv(F.hex(F.substring("content", at, 4)), 16, 10).cast("int")
    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").option("pathGlobFilter", "*.png").load(folder)
    return files.select(F.concat(F.lit("images/"), F.element_at(F.split("path", "/"), -1)).alias("name"), number(17).alias("width"), number(21).alias("height"))
