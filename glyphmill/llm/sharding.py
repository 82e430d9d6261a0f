"""Sharding by a two-pass external shuffle.

First pass: every record goes to a shard by a consistent hash of its doc_id, and uniformly to one of that shard's
buckets by another seeded hash; there are as many buckets as keep each under BUCKET_BYTES, so a bucket fits in a
task's memory however large the data are. Second pass: each bucket is put in a fixed order, shuffled by Fisher-Yates
under a seed of its own and written. A record's slot is the place of its bucket in the shard plus its place in it.

The law is `key`: doc_id and the number of shards alone decide the shard (jump hash), so one more shard takes rows
only into itself.

Defined cases: a null text has no bytes; null doc_ids share a key; repeated rows follow each other's slots in any
order, being equal; an empty table gives no shard files; extra columns are written with their rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, packed, shared_dir

SHARDS = 24
SEED = 11
BUCKET_BYTES = 16 << 20
#: Rows of the table of buckets that may be broadcast (20 bytes each).
BROADCAST_ROWS = 100_000


def key_hash(doc_id: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null")))


def shard_of(doc_id: Column, shards: int, seed: int = SEED) -> Column:
    """Consistent shard of a key: with n shards, shard n - 1 wins from the others with probability 1 / n.

    Step by step over n = 1 .. shards the key keeps its shard or moves to the newest, by an own draw for each n.
    """
    shard = F.lit(0)
    for n in range(2, shards + 1):
        shard = F.when(F.pmod(key_hash(doc_id, seed + 7919 * n), F.lit(n)) == 0, F.lit(n - 1)).otherwise(shard)
    return shard.cast("int")


def record_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("bigint")


def shuffled(seed: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard, bucket = (int(x.as_py()) for x in key)
        # A bucket's rows come in any order; doc_id and checksum fix one before the shuffle.
        table = table.sort_by([("doc_id", "ascending"), ("crc", "ascending")])
        order = np.arange(table.num_rows)
        random = np.random.Generator(np.random.PCG64([seed, shard, bucket]))
        for_swap = random.integers(0, np.arange(table.num_rows, 0, -1)) if table.num_rows else order
        for i, j in enumerate(for_swap.tolist()):  # Fisher-Yates
            order[i], order[i + j] = order[i + j], order[i]
        table = table.take(pa.array(order))
        return table.append_column("place", pa.array(np.arange(table.num_rows, dtype=np.int64)))

    return run


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> T.StructType:
    """Write docs to path/shard=K/bucket=B/*.parquet, each bucket in its shuffled order (column place); the files' schema."""
    text = F.col("row.text")
    rows = packed(docs).select("row", F.col("row.doc_id").alias("doc_id"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc"))
    total = docs.select(F.sum(record_size(docs["text"])).alias("b")).first()["b"] or 0
    per_shard = max(1, math.ceil(total / shards / BUCKET_BYTES))
    rows = rows.withColumns({"shard": shard_of(F.col("doc_id"), shards, seed), "bucket": F.pmod(F.xxhash64(F.lit(seed), "doc_id", "crc"), F.lit(per_shard)).cast("int")})
    out = T.StructType([*rows.schema.fields, T.StructField("place", T.LongType())])
    # The one shuffle of whole rows; a bucket is some BUCKET_BYTES.
    rows.groupBy("shard", "bucket").applyInArrow(shuffled(seed), out).write.partitionBy("shard", "bucket").parquet(path)
    return out


def read_shards(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The written records with their shard and gapless slot: row, doc_id, crc, shard, slot."""
    files = spark.read.schema(schema).parquet(path)
    counts = materialise(files.groupBy("shard", "bucket").agg(F.count("*").alias("rows")))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).cast("bigint").alias("offset"))
    if counts.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    return files.join(offsets, ["shard", "bucket"]).withColumn("slot", F.col("offset") + F.col("place")).drop("place", "offset")


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Write the shards in the shared folder and return what the files hold."""
    path = shared_dir(docs.sparkSession)
    schema = write_shards(docs, path, shards, seed)
    return read_shards(docs.sparkSession, path, schema)
