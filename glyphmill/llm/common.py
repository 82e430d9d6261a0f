"""Shared storage and byte-level helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import hashlib
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts are handled in slices of about so many bytes, which bounds a Python worker's memory.
SLICE_BYTES = 2 << 20


def shared_dir(spark: SparkSession) -> str:
    """A new folder name below spark.checkpoint.dir, which the driver and all executors see.

    Where no checkpoint folder is set, a temporary one serves a local session; on a cluster that is an error, since
    executors can't see a folder of the driver's machine.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not base:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="glyphmill-"))
        base = sc.getCheckpointDir()
    return f"{base.rstrip('/')}/glyphmill-{uuid.uuid4().hex}"


#: Spark then drops a query's shuffle files at its end, without waiting for the driver's garbage collection.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, made: list[str] | None = None) -> DataFrame:
    """df written as Parquet in the shared folder and read again: cuts the lineage and survives lost executors. The
    shuffle files of the write go as soon as it is done.

    made: gets the folder's name, for discard once nothing reads it any more."""
    path, conf = shared_dir(df.sparkSession), df.sparkSession.conf
    before = conf.get(_CLEAN, None)
    conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(_CLEAN) if before is None else conf.set(_CLEAN, before)
    if made is not None:
        made.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, made: list[str]) -> None:
    """Remove folders of intermediate tables."""
    while made:
        delete(spark, made.pop())


def trim() -> None:
    """Give a Python worker's free memory back to the system; workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except OSError:  # another C library
        pass


def trimmed(run):
    """run (batches -> batches) that gives its memory back at the end of a task."""

    def outer(batches):
        try:
            yield from run(batches)
        finally:
            trim()

    return outer


def hot_join(left: DataFrame, right: DataFrame, key: str, share: int = 1000) -> DataFrame:
    """Inner join of left with right (one row a key; column n_left: rows of left with that key) that no key can skew.

    Keys with more than 1 / share of all rows of left are fewer than share, so their rows of right are broadcast; the
    others meet by a shuffle. right is read more than once and should be a written table."""
    total = right.agg(F.sum("n_left")).first()[0] or 0
    limit = max(100, total // share)
    hot = F.broadcast(right.filter(F.col("n_left") > limit).drop("n_left"))
    cold = right.filter(F.col("n_left") <= limit).drop("n_left")
    names = hot.select(key)
    return left.join(F.broadcast(names), key, "left_anti").join(cold, key).unionByName(left.join(hot, key))


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of plans that are no longer referenced (their results are written)."""
    gc.collect()
    spark._jvm.System.gc()


def make_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder through the file system that owns it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def packed(docs: DataFrame, row: str = "row") -> DataFrame:
    """All columns of docs in one struct, so that names of helper columns can't clash with them."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias(row))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; nulls are empty. No Python object is made for a row."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: int, limit: int = SLICE_BYTES):
    """The batch in pieces of whole rows of about limit bytes of text (a longer text is a piece of its own)."""
    _, offsets = text_bytes(batch.column(text))
    start, n = 0, batch.num_rows
    while start < n:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1)
        yield batch.slice(start, min(end, n) - start)
        start = min(end, n)


_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    have = _POWERS.get("p")
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        base = 0x5851F42D4C957F2D
        inverse = pow(base, -1, 1 << 64)
        for name, b in (("p", base), ("i", inverse)):
            full = np.full(size, b, dtype=np.uint64)
            full[0] = 1
            _POWERS[name] = np.cumprod(full, dtype=np.uint64)
    return _POWERS["p"], _POWERS["i"]


class RangeHash:
    """64-bit hashes of any byte ranges of one buffer, equal for equal bytes wherever they stand."""

    def __init__(self, data: np.ndarray):
        power, _ = _powers(len(data) + 1)
        self.sums = np.empty(len(data) + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        _, inverse = _powers(len(self.sums))
        raw = (self.sums[end] - self.sums[start]) * inverse[start]
        return mix64(raw ^ ((end - start).astype(np.uint64) * _ODD))


_LOW_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
#: Bytes of a word beyond which its hash is taken from a digest of the whole.
_LONG_WORD = 256


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges (words): eight bytes at a time, each step a mix of all bits, so that no pattern of
    repeats collides as it would in a polynomial. The same bytes give the same hash wherever they stand."""
    size = end - start
    eight = np.ndarray((len(data) + 1,), "<u8", np.concatenate((data, np.zeros(8, np.uint8))), strides=(1,))
    out = mix64(size.astype(np.uint64) * _ODD + np.uint64(0x632BE59BD9B4E019))
    live, done = np.flatnonzero(size <= _LONG_WORD), 0
    while len(live):
        left = size[live] - done
        out[live] = mix64((out[live] ^ (eight[start[live] + done] & _LOW_BYTES[np.minimum(left, 8)])) * _ODD)
        live = live[left > 8]
        done += 8
    for k in np.flatnonzero(size > _LONG_WORD).tolist():
        out[k] = int.from_bytes(hashlib.blake2b(data[start[k] : end[k]].tobytes(), digest_size=8).digest(), "little")
    return out


def expand(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... for length[0] values, then the same for the next, as one array."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(length) - length
    return np.arange(total, dtype=np.int64) + np.repeat(start.astype(np.int64) - first, length)


def merged_spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans, touching ones joined, in order."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    first = np.concatenate(([True], start[1:] > end[:-1]))
    last = np.concatenate((first[1:], [True]))
    return start[first], end[last]


#: Word bytes of the lower-cased class [^\x00-\x2F\x3A-\x60\x7B-\x7F]: digits, ASCII letters, all of other scripts.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
#: Word bytes of [^\x20\x09-\x0D].
NON_SPACE = np.ones(256, bool)
NON_SPACE[[32, 9, 10, 11, 12, 13]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words_of(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = ALNUM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, end and text number of every word (run of bytes of the kind) of texts laid end to end."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = kind[data]
    step = np.diff(inside)
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    # A run that goes on over the end of a text is cut there.
    cuts = offsets[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < len(data))])
    cuts = cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)]
    if len(cuts):
        start, end = np.sort(np.concatenate((start, cuts))), np.sort(np.concatenate((end, cuts)))
    return start, end, np.searchsorted(offsets, start, "right") - 1


def lists(values: pa.Array, owner: np.ndarray, n: int) -> pa.Array:
    """An Arrow list for each of n rows; owner (ascending): the row of each value."""
    bounds = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), values)
