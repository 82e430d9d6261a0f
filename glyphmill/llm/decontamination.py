"""Benchmark decontamination with an FM-index per training shard.

A shard is a run of documents of about SHARD_BYTES of text, inside the task that reads it. Its words become symbols:
words that no benchmark item has are 0. An occurrence of a phrase can only lie in a run of words whose neighbours are
all neighbours somewhere in the benchmark; only such runs, if long enough for the shortest phrase, are indexed, which
loses no occurrence. Over them come a suffix array by prefix doubling, the Burrows-Wheeler transform in a wavelet
matrix, and suffix positions sampled at every SAMPLE-th place and at the start of each run. All phrases (windows of
WINDOW words of an item; a shorter item is one phrase) are searched backward together; occurrences are located by
steps of the LF mapping to a sampled place; hit words are merged to removal spans. Texts are never shuffled.

The phrases go to the executors in blocks of about BLOCK_BYTES of item text, AT_ONCE blocks in one pass over the
documents, so memory doesn't grow with the benchmark.

Defined cases: null and empty texts have no words; items without words have no phrase; several items may share a
phrase, and all are named; items of null item_id count as one, without a name; repeated rows get equal results; an empty benchmark contaminates nothing; extra columns
are kept by removed.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, expand, lists, materialise, packed, slices, text_bytes, trimmed, word_hashes, words_of

WINDOW = 10
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 4 << 20
#: Blocks that are searched in one pass over the documents; what is found is then written, and the next ones follow.
AT_ONCE = 4
SAMPLE = 8


def hashed_words(texts: pa.Array):
    """Hash, start, end, text number of all words, and the bounds of the texts."""
    data, offsets = text_bytes(texts)
    start, end, doc = words_of(data, offsets)
    return word_hashes(LOWER[data], start, end), start, end, doc, offsets


class Phrases:
    """The phrases of a block of items."""

    def __init__(self, ids: pa.Array, texts: pa.Array, window: int = WINDOW):
        hashes, _, _, item, _ = hashed_words(texts)
        self.vocabulary, symbol = np.unique(hashes, return_inverse=True)
        symbol = symbol.astype(np.int64) + 1
        self.names = np.array(ids.cast(pa.string()).to_pylist(), object)
        n = np.bincount(item, minlength=len(ids))
        first = np.cumsum(n) - n
        count = np.where(n >= window, n - window + 1, np.minimum(n, 1))
        start, of, size = expand(first, count), np.repeat(np.arange(len(ids)), count), np.repeat(np.minimum(n, window), count)
        table = np.zeros((len(start), window), np.int32)  # a phrase's symbols, last one in the last column
        for k in range(window):
            there = size > k
            table[there, window - 1 - k] = symbol[start[there] + size[there] - 1 - k]
        self.table, phrase = np.unique(table, axis=0, return_inverse=True) if len(table) else (table, np.zeros(0, np.int64))
        self.size = (self.table > 0).sum(1)
        pairs = np.unique(np.stack((phrase.ravel(), of), 1), axis=0) if len(of) else np.zeros((0, 2), np.int64)
        self.item, self.item_bounds = pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(self.table) + 1))
        same = item[1:] == item[:-1]
        self.neighbours = np.unique(symbol[:-1][same] * (len(self.vocabulary) + 1) + symbol[1:][same])
        self.shortest = int(self.size.min()) if len(self.size) else 0

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes of text, by prefix doubling; each 0 is smaller than all else and than any later 0."""
    n = len(text)
    zero = text == 0
    key = text.astype(np.int64) + n
    key[zero] = np.arange(int(zero.sum()))
    _, rank = np.unique(key, return_inverse=True)
    step = 1
    while True:
        ahead = np.full(n, -1, np.int64)
        ahead[: n - step] = rank[step:] if step < n else 0
        combined = rank * (n + 1) + ahead + 1
        names, rank = np.unique(combined, return_inverse=True)
        if len(names) == n:
            return np.argsort(rank)
        step *= 2


class Wavelet:
    """Wavelet matrix of a symbol sequence: ranks of any symbols at any places, all at once."""

    def __init__(self, sequence: np.ndarray, top: int):
        self.levels = max(1, int(top).bit_length())
        self.ones, self.zeros = [], []
        for level in range(self.levels - 1, -1, -1):
            bit = (sequence >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit))))
            self.zeros.append(len(bit) - int(bit.sum()))
            sequence = np.concatenate((sequence[bit == 0], sequence[bit == 1]))

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        low, high = np.zeros(len(symbol), np.int64), place.astype(np.int64)
        for k in range(self.levels):
            bit = (symbol >> (self.levels - 1 - k)) & 1
            ones, zeros = self.ones[k], self.zeros[k]
            low = np.where(bit == 1, zeros + ones[low], low - ones[low])
            high = np.where(bit == 1, zeros + ones[high], high - ones[high])
        return high - low


class FMIndex:
    def __init__(self, text: np.ndarray, run_starts: np.ndarray):
        """text: symbols from 1, runs ended by 0."""
        order = suffix_array(text)
        self.last = text[order - 1]  # text ends with 0, so the first suffix's predecessor is a 0 too
        self.wavelet = Wavelet(self.last, int(text.max()))
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text))))
        sampled = np.arange(len(text)) % SAMPLE == 0
        sampled[run_starts] = True
        self.sampled = sampled[order]
        self.sample_at = np.cumsum(self.sampled) - 1
        self.samples = order[self.sampled]
        self.n = len(text)

    def search(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each phrase (symbols, right-aligned, 0 before its start) the rows [low, high) of its suffixes."""
        low, high = np.zeros(len(table), np.int64), np.full(len(table), self.n, np.int64)
        known = len(self.before) - 1
        for k in range(table.shape[1] - 1, -1, -1):
            c = table[:, k].astype(np.int64)
            high[c >= known] = low[c >= known]
            go = np.flatnonzero((c > 0) & (high > low))
            s = c[go]
            both = self.wavelet.rank(np.concatenate((s, s)), np.concatenate((low[go], high[go])))
            low[go], high[go] = self.before[s] + both[: len(go)], self.before[s] + both[len(go) :]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        while len(walk := np.flatnonzero(~self.sampled[rows])):
            symbol = self.last[rows[walk]]
            rows[walk] = self.before[symbol] + self.wavelet.rank(symbol, rows[walk])
            steps[walk] += 1
        return self.samples[self.sample_at[rows]] + steps


def occurrences(hashes: np.ndarray, doc: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """First word and phrase number of every occurrence."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(phrases.table) or not len(hashes):
        return none
    symbol = phrases.symbols(hashes)
    linked = np.zeros(len(symbol) + 1, bool)  # word i follows word i - 1 in some item
    pair = symbol[:-1] * (len(phrases.vocabulary) + 1) + symbol[1:]
    able = np.flatnonzero((symbol[:-1] > 0) & (symbol[1:] > 0) & (doc[1:] == doc[:-1]))
    if len(phrases.neighbours) and len(able):
        at = np.minimum(np.searchsorted(phrases.neighbours, pair[able]), len(phrases.neighbours) - 1)
        linked[able[phrases.neighbours[at] == pair[able]] + 1] = True
    first = np.flatnonzero((symbol > 0) & ~linked[:-1])
    ends = np.flatnonzero((symbol > 0) & ~linked[1:]) + 1
    long = ends - first >= phrases.shortest
    first, length = first[long], (ends - first)[long]
    if not len(first):
        return none
    source = expand(first, length)
    at = np.cumsum(length + 1) - (length + 1)  # of each run in the indexed text
    text, word = np.zeros(int((length + 1).sum()), np.int64), np.full(int((length + 1).sum()), -1, np.int64)
    where = expand(at, length)
    text[where], word[where] = symbol[source], source
    index = FMIndex(text, at)
    low, high = index.search(phrases.table)
    found = np.flatnonzero(high > low)
    rows = expand(low[found], (high - low)[found])
    return word[index.locate(rows)], np.repeat(found, (high - low)[found])


def _scan(part: pa.RecordBatch, phrases: Phrases) -> pa.RecordBatch:
    """Adds what one block of phrases finds. Columns: row, text, n_words, hits (word ranges), items."""
    n = part.num_rows
    hashes, start, end, doc, offsets = hashed_words(part.column("text"))
    words = np.bincount(doc, minlength=n)
    first = np.cumsum(words) - words
    place, phrase = occurrences(hashes, doc, phrases)
    mark = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(mark, place, 1)
    np.add.at(mark, place + phrases.size[phrase] if len(place) else place, -1)
    earlier = part.column("hits")
    if len(earlier.flatten()):  # what earlier blocks have found
        owner = np.repeat(np.arange(n), np.diff(earlier.offsets.to_numpy()))
        flat = earlier.flatten()
        np.add.at(mark, flat.field("w0").to_numpy() + first[owner], 1)
        np.add.at(mark, flat.field("w1").to_numpy() + first[owner], -1)
    hit = np.cumsum(mark[:-1]) > 0
    own = np.concatenate(([True], doc[1:] != doc[:-1]))[: len(doc)]
    begins = np.flatnonzero(hit & (own | ~np.concatenate(([False], hit[:-1]))[: len(hit)]))
    ends = np.flatnonzero(hit & (np.concatenate((own[1:], [True]))[: len(hit)] | ~np.concatenate((hit[1:], [False]))[: len(hit)])) + 1
    owner = doc[begins]
    spans = pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in (begins - first[owner], ends - first[owner], start[begins] - offsets[owner], end[ends - 1] - offsets[owner])], ["w0", "w1", "b0", "b1"])
    bounds = phrases.item_bounds
    count = bounds[phrase + 1] - bounds[phrase]
    pairs = np.unique(np.stack((np.repeat(doc[place], count), phrases.item[expand(bounds[phrase], count)]), 1), axis=0) if len(place) else np.zeros((0, 2), np.int64)
    names = [[] for _ in range(n)] if len(part.column("items").flatten()) == 0 else part.column("items").to_pylist()
    for d, i in pairs.tolist():
        names[d] = names[d] + [phrases.names[i]]
    return pa.RecordBatch.from_arrays([part.column("row"), part.column("text"), pa.array(words.astype(np.int64)), lists(spans, owner, n), pa.array(names, pa.list_(pa.string()))], ["row", "text", "n_words", "hits", "items"])


HITS = "array<struct<w0: bigint, w1: bigint, b0: bigint, b1: bigint>>"


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """row (all columns), text, n_words, hits (merged ranges of words and of UTF-8 bytes) and items of each document."""
    items = benchmark.select(F.col("item_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    total = items.select(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_BYTES))
    out = packed(docs).select("row", F.col("row.text").alias("text"), F.lit(0).cast("bigint").alias("n_words"), F.array().cast(HITS).alias("hits"), F.array().cast("array<string>").alias("items"))
    for k in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).toArrow()
        column = lambda name: pa.concat_arrays(block[name].chunks) if block[name].num_chunks else pa.array([], block[name].type)
        sent = docs.sparkSession.sparkContext.broadcast(Phrases(column("item_id"), column("text"), window))

        def run(batches, sent=sent):
            for batch in batches:
                for part in slices(batch, 1, SHARD_BYTES):
                    yield _scan(part, sent.value)

        out = out.mapInArrow(trimmed(run), out.schema)
        if k % AT_ONCE == AT_ONCE - 1 and k + 1 < blocks:
            out = materialise(out)
    return out


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    found = contamination(docs.select("doc_id", "text"), benchmark, window)
    hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda a, s: a + s["w1"] - s["w0"])
    items = F.array_sort(F.array_distinct("items"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", hit.alias("n_hit"), F.size(items).cast("bigint").alias("n_items"), F.sha2(F.concat_ws(",", items).cast("binary"), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


def removed(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs with the removal spans cut out of their texts (n_chars follows where there is one); other texts are untouched."""
    found = contamination(docs, benchmark, window)
    raw = F.col("text").cast("binary")
    size = F.octet_length("text")
    # The pieces between spans: before the first, between neighbours, after the last.
    starts = F.concat(F.array(F.lit(0).cast("bigint")), F.transform("hits", lambda s: s["b1"]))
    ends = F.concat(F.transform("hits", lambda s: s["b0"]), F.array(size.cast("bigint")))
    pieces = F.zip_with(starts, ends, lambda a, b: F.substring(raw, (a + 1).cast("int"), (b - a).cast("int")).cast("string"))
    text = F.when(F.size("hits") > 0, F.array_join(pieces, "")).otherwise(F.col("text"))
    out = found.withColumn("text", text)
    changed = {"text": F.col("text")} | ({"n_chars": F.when(F.size("hits") > 0, F.length("text").cast("bigint")).otherwise(F.col("row.n_chars"))} if "n_chars" in docs.columns else {})
    return out.select(*[(changed[c] if c in changed else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
