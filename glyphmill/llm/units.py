"""Line and paragraph deduplication by digests: of all units that are equal after normalising, the earliest ranked stays.

Units tile a text, and no word is left out. A line of UNIT_WORDS words or more is cut after clauses (a word that ends
with one of .!?,;:, before white space) to units of at least UNIT_WORDS words, so that a passage inside a line meets its
copy inside another; a rest of fewer words stays with the unit before it. A shorter line is put together with what
follows it, to a paragraph of UNIT_WORDS words or more or up to the end of the text: lines of a few words are equal by
chance, and are removed only together with their neighbours. (On sf0.1 documents, with every line a unit of its own, 45 %
of the documents that share no passage of 51 words with another would lose something; so 37 % do, by lines of 8 words
or more that stand in hundreds of documents.)

A unit's normal form is its words in ASCII lower case with one space between; its digest is 128 bits of that. Units rank
by doc_id and place. Each task first keeps the earliest occurrence of every digest in a slice of documents, and remembers
those that repeat, so that a line that a third of all documents share sends about one entry a task; digests then meet in
buckets, whose answers go back to the documents as places. A removed unit that opens a line goes up to the next unit;
another goes with the white space before it. Offsets are those of the original text.

Defined cases: a null text is empty and has no units, as has white space; a null doc_id ranks last; rows of equal doc_id
rank by their text's hash, and rows equal in both, as one (repeated rows get equal results: an occurrence in a repeat
doesn't count); an empty table gives an empty result; extra columns are ignored. One text is held in memory as a whole.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, NON_SPACE, expand, merged_spans, slices, text_bytes, trimmed, words_of

UNIT_WORDS = 8
BUCKET_BYTES = 32 << 20
MIN_BUCKETS = 32
#: Digests that a task remembers.
KNOWN = 1 << 16
NO_ID = np.iinfo(np.int64).max
ROWS = "bucket int, doc_id bigint, key bigint, data binary"
_CLOSE = np.zeros(256, bool)
_CLOSE[list(b".!?,;:")] = True


class Units:
    """The units of some texts: text number, first and last word, and the byte range that goes if the unit is removed."""

    def __init__(self, texts: pa.Array, least: int = UNIT_WORDS):
        self.data, self.offsets = text_bytes(texts)
        self.start, self.end, word_doc = words_of(self.data, self.offsets, NON_SPACE)
        words = len(self.start)
        self.first = self.last = self.doc = np.zeros(0, np.int64)
        if not words:
            self.begin = self.stop = self.first
            return
        # Lines: a word opens one if its text begins or a line feed stands between it and the word before.
        feeds = np.concatenate(([0], np.cumsum(self.data == 10)))
        opens = np.ones(words, bool)
        opens[1:] = (word_doc[1:] != word_doc[:-1]) | (feeds[self.start[1:]] > feeds[self.end[:-1]])
        line = np.cumsum(opens) - 1
        line_end = np.append(np.flatnonzero(opens)[1:], words)[line]
        long = (line_end - np.flatnonzero(opens)[line]) >= least
        # Places where a unit may close: line ends, and ends of clauses of long lines that leave no short rest behind.
        place = np.arange(words) + 1
        rest = line_end - place
        may = np.flatnonzero((rest == 0) | (long & (rest >= least) & _CLOSE[self.data[self.end - 1]]))
        text_end = np.append(np.flatnonzero(word_doc[1:] != word_doc[:-1]) + 1, words)
        # A unit that opens with word i closes at the first such place with enough words, or with the text.
        to = np.minimum(np.searchsorted(may, np.arange(words) + least - 1), len(may) - 1)
        to = np.minimum(may[to] + 1, text_end[np.searchsorted(text_end, np.arange(words), "right")]).tolist()
        first, i = [], 0
        while i < words:
            first.append(i)
            i = to[i]
        self.first = np.array(first, np.int64)
        self.last = np.append(self.first[1:], words) - 1
        self.doc = word_doc[self.first]
        same = np.append(self.doc[1:] == self.doc[:-1], False)
        after = np.where(same, self.start[np.append(self.first[1:], 0)], self.offsets[self.doc + 1])
        opener = opens[self.first]
        self.begin = np.where(opener, self.start[self.first], self.end[self.first - 1])
        self.stop = np.where(opener, after, self.end[self.last])

    def digests(self) -> np.ndarray:
        """Two 64-bit numbers a unit."""
        size = self.end - self.start
        at = np.cumsum(size + 1) - (size + 1)
        plain = np.full(int((size + 1).sum()), 32, np.uint8)
        plain[expand(at, size)] = LOWER[self.data[expand(self.start, size)]]
        plain, made = memoryview(plain.tobytes()), hashlib.blake2b
        ends = (at + size)[self.last].tolist() if len(self.last) else []
        raw = b"".join([made(plain[a:b], digest_size=16).digest() for a, b in zip(at[self.first].tolist(), ends)])
        return np.frombuffer(raw, np.int64).reshape(-1, 2)


def _first(digest, ids, keys, place):
    """Order by digest and rank; the first in it of the same digest; and whether that is another unit."""
    order = np.lexsort((place, keys, ids, digest[:, 1], digest[:, 0]))
    new = np.concatenate(([True], (digest[order][1:] != digest[order][:-1]).any(1))) if len(order) else np.zeros(0, bool)
    head = order[np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else order
    same = (ids[order] == ids[head]) & (keys[order] == keys[head]) & (place[order] == place[head])
    return order, head, ~same


def _answers(out: list, bucket: int, ids, keys, place):
    order = np.lexsort((place, keys, ids))
    ids, keys, place = ids[order], keys[order], place[order]
    cut = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1]), [True]))) if len(ids) else []
    for i, j in zip(cut[:-1], cut[1:]):
        out.append((bucket, int(ids[i]), int(keys[i]), place[i:j].astype("<i8").tobytes()))


def _batch(out: list) -> pa.RecordBatch:
    columns = list(zip(*out)) or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.binary()))], ["bucket", "doc_id", "key", "data"])


def _entry(digest, doc, ids, keys, place) -> bytes:
    """Some units, in order of their documents, in few bytes."""
    docs, n = np.unique(doc, return_counts=True)
    return np.array([len(doc), len(docs)], "<i8").tobytes() + ids[docs].tobytes() + keys[docs].tobytes() + n.astype("<i8").tobytes() + place.astype("<i8").tobytes() + digest.tobytes()


def _entered(raw: bytes) -> list[np.ndarray]:
    m, d = np.frombuffer(raw, "<i8", 2).tolist()
    ids, keys, n, place, digest = np.split(np.frombuffer(raw, "<i8", -1, 16), np.cumsum([d, d, d, m]))
    return [digest.reshape(-1, 2), np.repeat(ids, n), np.repeat(keys, n), place]


def map_units(buckets: int, least: int):
    def run(batches):
        known: dict[tuple, tuple] = {}
        for batch in batches:
            for part in slices(batch, 2):
                ids, keys = np.array(part.column(0).cast(pa.int64()).fill_null(NO_ID)), np.array(part.column(1))
                units = Units(part.column(2), least)
                doc, place, digest = units.doc, units.begin - units.offsets[units.doc], units.digests()
                if not len(doc):
                    continue
                order, head, later = _first(digest, ids[doc], keys[doc], place)
                heads, times = np.unique(head, return_counts=True)
                sent_before = []
                for h, n, d in zip(heads.tolist(), times.tolist(), map(tuple, digest[heads].tolist())):
                    if n < 2 and d not in known:
                        continue
                    rank = (int(ids[doc[h]]), int(keys[doc[h]]), int(place[h]))
                    if d in known and known[d] < rank:  # an earlier slice of this task has sent an earlier one
                        sent_before.append(h)
                    elif d in known or len(known) < KNOWN:
                        known[d] = rank
                later |= np.isin(head, sent_before)
                out: list = []
                own = order[later]
                _answers(out, int(keys[0] % buckets), ids[doc[own]], keys[doc[own]], place[own])
                send = np.sort(order[~later])
                bucket = ((digest[send, 0] & 0x7FFFFFFF) % buckets).astype(np.int64)
                turn = np.argsort(bucket, kind="stable")
                send, bucket = send[turn], bucket[turn]
                cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True]))) if len(send) else []
                for i, j in zip(cut[:-1], cut[1:]):
                    s = send[i:j]
                    out.append((int(bucket[i]), None, None, _entry(digest[s], doc[s], ids, keys, place[s])))
                yield _batch(out)

    return run


def match_units(key: tuple, table: pa.Table) -> pa.Table:
    sent = pa.compute.is_null(table["doc_id"])
    raws = table.filter(sent)["data"].to_pylist()
    out: list = []
    if raws:
        digest, ids, keys, place = (np.concatenate(x) for x in zip(*map(_entered, raws)))
        order, _, later = _first(digest, ids, keys, place)
        own = order[later]
        _answers(out, key[0].as_py(), ids[own], keys[own], place[own])
    return pa.concat_tables([table.filter(pa.compute.invert(sent)), pa.Table.from_batches([_batch(out)])])


def cut_units(least: int):
    def run(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for part in slices(batch, 1):
                units = Units(part.column(1), least)
                bounds = np.searchsorted(units.doc, np.arange(part.num_rows + 1)).tolist()
                rows: list = [[], [], [], [], []]
                for d, raws in enumerate(part.column(2).to_pylist()):
                    at, to = int(units.offsets[d]), int(units.offsets[d + 1])
                    own = slice(bounds[d], bounds[d + 1])
                    gone = np.isin(units.begin[own] - at, np.concatenate([np.frombuffer(r, "<i8") for r in raws])) if raws else np.zeros(bounds[d + 1] - bounds[d], bool)
                    a, b = merged_spans(units.begin[own][gone] - at, units.stop[own][gone] - at)
                    keep = np.ones(to - at, bool)
                    keep[expand(a, b - a)] = False
                    text = units.data[at:to][keep].tobytes()
                    for c, v in zip(rows, (len(gone), int(gone.sum()), [{"start": x, "end": y} for x, y in zip(a.tolist(), b.tolist())], text.decode(), hashlib.sha256(text).hexdigest())):
                        c.append(v)
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int64(), kind, pa.string(), pa.string()))]], ["doc_id", "n_units", "n_removed", "spans", "text", "kept_sha256"])

    return run


def deduplicate(docs: DataFrame, least: int = UNIT_WORDS) -> DataFrame:
    """doc_id, n_units, n_removed, spans (UTF-8 byte ranges removed from the original text, merged), text (what is left)
    and its kept_sha256 of every document."""
    texts = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    total = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(MIN_BUCKETS, math.ceil(total / BUCKET_BYTES))
    answers = texts.mapInArrow(trimmed(map_units(buckets, least)), ROWS).groupBy("bucket").applyInArrow(match_units, ROWS)
    answers = answers.groupBy(F.col("doc_id").alias("a_id"), F.col("key").alias("a_key")).agg(F.collect_list("data").alias("data"))
    same = (F.coalesce("doc_id", F.lit(NO_ID)) == F.col("a_id")) & (F.col("key") == F.col("a_key"))
    return texts.join(answers, same, "left").select("doc_id", "text", "data").mapInArrow(trimmed(cut_units(least)), "doc_id bigint, n_units bigint, n_removed bigint, spans array<struct<start: bigint, end: bigint>>, text string, kept_sha256 string")
