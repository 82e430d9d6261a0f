"""Exact substring removal: every byte covered by a MATCH-byte string that also starts in a document of smaller doc_id.

Sorting every suffix of the corpus is not affordable at scale, and most suffixes share nothing; so suffixes are first
narrowed down without loss, then put in order by deep-shallow sorting.

1. Anchors. Every MATCH-byte string holds a GRAM-byte string of smallest hash among those in it (its minimizer), and
   equal strings hold equal ones at equal places. Each document gives its minimizers, with a hash of their context:
   all bytes of the MATCH-byte strings that have this minimizer. Within a task, an anchor whose whole context a smaller
   document of the same slice has too is settled at once, so a passage that a third of all documents share sends one
   entry a slice, not one a document.
2. Buckets of anchor hashes. Equal contexts are settled: all but the smallest document lose theirs. Only where equal
   anchors stand in different contexts (at the borders of shared passages) texts must be looked at.
3. Those contexts are fetched, and the suffixes at all their possible string starts are sorted: multikey quicksort on
   eight-byte words to a shallow depth, then a blind trie for each group that still shares its prefix. Neighbours
   equal over MATCH bytes are one string; its occurrences above the smallest document are removed. Anchors with very
   many contexts (a very common line) are spread over buckets by whole strings instead, with smallest documents taken
   within each task first.

Defined cases: a null text is empty; a null doc_id is larger than any other; rows of equal doc_id don't remove from
each other; repeated rows get equal results; texts under MATCH bytes lose nothing; extra columns are ignored. Hashes
are 64 bits, kept to 45 for anchors and 40 for contexts of equal anchors; step 3 compares bytes.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import RangeHash, expand, materialise, merged_spans, mix64, release, slices, text_bytes

MATCH = 50
GRAM = 20
REACH = MATCH - GRAM
#: Text behind one bucket of anchors; its entries take about as much memory.
BUCKET_BYTES = 16 << 20
#: Text that a task handles at once.
SLICE = 1 << 20
#: Buckets of contexts for each bucket of anchors.
SPREAD = 8
#: Contexts of one anchor beyond which whole strings are spread.
HOT = 1000
SHALLOW_WORDS = 4
#: Bits kept of anchor hashes (with at least MIN_BUCKETS buckets, 5 bytes hold the quotient) and of context hashes.
H_BITS, C_BITS, MIN_BUCKETS = np.uint64((1 << 45) - 1), np.uint64((1 << 40) - 1), 32
NO_ID = np.iinfo(np.int64).max

ROWS = "bucket int, kind int, doc_id bigint, key int, data binary"
SPANS, CONTEXTS, STRINGS, ENTRIES = 0, 1, 2, 3


def _slide(x: np.ndarray, width: int, op) -> np.ndarray:
    """op over x[i : i + width] for every i with room; by doubling."""
    done = 1
    while done * 2 <= width:
        x = op(x[:-done], x[done:])
        done *= 2
    return op(x[: len(x) - (width - done)], x[width - done :]) if width > done else x


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple:
    """Of every minimizer: text number, hash, hash of its context, first string start, number of starts, and a byte each
    for the REACH / 2 bytes before and after it (0: the text has none there).

    The context is all bytes of the strings that have this minimizer."""
    none = (np.zeros(0, np.int64),) + (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint8),) * 2
    n = len(data)
    if n < MATCH:
        return none
    hashes = RangeHash(data)
    place = np.arange(n - GRAM + 1)
    h = hashes(place, place + GRAM) | np.uint64(1)
    low = _slide(h, REACH + 1, np.minimum)  # for each string start
    # Strings that cross the end of a text are none.
    valid = np.ones(len(low), bool)
    ends = offsets[1:-1]
    valid[(x := expand(np.maximum(ends - MATCH + 1, 0), ends - np.maximum(ends - MATCH + 1, 0)))[x < len(low)]] = False
    low[~valid] = 0
    around = np.concatenate((np.zeros(REACH, np.uint64), low, np.zeros(REACH, np.uint64)))
    at = np.flatnonzero(_slide(around, REACH + 1, np.maximum) == h)
    doc = np.searchsorted(offsets, at, "right") - 1
    # The string starts that have their minimizer here are neighbours: the last one is `back` before it.
    own, back, count = h[at], np.full(len(at), -1, np.int64), np.zeros(len(at), np.int64)
    for j in range(REACH + 1):
        good = around[at + REACH - j] == own
        back[good & (count == 0)] = j
        count += good
    a = at - back - count + 1
    context = mix64(hashes(a, at - back + MATCH) ^ ((at - a).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019)))
    near = np.zeros((2, len(at)), np.uint8)
    for side, (b, e) in enumerate(((at - REACH // 2, at), (at + GRAM, at + GRAM + REACH // 2))):
        there = (b >= offsets[doc]) & (e <= offsets[doc + 1])
        near[side, there] = hashes(b[there], e[there]) % np.uint64(255) + np.uint64(1)
    return doc, mix64(own) & H_BITS, context & C_BITS, a, count, near[0], near[1]


def _five(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _unfive(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel().astype(np.uint64)


def _join(*parts: bytes) -> bytes:
    return np.array([len(parts), *map(len, parts)], np.int64).tobytes() + b"".join(parts)


def _split(raw: bytes) -> list[bytes]:
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    sizes, at, out = np.frombuffer(raw, np.int64, n, 8), 8 * (n + 1), []
    for s in sizes.tolist():
        out.append(raw[at : at + s])
        at += s
    return out


def _ids(column: pa.Array) -> np.ndarray:
    return np.array(column.cast(pa.int64()).fill_null(NO_ID))


class Rows:
    """Collects output rows (ROWS)."""

    def __init__(self):
        self.rows: list[tuple] = []

    def spans(self, bucket: int, ids: np.ndarray, keys: np.ndarray, owner: np.ndarray, start: np.ndarray, end: np.ndarray):
        """One row a document; owner indexes ids and keys."""
        order = np.lexsort((start, owner))
        owner, start, end = owner[order], start[order], end[order]
        cut = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1], [True])) if len(owner) else [])
        for i, j in zip(cut[:-1].tolist(), cut[1:].tolist()):
            s, e = merged_spans(start[i:j], end[i:j])
            self.rows.append((bucket, SPANS, int(ids[owner[i]]), int(keys[owner[i]]), np.stack((s, e)).astype("<i8" if e[-1] >= 1 << 31 else "<i4").tobytes() + (b"8" if e[-1] >= 1 << 31 else b"4")))

    def add(self, *row):
        self.rows.append(row)

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary()))], ["bucket", "kind", "doc_id", "key", "data"])


def spans_of(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw[:-1], "<i8" if raw[-1:] == b"8" else "<i4").reshape(2, -1).astype(np.int64)


def settle(h: np.ndarray, c: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (h, c, id), and for each place in it whether a smaller document has the same (h, c)."""
    order = np.lexsort((ids, c, h))
    new = np.concatenate(([True], (h[order][1:] != h[order][:-1]) | (c[order][1:] != c[order][:-1])))
    least = ids[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    return order, ids[order] > least


def map_anchors(buckets: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, 2, SLICE):
                out = Rows()
                ids, keys = _ids(part.column(0)), np.array(part.column(1))
                data, offsets = text_bytes(part.column(2))
                doc, h, c, a, count, left, right = anchors(data, offsets)
                if not len(a):
                    continue
                place = a - offsets[doc]
                order, more = settle(h, c, ids[doc])
                own = order[more]  # settled here
                out.spans(int(keys[0] % buckets), ids, keys, doc[own], place[own], place[own] + count[own] - 1 + MATCH)
                send = np.sort(order[~more])
                bucket = (h[send] % np.uint64(buckets)).astype(np.int64)
                send = send[np.argsort(bucket, kind="stable")]
                bucket = (h[send] % np.uint64(buckets)).astype(np.int64)
                cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
                for i, j in zip(cut[:-1].tolist(), cut[1:].tolist()):
                    s = send[i:j]
                    docs, n = np.unique(doc[s], return_counts=True)
                    step = np.diff(place[s], prepend=0)
                    wide = "<i2" if abs(step).max() < 1 << 15 else "<i8"
                    out.add(int(bucket[i]), ENTRIES, None, None, _join(_five(h[s] // np.uint64(buckets)), _five(c[s]), step.astype(wide).tobytes(), count[s].astype(np.uint8).tobytes(), left[s].tobytes(), right[s].tobytes(), np.diff(ids[docs], prepend=0).tobytes(), keys[docs].astype("<i4").tobytes(), n.astype("<u4").tobytes()))
                yield out.batch()

    return run


def _passed(table: pa.Table) -> tuple[pa.Table, list]:
    """Rows that a bucket only hands on, and the others as dicts."""
    kind = table["kind"].to_numpy()
    return table.filter(pa.array(kind == SPANS)), table.filter(pa.array(kind != SPANS)).to_pylist()


def match_anchors(key: tuple, table: pa.Table) -> pa.Table:
    """A bucket of anchors: spans of what is settled, and CONTEXTS or STRINGS rows for what needs the text."""
    through, rows = _passed(table)
    out = Rows()
    if rows:
        parts = [_split(r["data"]) for r in rows]
        h, c = (_unfive(b"".join(p[k] for p in parts)) for k in (0, 1))
        place = np.concatenate([np.cumsum(np.frombuffer(p[2], "<i2" if len(p[2]) == 2 * len(p[3]) else "<i8").astype(np.int64)) for p in parts])
        count = np.frombuffer(b"".join(p[3] for p in parts), np.uint8).astype(np.int64)
        near = [np.frombuffer(b"".join(p[k] for p in parts), np.uint8) for k in (4, 5)]
        ids = np.concatenate([np.cumsum(np.frombuffer(p[6], np.int64)) for p in parts])
        keys = np.frombuffer(b"".join(p[7] for p in parts), "<i4")
        doc = np.repeat(np.arange(len(ids)), np.frombuffer(b"".join(p[8] for p in parts), "<u4"))
        order, more = settle(h, c, ids[doc])
        bucket = int(rows[0]["bucket"])
        own = order[more]
        out.spans(bucket, ids, keys, doc[own], place[own], place[own] + count[own] - 1 + MATCH)
        left = order[~more]  # in order of (h, c): the smallest document's entries of each context
        hl, cl, il = h[left], c[left], ids[doc[left]]
        group = np.cumsum(np.concatenate(([True], hl[1:] != hl[:-1]))) - 1
        contexts = np.bincount(group, weights=np.concatenate(([1], (hl[1:] != hl[:-1]) | (cl[1:] != cl[:-1]))))
        # A string of two contexts holds the half reach before or after the anchor too; who has neither in common with
        # another document asks nothing.
        shares = np.zeros(len(left), bool)
        for side in near:
            cells, cell = np.unique(group.astype(np.int64) * 256 + side[left], return_inverse=True)
            low, high = np.full(len(cells), NO_ID), np.full(len(cells), -NO_ID)
            np.minimum.at(low, cell, il)
            np.maximum.at(high, cell, il)
            shares |= (low < high)[cell] & (side[left] > 0)
        many = contexts > HOT
        for kind, which in ((CONTEXTS, shares & ~many[group]), (STRINGS, shares & many[group])):
            ask = left[which]
            ask = ask[np.lexsort((place[ask], doc[ask]))]
            cut = np.flatnonzero(np.concatenate(([True], doc[ask][1:] != doc[ask][:-1], [True]))) if len(ask) else []
            for i, j in zip(cut[:-1], cut[1:]):
                out.add(bucket, kind, int(ids[doc[ask[i]]]), int(keys[doc[ask[i]]]), place[ask[i:j]].astype("<u4").tobytes() + count[ask[i:j]].astype("<u4").tobytes() + h[ask[i:j]].astype("<u4").tobytes())
    return pa.concat_tables([through, pa.Table.from_batches([out.batch()])])


def fetch(buckets: int):
    """Documents with their requests (ctx, str: arrays of binary) to rows of context bytes."""

    def requests(raws) -> np.ndarray:
        """First start, number of starts and anchor hash (its low bits) of each request, as three rows."""
        return np.concatenate([np.frombuffer(r, "<u4").reshape(3, -1) for r in raws or []] or [np.zeros((3, 0), "<u4")], 1).astype(np.int64)

    def run(batches):
        for batch in batches:
            for part in slices(batch, 2, SLICE):
                ids, keys = _ids(part.column(0)), np.array(part.column(1))
                data, offsets = text_bytes(part.column(2))
                out, asked, strings = Rows(), [], []
                for d in range(part.num_rows):
                    a, n, h = requests(part.column(3)[d].as_py())
                    if len(a):
                        asked.append((np.full(len(a), d), a, a + n - 1 + MATCH, h))
                    a, n, _ = requests(part.column(4)[d].as_py())
                    if len(a):
                        a, b = merged_spans(a, a + n)
                        strings.append((np.full(int((b - a).sum()), d), expand(a, b - a)))
                if asked:
                    doc, a, b, h = (np.concatenate(x) for x in zip(*asked))
                    _emit(out, data, offsets, ids, keys, doc, a, b, h % buckets)
                if strings:
                    doc, a = (np.concatenate(x) for x in zip(*strings))
                    at = offsets[doc] + a
                    h = RangeHash(data)(at, at + MATCH)
                    order, more = settle(h, h, ids[doc])
                    own, send = order[more], order[~more]
                    out.spans(int(keys[0] % buckets), ids, keys, doc[own], a[own], a[own] + MATCH)
                    _emit(out, data, offsets, ids, keys, doc[send], a[send], a[send] + MATCH, (h[send] % np.uint64(buckets)).astype(np.int64))
                if out.rows:
                    yield out.batch()

    return run


def _emit(out: Rows, data, offsets, ids, keys, doc, a, b, bucket):
    order = np.argsort(bucket, kind="stable")
    doc, a, b, bucket = doc[order], a[order], b[order], bucket[order]
    cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
    for i, j in zip(cut[:-1].tolist(), cut[1:].tolist()):
        s = slice(i, j)
        text = data[expand(offsets[doc[s]] + a[s], b[s] - a[s])]
        out.add(int(bucket[i]), CONTEXTS, None, None, _join(ids[doc[s]].tobytes(), keys[doc[s]].astype(np.int64).tobytes(), a[s].astype("<u4").tobytes(), (b - a)[s].astype("<u4").tobytes(), text.tobytes()))


class BlindTrie:
    """Orders strings of equal length that share a long prefix: inner nodes know only where and by which byte they part."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        self.root = 0  # a leaf is the number of its first string, an inner node [place, {byte: child}]
        self.equal: dict[int, list[int]] = {0: [0]}
        for i in range(1, len(texts)):
            self._insert(i)

    def _insert(self, i: int):
        t, texts = self.texts[i], self.texts
        node = self.root
        while type(node) is list:  # blind: bytes between the nodes aren't looked at
            branch = node[1]
            byte = t[node[0]]
            node = branch[byte] if byte in branch else next(iter(branch.values()))
        other = texts[node]
        if other == t:
            self.equal[node].append(i)
            return
        part = len(t) - (((int.from_bytes(other) ^ int.from_bytes(t)).bit_length() + 7) >> 3)
        self.equal[i] = [i]
        above, byte, node = None, 0, self.root
        while type(node) is list and node[0] < part:
            above, byte, node = node, t[node[0]], node[1].get(t[node[0]])
        if type(node) is list and node[0] == part:
            node[1][t[part]] = i
            return
        new = [part, {other[part]: node, t[part]: i}]
        if above is None:
            self.root = new
        else:
            above[1][byte] = new

    def ordered(self) -> list[list[int]]:
        """Groups of equal strings, in order."""
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if type(node) is list:
                stack.extend(node[1][b] for b in sorted(node[1], reverse=True))
            else:
                out.append(self.equal[node])
        return out


def deep_shallow(text: np.ndarray, starts: np.ndarray, depth: int = MATCH) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first depth bytes; for each place whether its string differs from the one before."""
    padded = np.concatenate((text, np.zeros(depth + 8, np.uint8)))
    words = np.zeros(len(padded) - 7, np.uint64)
    for j in range(8):
        words |= padded[j : len(padded) - 7 + j].astype(np.uint64) << np.uint64(56 - 8 * j)
    order = np.argsort(words[starts], kind="quicksort")
    key = words[starts[order]]
    new = np.concatenate(([True], key[1:] != key[:-1]))
    for level in range(1, SHALLOW_WORDS):  # shallow: words of the groups that are still together
        tied = np.flatnonzero(~new | ~np.concatenate((new[1:], [True])))
        if not len(tied):
            break
        group = np.cumsum(new)[tied]
        key = words[starts[order[tied]] + 8 * level]
        inner = np.lexsort((key, group))
        order[tied], key = order[tied][inner], key[inner]
        new[tied[1:]] |= key[1:] != key[:-1]
    # Deep: a blind trie for each group that isn't one and the same string.
    bounds, at = np.flatnonzero(np.concatenate((new, [True]))), 8 * SHALLOW_WORDS
    tied = np.flatnonzero(~new)
    unlike = np.zeros(len(tied), bool)
    for place in sorted({*range(at, depth - 8, 8), depth - 8}):
        unlike |= words[starts[order[tied]] + place] != words[starts[order[tied - 1]] + place]
    mixed = np.unique(np.searchsorted(bounds, tied[unlike], "right") - 1)
    raw = padded.tobytes()
    for i, j in zip(bounds[mixed].tolist(), bounds[mixed + 1].tolist()):
        if j - i > 1:
            members = order[i:j]
            groups = BlindTrie([raw[s + at : s + depth] for s in starts[members].tolist()]).ordered()
            order[i:j] = members[[k for g in groups for k in g]]
            new[i + np.cumsum([0] + [len(g) for g in groups[:-1]])] = True
    return order, new


def resolve(key: tuple, table: pa.Table) -> pa.Table:
    """A bucket of contexts: sort the suffixes at all string starts, and remove what a smaller document has too."""
    through, rows = _passed(table)
    out = Rows()
    if rows:
        parts = [_split(r["data"]) for r in rows]
        ids, keys = (np.frombuffer(b"".join(p[k] for p in parts), np.int64) for k in (0, 1))
        base, size = (np.frombuffer(b"".join(p[k] for p in parts), "<u4").astype(np.int64) for k in (2, 3))
        text = np.frombuffer(b"".join(p[4] for p in parts), np.uint8)
        at = np.cumsum(size) - size
        count = np.maximum(size - MATCH + 1, 0)
        owner = np.repeat(np.arange(len(ids)), count)
        starts = expand(at, count)
        if len(starts):
            order, new = deep_shallow(text, starts)
            who = ids[owner[order]]
            least = np.minimum.reduceat(who, np.flatnonzero(new))[np.cumsum(new) - 1]
            gone = order[who > least]
            begin = base[owner[gone]] + starts[gone] - at[owner[gone]]
            _, doc = np.unique(np.stack((ids, keys), 1), axis=0, return_inverse=True)
            names = np.unique(np.stack((ids, keys), 1), axis=0)
            out.spans(int(rows[0]["bucket"]), names[:, 0], names[:, 1], doc.ravel()[owner[gone]], begin, begin + MATCH)
    return pa.concat_tables([through, pa.Table.from_batches([out.batch()])])


def removal_spans(docs: DataFrame) -> DataFrame:
    """doc_id, key, text and data (array of encoded spans) of every row of docs; key tells rows of one doc_id apart."""
    texts = docs.select("doc_id", (F.crc32(F.coalesce("text", F.lit("")).cast("binary")) - (1 << 31)).cast("int").alias("key"), "text")
    total = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(MIN_BUCKETS, math.ceil(total / BUCKET_BYTES))
    found = texts.mapInArrow(map_anchors(buckets), ROWS).groupBy("bucket").applyInArrow(match_anchors, ROWS)
    found = materialise(found)
    release(docs.sparkSession)
    who = F.coalesce("doc_id", F.lit(NO_ID))
    keyed = texts.select(who.alias("id"), "key", "text")
    asked = found.filter(F.col("kind") != SPANS).groupBy(F.col("doc_id").alias("r_id"), F.col("key").alias("r_key")).agg(F.collect_list(F.when(F.col("kind") == CONTEXTS, F.col("data"))).alias("ctx"), F.collect_list(F.when(F.col("kind") == STRINGS, F.col("data"))).alias("str"))
    same = (F.col("id") == F.col("r_id")) & (F.col("key") == F.col("r_key"))
    fetched = keyed.join(asked, same).select("id", "key", "text", "ctx", "str").mapInArrow(fetch(buckets * SPREAD), ROWS)
    looked = fetched.groupBy("bucket").applyInArrow(resolve, ROWS)
    spans = found.filter(F.col("kind") == SPANS).unionByName(looked).groupBy(F.col("doc_id").alias("r_id"), F.col("key").alias("r_key")).agg(F.collect_list("data").alias("data"))
    return keyed.join(spans, same, "left").select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "key", "text", "data")


def cut_texts(batches):
    """doc_id, text with its spans removed, and the spans themselves."""
    for batch in batches:
        for part in slices(batch, 2, SLICE):
            data, offsets = text_bytes(part.column(2))
            n_bytes, removed, spans, digest = [], [], [], []
            for d, raws in enumerate(part.column(3).to_pylist()):
                own = data[offsets[d] : offsets[d + 1]]
                s = e = np.zeros(0, np.int64)
                if raws:
                    both = np.concatenate([spans_of(r) for r in raws], 1)
                    s, e = merged_spans(both[0], np.minimum(both[1], len(own)))
                keep = np.ones(len(own), bool)
                keep[expand(s, e - s)] = False
                n_bytes.append(len(own))
                removed.append(int((e - s).sum()))
                spans.append([{"start": a, "end": b} for a, b in zip(s.tolist(), e.tolist())])
                digest.append(hashlib.sha256(own[keep].tobytes()).hexdigest())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, kind), pa.array(digest, pa.string())], ["doc_id", "n_bytes", "n_removed", "spans", "kept_sha256"])


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (maximal removed byte ranges) and kept_sha256 of every document."""
    return removal_spans(docs).mapInArrow(cut_texts, "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<struct<start: bigint, end: bigint>>, kept_sha256 string")
