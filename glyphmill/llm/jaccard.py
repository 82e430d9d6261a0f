"""N-gram Jaccard join with multiple-global-order filtering, and the components of its links.

Two documents link when 100 * |intersection| >= PERCENT * |union| of their sets of word shingles. Documents of equal
sets (a 128-bit digest names a set) are one node, so copies cost nothing more. Under any one global order of all
shingles, linked sets of n shingles share one of their first n - ceil(PERCENT n / 100) + 1 shingles. The join uses
ORDERS orders, and a pair must pass the filters of all of them before it leaves the bucket where it is found.

Orders put rare shingles first: counts over all documents give each frequent shingle its class of frequency, and within
a class every order has its own hash. So a passage that a third of all documents share stands at the end of every order.

1. Groups of near copies would give all their pairs. So nodes first meet by least hashes of their sets (ROUNDS of them,
   equal for two sets with a probability of their similarity); groups are cut to blocks at random, parity maps of the
   sets tell which nodes of a block may link, and those are searched from node to node, exactly, until they are
   connected. No link is needed that lies inside a component found here; all others remain for the join.
2. Parts of PART nodes ask, a bucket of shingles at a time, which prefix shingles nodes of different components have. A
   part names a shingle once, however many of its nodes have it. A node stays if it has such a shingle under every order.
3. What stays meets by the shingles of the first order. A pair is a candidate if its components differ, its sizes fit,
   it shares a prefix shingle under each other order too, and its parity maps, which bound the difference of two sets
   from below, allow a link. Only then is it a row. Shingles with more than HOT nodes are spread: their nodes are dealt
   to chunks, and every two chunks meet in a bucket of their own.
4. Candidates are verified on the whole sets, and components are made of all links.

Defined cases: texts without words (null, empty, white space) have no shingles, link with nothing and are their own
component; a text of fewer words than a shingle is one shingle; repeated rows and copies share a node; null doc_ids
are larger than any other; an empty table gives an empty result; extra columns are kept by deduplicated. The set of
one text is held in memory as a whole (8 bytes a shingle).
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, NON_SPACE, discard, hot_join, materialise, mix64, release, slices, text_bytes, trimmed, word_hashes, words_of
from .components import components

SHINGLE = 4
PERCENT = 85
ORDERS = 3
ROUNDS = 3
#: Nodes, and shingles, of a block.
BLOCK, BLOCK_SHINGLES = 512, 1 << 20
#: Nodes of a part; nodes of a shingle beyond which it is spread; nodes compared with a bucket's at once.
PART, HOT, AT_ONCE = 1000, 4096, 64
FREQUENT, MOST_FREQUENT, CHUNK = 12, 1 << 20, 1 << 22
#: Bits of the parity map of a set.
MAP_BITS = 2048
#: Text behind one bucket of prefix shingles.
BUCKET_BYTES = 48 << 20
MIN_BUCKETS = 16
#: Bytes of the filter that tells the scan which sets to fetch; a full filter only lets more sets through.
FILTER_BYTES = 1 << 20
#: Unrelated odd numbers (multiples of one would let shingles of repeated words collide).
_SALT = mix64(np.arange(1, 40, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def document_sets(texts: pa.Array, shingle: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, sorted."""
    data, offsets = text_bytes(texts)
    data = LOWER[data]
    start, end, doc = words_of(data, offsets, NON_SPACE)
    w = word_hashes(data, start, end)
    n = np.bincount(doc, minlength=len(texts))
    first = np.cumsum(n) - n
    out: list = []
    whole = np.zeros(max(0, len(w) - shingle + 1), np.uint64)
    for k in range(shingle):
        whole += w[k : len(w) - shingle + 1 + k] * _SALT[k]
    whole = mix64(whole)
    for a, m in zip(first.tolist(), n.tolist()):
        if m >= shingle:
            out.append(np.unique(whole[a : a + m - shingle + 1]))
        elif m:
            out.append(mix64((w[a : a + m] * _SALT[:m]).sum(keepdims=True) + np.uint64(m)))
        else:
            out.append(w[:0])
    return out


def digest_of(s: np.ndarray) -> bytes:
    """The 128-bit name of a set."""
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def parity_map(s: np.ndarray) -> bytes:
    """For each of MAP_BITS classes of shingles, whether the set has an odd number of them. Maps of two sets differ in
    no more bits than the sets do in members."""
    at = (mix64(s ^ _SALT[20]) & np.uint64(MAP_BITS - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=MAP_BITS) & 1).astype(bool)).tobytes()


def _short(s: np.ndarray) -> bytes:
    """Six bytes of each hash."""
    return np.ascontiguousarray(mix64(s)).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _long(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def prefix_length(n: int, percent: int) -> int:
    return n + (-percent * n) // 100 + 1  # n - ceil(percent * n / 100) + 1


def _parts(batches, text: int):
    for batch in batches:
        yield from slices(batch, text)


def frequent(docs: DataFrame, shingle: int) -> np.ndarray:
    """The frequent shingles and their counts, as two rows, in order of shingle.

    Each task counts the shingles of its texts, some CHUNK at a time, and passes on those that it saw twice or more;
    the sums of FREQUENT or more are kept, at most MOST_FREQUENT of them (16 MB), the highest. They only rank shingles:
    whatever is missing here costs time, never a link.
    """

    def count(batches):
        gathered = []

        def passed():
            names, n = np.unique(np.concatenate(gathered), return_counts=True)
            names, n = names[n > 1], n[n > 1]
            piece = (names % np.uint64(16)).astype(np.int64)
            for k in range(16):
                own = piece == k
                if own.any():
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([names[own].tobytes()], pa.binary()), pa.array([n[own].astype(np.int64).tobytes()], pa.binary())], ["piece", "names", "n"])

        for part in _parts(batches, 0):
            gathered += document_sets(part.column(0), shingle)
            held = sum(map(len, gathered))
            if held > CHUNK:
                yield from passed()
                gathered = []
        if gathered:
            yield from passed()

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        names = np.frombuffer(b"".join(table["names"].to_pylist()), np.uint64)
        n = np.frombuffer(b"".join(table["n"].to_pylist()), np.int64)
        names, at = np.unique(names, return_inverse=True)
        n = np.bincount(at, weights=n).astype(np.int64)
        top = np.flatnonzero(n >= FREQUENT)
        top = np.sort(top[np.argsort(-n[top], kind="stable")][: MOST_FREQUENT // 16])
        return pa.table({"names": pa.array([names[top].tobytes()], pa.binary()), "n": pa.array([n[top].tobytes()], pa.binary())})

    pieces = docs.select("text").mapInArrow(trimmed(count), "piece int, names binary, n binary").groupBy("piece").applyInArrow(merge, "names binary, n binary").collect()
    names, n = np.frombuffer(b"".join(r["names"] for r in pieces), np.uint64), np.frombuffer(b"".join(r["n"] for r in pieces), np.int64)
    order = np.argsort(names)
    return np.stack((names[order], n[order].astype(np.uint64)))


def _pieces(whole: np.ndarray):
    for k, x in enumerate(np.split(whole, 16)):
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(x.tobytes(), 1)], pa.binary())], ["piece", "data"])


def _merged(pieces: DataFrame, kind, op, size: int) -> np.ndarray:
    """Fixed-size arrays of all tasks, put together piece by piece."""

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        total = None
        for raw in table["data"].to_pylist():
            x = np.frombuffer(zlib.decompress(raw), kind)
            total = x if total is None else op(total, x)
        return pa.table({"piece": pa.array([key[0].as_py()], pa.int32()), "data": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    rows = {r["piece"]: r["data"] for r in pieces.groupBy("piece").applyInArrow(merge, "piece int, data binary").collect()}
    return np.concatenate([np.frombuffer(zlib.decompress(rows[k]), kind) for k in range(16)]) if rows else np.zeros(size, kind)


def _classes(s: np.ndarray, often: np.ndarray) -> np.ndarray:
    """Class of frequency of each shingle: 0, or the bits of its count."""
    names, n = often
    if not len(names):
        return np.zeros(len(s), np.uint64)
    at = np.minimum(np.searchsorted(names, s), len(names) - 1)
    return np.where(names[at] == s, np.frexp(n[at].astype(np.float64))[1], 0).astype(np.uint64)


def _ranks(s: np.ndarray, rare: np.ndarray, order: int) -> np.ndarray:
    """Place of each shingle in a global order: class of frequency, then the order's own hash."""
    return (rare << np.uint64(56)) | (mix64(s ^ _SALT[order]) >> np.uint64(8))


def signatures(docs: DataFrame, often: np.ndarray, shingle: int, percent: int) -> DataFrame:
    """doc_id, text_digest (md5), digest, n, least hashes (lead: array), parity map and prefixes (p0, p1, ...: 6 bytes a
    shingle) of each document; digest is null where there are no shingles."""
    sent = docs.sparkSession.sparkContext.broadcast(often)

    def run(batches):
        for part in _parts(batches, 1):
            digest, size, lead, maps, prefix = [], [], [], [], [[] for _ in range(ORDERS)]
            for s in document_sets(part.column(1), shingle):
                n = len(s)
                digest.append(digest_of(s) if n else None)
                size.append(n)
                maps.append(parity_map(s) if n else None)
                lead.append([int(mix64(s ^ _SALT[21 + k]).min().view(np.int64)) for k in range(ROUNDS)] if n else [])
                rare = _classes(s, sent.value)
                length = prefix_length(n, percent) if n else 0
                for k in range(ORDERS):
                    prefix[k].append(_short(s[np.argpartition(_ranks(s, rare, k), length - 1)[:length]]) if length else None)
            yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), part.column(2), pa.array(digest, pa.binary()), pa.array(size, pa.int64()), pa.array(lead, pa.list_(pa.int64())), pa.array(maps, pa.binary()), *[pa.array(p, pa.binary()) for p in prefix]], ["doc_id", "text_digest", "digest", "n", "lead", "map", *[f"p{k}" for k in range(ORDERS)]])

    return docs.select("doc_id", "text", F.unhex(F.md5("text")).alias("text_digest")).mapInArrow(trimmed(run), "doc_id bigint, text_digest binary, digest binary, n bigint, lead array<bigint>, map binary, " + ", ".join(f"p{k} binary" for k in range(ORDERS)))


def sets_of(docs: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """node, data (8 bytes a shingle) of all the nodes given (node, digest), each once. Only texts whose digest passes a
    filter of fixed size are sent on; the join by digest is exact."""
    bits = np.uint64(FILTER_BYTES * 8 - 1)

    def places(digests: list[bytes]):
        x = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
        return [(mix64(x[:, 0] + _SALT[k] * x[:, 1]) & bits).astype(np.int64) for k in range(3)]

    def fill(batches):
        on = np.zeros(FILTER_BYTES * 8, bool)
        for batch in batches:
            for p in places(batch.column(0).to_pylist()):
                on[p] = True
        yield from _pieces(np.packbits(on))

    on = _merged(nodes.select("digest").coalesce(16).mapInArrow(fill, "piece int, data binary"), np.uint8, np.bitwise_or, FILTER_BYTES)
    sent = docs.sparkSession.sparkContext.broadcast(on)

    def fetch(batches):
        for part in _parts(batches, 0):
            sets = [s for s in document_sets(part.column(0), shingle) if len(s)]
            digests = [digest_of(s) for s in sets]
            good = np.ones(len(digests), bool)
            for p in places(digests):
                good &= (sent.value[p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1 > 0
            once = {d: i for i, d in enumerate(digests) if good[i]}
            if once:
                yield pa.RecordBatch.from_arrays([pa.array(list(once), pa.binary()), pa.array([sets[i].tobytes() for i in once.values()], pa.binary())], ["digest", "data"])

    return docs.select("text").mapInArrow(trimmed(fetch), "digest binary, data binary").dropDuplicates(["digest"]).join(nodes.select("digest", "node"), "digest").select("node", "data")


class Maps:
    """Parity maps and sizes of some sets, to be compared with others."""

    def __init__(self, raw: list[bytes], n: np.ndarray, percent: int):
        self.maps = np.frombuffer(b"".join(raw), np.uint64).reshape(-1, MAP_BITS // 64)
        self.n, self.percent = n, percent

    def near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For each of i and of j (a matrix): may they link? Sets that do differ in at most
        (100 - percent) (n + m) / (100 + percent) members, and in size by as much."""
        n, m = self.n[i][:, None], self.n[j][None, :]
        out = 100 * np.minimum(n, m) >= self.percent * np.maximum(n, m)
        a, b = np.nonzero(out)
        most = (100 - self.percent) * (n + m)[a, b]
        for at in range(0, len(a), 1 << 15):
            k = slice(at, at + (1 << 15))
            apart = np.bitwise_count(self.maps[i[a[k]]] ^ self.maps[j[b[k]]]).sum(1, dtype=np.int64)
            out[a[k], b[k]] = (100 + self.percent) * apart <= most[k]
        return out


def likely_groups(percent: int):
    """The nodes of a block that may link with others of it, each with the least node of those it may be connected to."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        node, n = table["node"].to_numpy(), table["n"].to_numpy()
        maps, free = Maps(table["map"].to_pylist(), n, percent), np.ones(len(node), bool)
        which, of = [], []
        for first in np.argsort(node).tolist():
            if not free[first]:
                continue
            free[first] = False
            found, fresh = [first], np.array([first])
            while len(fresh) and free.any():
                rest = np.flatnonzero(free)
                hit = np.zeros(len(rest), bool)
                for at in range(0, len(fresh), AT_ONCE):
                    still = np.flatnonzero(~hit)
                    hit[still] |= maps.near(fresh[at : at + AT_ONCE], rest[still]).any(0)
                fresh = rest[hit]
                free[fresh] = False
                found += fresh.tolist()
            if len(found) > 1:
                which += found
                of += [int(node[first])] * len(found)
        return pa.table({"node": pa.array(node[which] if which else [], pa.int64()), "of": pa.array(of, pa.int64())})

    return run


def block_links(percent: int):
    """Links that connect the nodes of a group as all its links would."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        node = table["node"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in table["data"].to_pylist()]
        size = np.array([len(s) for s in sets])
        maps = Maps([parity_map(s) for s in sets], size, percent)
        u, v, free = [], [], np.ones(len(sets), bool)
        for first in range(len(sets)):
            if not free[first]:
                continue
            free[first] = False
            queue = [first]
            while queue and free.any():
                i = queue.pop()
                rest = np.flatnonzero(free)
                for j in rest[maps.near(np.array([i]), rest)[0]].tolist():
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if 100 * both >= percent * (size[i] + size[j] - both):
                        free[j] = False
                        queue.append(j)
                        u.append(node[i])
                        v.append(node[j])
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return run


def likely_links(docs: DataFrame, nodes: DataFrame, shingle: int, percent: int, made: list[str]) -> DataFrame:
    """Verified links (u, v) within blocks of nodes with a least hash in common."""
    leads = nodes.select("node", "n", F.posexplode("lead").alias("round", "first"))
    groups = leads.groupBy("round", "first").agg(F.count("*").alias("m"), F.sum("n").alias("total")).filter("m > 1").withColumn("blocks", F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES))).select("round", "first", "blocks")
    cut = leads.join(groups, ["round", "first"]).withColumn("block", F.pmod(F.xxhash64("node", "round"), F.col("blocks")).cast("int"))
    cut = cut.select("round", "first", "block", "node").join(nodes.select("node", "n", "map"), "node")
    groups = cut.groupBy("round", "first", "block").applyInArrow(likely_groups(percent), "node bigint, of bigint")
    groups = materialise(groups.distinct(), made)
    sets = sets_of(docs, groups.select("node").distinct().join(nodes.select("node", "digest"), "node"), shingle)
    return groups.join(sets, "node").groupBy("of").applyInArrow(block_links(percent), "u bigint, v bigint")


def _six(token: np.ndarray) -> bytes:
    return np.ascontiguousarray(token).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def part_rows(batches):
    """Rows (node, n, root, map, p0, p1, ...) put together to parts: one row, all columns as bytes."""
    for batch in batches:
        for at in range(0, batch.num_rows, PART):
            b = batch.slice(at, PART)
            numbers = [np.array(b.column(k)) for k in range(3)]
            prefixes = [b.column(4 + k).to_pylist() for k in range(ORDERS)]
            row = [[int(numbers[0][0])], *[[x.tobytes()] for x in numbers], [b"".join(b.column(3).to_pylist())]]
            row += [[np.array([len(x) // 6 for x in p], "<u4").tobytes()] for p in prefixes] + [[b"".join(p)] for p in prefixes]
            yield pa.RecordBatch.from_arrays([pa.array(row[0]), *[pa.array(x, pa.binary()) for x in row[1:]]], PART_NAMES)


PART_NAMES = ["part", "node", "n", "root", "map", *[f"c{k}" for k in range(ORDERS)], *[f"p{k}" for k in range(ORDERS)]]
PART_ROWS = "part bigint, " + ", ".join(f"{c} binary" for c in PART_NAMES[1:])
ASKS = "bucket int, part bigint, token binary, n binary, count binary, root binary"


def _by_bucket(bucket: np.ndarray):
    """Numbers of the rows of each bucket."""
    turn = np.argsort(bucket, kind="stable")
    cut = np.flatnonzero(np.concatenate(([True], bucket[turn][1:] != bucket[turn][:-1], [True]))) if len(turn) else []
    for i, j in zip(cut[:-1], cut[1:]):
        yield int(bucket[turn[i]]), turn[i:j]


def _short_key(token: np.ndarray, buckets: int) -> np.ndarray:
    """32 bits that tell shingles of a bucket apart (if two share them, both stay for longer: no pair is lost)."""
    return (token // np.uint64(buckets) & np.uint64(0xFFFFFFFF)).astype("<u4")


def asks(buckets: int):
    """Parts (part, root, c, p) to rows of a bucket: each prefix shingle, once or, if nodes of different components have
    it, with two of them, and how many nodes; for each component's node the number of its shingles in the row."""

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                part, root = batch.column(0)[r].as_py(), np.frombuffer(batch.column(1)[r].as_py(), np.int64)
                out = []
                for k in range(ORDERS):
                    owner = np.repeat(np.arange(len(root)), np.frombuffer(batch.column(2 + k)[r].as_py(), "<u4"))
                    token = _long(batch.column(2 + ORDERS + k)[r].as_py())
                    turn = np.lexsort((root[owner], token))
                    token, owner = token[turn], owner[turn]
                    new = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
                    last = np.append(new[1:], len(token)) - 1
                    two = np.flatnonzero(root[owner[new]] != root[owner[last]])
                    token, n = np.concatenate((token[new], token[new[two]])), np.concatenate((last - new + 1, np.zeros(len(two), np.int64)))
                    owner = np.concatenate((owner[new], owner[last[two]]))
                    for b, t in _by_bucket((token % np.uint64(buckets)).astype(np.int64)):
                        t = t[np.argsort(owner[t], kind="stable")]
                        who, count = np.unique(owner[t], return_counts=True)
                        out.append((b * ORDERS + k, part, _short_key(token[t], buckets).tobytes(), n[t].astype("<u2").tobytes(), count.astype("<u4").tobytes(), root[who].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), *[pa.binary()] * 4))], ["bucket", "part", "token", "n", "count", "root"])

    return run


def answers(key: tuple, table: pa.Table) -> pa.Table:
    """A bucket's asks to rows for each part: its shingles that different components have, with the number of nodes."""
    raw = {c: table[c].to_pylist() for c in ("token", "n", "count", "root")}
    part = np.repeat(np.arange(len(table)), [len(x) // 4 for x in raw["token"]])
    token, n, count, root = (np.frombuffer(b"".join(raw[c]), t) for c, t in (("token", "<u4"), ("n", "<u2"), ("count", "<u4"), ("root", np.int64)))
    root = np.repeat(root, count)
    turn = np.argsort(token, kind="stable")
    new = np.flatnonzero(np.concatenate(([True], token[turn][1:] != token[turn][:-1])))
    live = np.minimum.reduceat(root[turn], new) != np.maximum.reduceat(root[turn], new)
    total = np.add.reduceat(n[turn].astype(np.int64), new)
    group = np.empty(len(token), np.int64)
    group[turn] = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(token))))
    own = np.flatnonzero(live[group])
    names, out = table["part"].to_pylist(), []
    for p, t in _by_bucket(part[own]):
        out.append((names[p], key[0].as_py(), token[own[t]].tobytes(), total[group[own[t]]].tobytes()))
    return pa.table([pa.array(c, t) for c, t in zip(list(map(list, zip(*out))) or [[]] * 4, (pa.int64(), pa.int32(), pa.binary(), pa.binary()))], ["part", "bucket", "token", "n"])


def entries(buckets: int):
    """Parts with their answers (an array of structs bucket, token, n) to rows of a bucket, for nodes that have a shared
    shingle under every order: groups (a shingle, or two chunks of a spread one), and of the nodes: count of groups,
    node, n, root, map, and shared shingles of the other orders (32 bits each) with their counts."""

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                cell = lambda name: batch.column(name)[r].as_py()
                node, n, root = (np.frombuffer(cell(c), np.int64) for c in ("node", "n", "root"))
                maps = np.frombuffer(cell("map"), np.uint8).reshape(len(node), -1)
                heard = [[x for x in cell("heard") if x["bucket"] % ORDERS == k] for k in range(ORDERS)]
                stay, shared = np.ones(len(node), bool), []
                for k in range(ORDERS):
                    owner = np.repeat(np.arange(len(node)), np.frombuffer(cell(f"c{k}"), "<u4"))
                    token = _long(cell(f"p{k}"))
                    live = np.concatenate([np.zeros(0, np.uint64), *[np.frombuffer(x["token"], "<u4") + (np.uint64(x["bucket"] // ORDERS) << np.uint64(32)) for x in heard[k]]])
                    total = np.frombuffer(b"".join(x["n"] for x in heard[k]), np.int64)
                    turn = np.argsort(live)
                    live, total = live[turn], total[turn]
                    names = _short_key(token, buckets) + (token % np.uint64(buckets) << np.uint64(32))
                    at = np.minimum(np.searchsorted(live, names), max(0, len(live) - 1))
                    hit = np.flatnonzero(live[at] == names) if len(live) else np.zeros(0, np.int64)
                    shared.append((owner[hit], token[hit], total[at[hit]] if len(live) else hit))
                    has = np.zeros(len(node), bool)
                    has[owner[hit]] = True
                    stay &= has
                keep = [stay[o] for o, _, _ in shared]
                owner, token, total = (x[keep[0]] for x in shared[0])
                if not len(owner):
                    continue
                # A spread shingle: its nodes have a chunk each, and meet every chunk in a group of its own.
                chunks = -(-total // HOT)
                own = (mix64(node[owner].view(np.uint64) + _SALT[30]) % chunks.astype(np.uint64)).astype(np.int64)
                again = np.repeat(np.arange(len(owner)), chunks)
                other = np.arange(len(again)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
                mine = own[again]
                low, high = np.minimum(mine, other), np.maximum(mine, other)
                group = mix64(token[again] * np.uint64(2) + mix64(low.astype(np.uint64) * _SALT[31] + high.astype(np.uint64) * _SALT[32]))
                # The last bit tells the two chunks of a group apart; 2: one chunk with itself.
                side = np.where(low == high, 2, (mine == high).astype(np.int64)).astype(np.uint8)
                owner = owner[again]
                rest = []
                for (o, t, _), ok in zip(shared[1:], keep[1:]):
                    o, t = o[ok], (t[ok] & np.uint64(0xFFFFFFFF)).astype("<u4")
                    turn = np.lexsort((t, o))
                    rest.append((np.searchsorted(o[turn], np.arange(len(node) + 1)), t[turn]))
                out = []
                for b, t in _by_bucket((group % np.uint64(buckets)).astype(np.int64)):
                    t = t[np.argsort(owner[t], kind="stable")]
                    who, count = np.unique(owner[t], return_counts=True)
                    others = []
                    for bounds, flat in rest:
                        others += [np.diff(np.stack((bounds[who], bounds[who + 1])), axis=0).astype("<u4").tobytes(), b"".join(flat[bounds[w] : bounds[w + 1]].tobytes() for w in who.tolist())]
                    out.append((b, group[t].tobytes(), side[t].tobytes(), count.astype("<u4").tobytes(), node[who].tobytes(), n[who].tobytes(), root[who].tobytes(), maps[who].tobytes(), *others))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int32() if k == 0 else pa.binary()) for k, c in enumerate(zip(*out))], ENTRY_NAMES)

    return run


ENTRY_NAMES = ["bucket", "group", "side", "count", "node", "n", "root", "map", *[f"{x}{k}" for k in range(1, ORDERS) for x in ("oc", "ot")]]
ENTRIES = "bucket int, " + ", ".join(f"{c} binary" for c in ENTRY_NAMES[1:])


def candidate_pairs(percent: int):
    """Pairs of nodes of different components that pass the prefix filters of all orders, the sizes and the maps."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        raw = {c: b"".join(table[c].to_pylist()) for c in ENTRY_NAMES[1:] if c != "map"}
        place = np.repeat(np.arange(len(raw["count"]) // 4), np.frombuffer(raw["count"], "<u4"))
        group, side = np.frombuffer(raw["group"], np.uint64), np.frombuffer(raw["side"], np.uint8)
        node, n, root = (np.frombuffer(raw[c], np.int64) for c in ("node", "n", "root"))
        maps = Maps(table["map"].to_pylist(), n, percent)
        others = []
        for k in range(1, ORDERS):
            count = np.frombuffer(raw[f"oc{k}"], "<u4").astype(np.int64)
            others.append((np.concatenate(([0], np.cumsum(count))), np.frombuffer(raw[f"ot{k}"], "<u4")))
        turn = np.lexsort((n[place], group))
        place, group, side = place[turn], group[turn], side[turn]
        cut = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True])))
        u, v, found = [], [], 0
        for i, j in zip(cut[:-1].tolist(), cut[1:].tolist()):
            own, half = place[i:j], side[i:j]
            if j - i < 2 or (root[own] == root[own[0]]).all():
                continue
            for at in range(0, len(own) - 1, AT_ONCE):
                a = own[at : at + AT_ONCE]
                reach = int(np.searchsorted(n[own], 100 * n[a[-1]] // percent, "right"))  # own is in order of n
                b = own[at:reach]
                good = (root[a][:, None] != root[b][None, :]) & (np.arange(len(a))[:, None] < np.arange(len(b))[None, :])
                apart = half[at : at + AT_ONCE][:, None], half[at:reach][None, :]
                good &= (apart[0] != apart[1]) | (apart[0] == 2)
                rows, columns = np.flatnonzero(good.any(1)), np.flatnonzero(good.any(0))
                if not len(rows):
                    continue
                good = good[np.ix_(rows, columns)] & maps.near(a[rows], b[columns])
                x, y = np.nonzero(good)
                u.append(np.minimum(a[rows[x]], b[columns[y]]))
                v.append(np.maximum(a[rows[x]], b[columns[y]]))
                found += len(x)
                if found > 1 << 21:  # repeats of a pair, by several shingles, are dropped as they gather
                    pairs = np.unique(np.concatenate(u) * len(node) + np.concatenate(v))
                    u, v, found = [pairs // len(node)], [pairs % len(node)], 0
        pairs = np.unique(np.concatenate(u) * len(node) + np.concatenate(v)) if u else np.zeros(0, np.int64)
        u, v = pairs // max(1, len(node)), pairs % max(1, len(node))
        for bounds, flat in others:  # a shingle in common under every other order
            shares = np.zeros(len(u), bool)
            for k, (a, b) in enumerate(zip(u.tolist(), v.tolist())):
                x, y = flat[bounds[a] : bounds[a + 1]], flat[bounds[b] : bounds[b + 1]]
                at = np.searchsorted(x, y)
                shares[k] = (x[np.minimum(at, len(x) - 1)] == y).any()
            u, v = u[shares], v[shares]
        pairs = np.unique(np.sort(np.stack((node[u], node[v]), 1), 1), axis=0)
        return pa.table({"u": pa.array(pairs[:, 0], pa.int64()), "v": pa.array(pairs[:, 1], pa.int64())})

    return run


def verified(percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for s, t in zip(batch.column(2), batch.column(3)):
                s, t = np.frombuffer(s.as_py(), np.uint64), np.frombuffer(t.as_py(), np.uint64)
                both = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(100 * both >= percent * (len(s) + len(t) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def candidates(parts: DataFrame, buckets: int, percent: int, made: list[str]) -> DataFrame:
    """Pairs (u, v) of nodes of different components that may link. What parts ask is as large as the parts; answers are
    written, so that it is gone from the disk before the parts are shuffled."""
    asked = parts.select("part", "root", *[f"c{k}" for k in range(ORDERS)], *[f"p{k}" for k in range(ORDERS)]).mapInArrow(trimmed(asks(buckets)), ASKS)
    own: list[str] = []
    heard = materialise(asked.groupBy("bucket").applyInArrow(answers, "part bigint, bucket int, token binary, n binary"), own)
    release(parts.sparkSession)
    heard = heard.groupBy(F.col("part").alias("of")).agg(F.collect_list(F.struct("bucket", "token", "n")).alias("heard"))
    found = parts.join(heard, F.col("part") == F.col("of")).select(*PART_NAMES[1:], "heard").mapInArrow(trimmed(entries(buckets)), ENTRIES)
    pairs = materialise(found.groupBy("bucket").applyInArrow(candidate_pairs(percent), "u bigint, v bigint").distinct(), made)
    discard(parts.sparkSession, own)
    return pairs


def join(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_digest, n, node and root (the component's least node) of all documents; node and root are null where
    there are no shingles. Nodes are numbered anew by each run."""
    spark, docs, made = docs.sparkSession, docs.select("doc_id", "text"), []
    total = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(MIN_BUCKETS, math.ceil(total / BUCKET_BYTES))
    wide: list[str] = []
    signed = materialise(signatures(docs, frequent(docs, shingle), shingle, percent), wide)
    narrow = materialise(signed.select("doc_id", "text_digest", "digest", "n"), made)
    some = signed.filter("n > 0")
    # One row a set: n_left counts its documents.
    nodes = narrow.filter("n > 0").groupBy("digest").agg(F.count("*").alias("n_left")).withColumn("node", F.monotonically_increasing_id())
    nodes = materialise(some.select("digest", "n", "lead", "map").dropDuplicates(["digest"]).join(materialise(nodes, made), "digest"), made)
    likely = materialise(components(likely_links(docs, nodes, shingle, percent, made)), made)
    release(spark)
    known = nodes.select("digest", "node").join(likely, "node", "left").select("digest", "node", F.coalesce("root", "node").alias("root"))
    prefixes = [f"p{k}" for k in range(ORDERS)]
    rows = some.select("digest", "n", "map", *prefixes).dropDuplicates(["digest"]).join(known, "digest").select("node", "n", "root", "map", *prefixes)
    in_parts: list[str] = []
    parts = materialise(rows.mapInArrow(trimmed(part_rows), PART_ROWS), in_parts)
    discard(spark, wide)
    del some, rows, signed
    release(spark)
    pairs = candidates(parts, buckets, percent, made)
    discard(spark, in_parts)
    del parts
    release(spark)
    asked = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct().join(nodes.select("node", "digest"), "node")
    sets = materialise(sets_of(docs, asked, shingle), made)
    both = pairs.join(sets.select(F.col("node").alias("u"), F.col("data").alias("x")), "u").join(sets.select(F.col("node").alias("v"), F.col("data").alias("y")), "v").select("u", "v", "x", "y")
    more = both.mapInArrow(trimmed(verified(percent)), "u bigint, v bigint")
    roots = components(more.unionByName(likely.select(F.col("node").alias("u"), F.col("root").alias("v"))))
    # Sets with very many copies must not meet in one task.
    rooted = materialise(nodes.select("digest", "n_left", "node").join(roots, "node", "left").select("digest", "n_left", "node", F.coalesce("root", "node").alias("root")), made)
    none = narrow.filter("n = 0").select("doc_id", "text_digest", "n", F.lit(None).cast("bigint").alias("node"), F.lit(None).cast("bigint").alias("root"))
    out = materialise(hot_join(narrow.filter("n > 0"), rooted, "digest").select("doc_id", "text_digest", "n", "node", "root").unionByName(none))
    discard(spark, made)
    release(spark)
    return out


def classes(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, node, n_shingles and component_id, the smallest doc_id reachable by links, of every document."""
    rooted = join(docs, shingle, percent)
    least = materialise(rooted.filter("n > 0").groupBy("root").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_left")))
    found = hot_join(rooted.filter("n > 0"), least, "root").select("doc_id", "node", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))
    return found.unionByName(rooted.filter("n = 0").select("doc_id", "node", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def deduplicated(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """docs without near duplicates: of each component one row stays, that of smallest doc_id (nulls last), then of
    smallest digest of its text. Rows without words are in no component: all stay, but for repeats equal in all columns."""
    from pyspark.sql import Window

    from .common import packed

    who = lambda doc_id, digest: F.struct(doc_id.isNull().alias("none"), F.coalesce(doc_id.cast("bigint"), F.lit(0)).alias("id"), digest.alias("digest"))
    made = join(docs, shingle, percent).filter("n > 0")
    stay = made.groupBy("root").agg(F.min(who(F.col("doc_id"), F.col("text_digest"))).alias("who")).select("who", F.lit(True).alias("least"))
    text = F.col("row.text")
    wordless = ~F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    whole = F.unhex(F.md5(F.to_json("row", {"ignoreNullFields": "false"})))
    rows = packed(docs).withColumn("wordless", wordless).withColumn("who", who(F.col("row.doc_id"), F.when(F.col("wordless"), whole).otherwise(F.unhex(F.md5(text)))))
    rows = rows.join(stay, "who", "left").filter("wordless OR least")
    # Rows equal in doc_id and text are one.
    one = Window.partitionBy("who").orderBy(F.to_json(F.col("row").dropFields("text")))
    return rows.withColumn("turn", F.row_number().over(one)).filter("turn = 1").select("row.*")
