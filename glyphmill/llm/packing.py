"""Token ids in a binary format of fixed-width bit packing, with block offsets.

Documents are put in ascending order of doc_id by a range partitioning; each partition encodes its texts, packs every
id in the fewest bits that the vocabulary needs and writes one file in the shared folder. Files are numbered in
document order; the number of ids before a file is a running sum over the small table of files.

File: magic, then 6 unsigned 64-bit numbers (format version, bits an id, documents, ids, ids a block, blocks); then
doc_ids (signed 64-bit), validity of doc_ids (a byte each), first id of each document and the end (64-bit), byte offset of each block
and the end (64-bit), the blocks. All little-endian. In a block, 64 ids take exactly `bits` 64-bit words, id j at bit
j * bits; so any block is unpacked by numpy shifts on whole columns, and any id is found from its block's offset.

Defined cases: a null or empty text is the end id alone; rows of equal doc_id follow in order of their text hash;
null doc_ids come first; an empty table writes no file; extra columns are ignored.
"""

from __future__ import annotations

import math
import os
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, NON_SPACE, expand, make_folder, materialise, shared_dir, slices, text_bytes, trimmed, word_hashes

MAGIC = b"GLYPHTOK"
VERSION = 1
END_ID = 2
BLOCK_IDS = 4096
FILE_BYTES = 16 << 20
#: Pieces whose ids a worker remembers; beyond it the memory starts anew.
CACHE = 200_000
#: Pieces given to the tokenizer at once.
AT_ONCE = 2048


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> np.ndarray:
    """ids (a multiple of 64 of them) as 64-bit words."""
    groups = ids.astype(np.uint64).reshape(-1, 64)
    words = np.zeros((len(groups), bits), np.uint64)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        words[:, word] |= groups[:, j] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= groups[:, j] >> np.uint64(64 - shift)
    return words.ravel()


def unpack(words: np.ndarray, bits: int) -> np.ndarray:
    groups = words.reshape(-1, bits)
    ids = np.empty((len(groups), 64), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        value = groups[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | (groups[:, word + 1] << np.uint64(64 - shift))
        ids[:, j] = value & mask
    return ids.ravel()


#: A pre-tokenizer pattern (fixed value) under which an ASCII letter and ASCII punctuation other than ' never share a
#: piece, and a run of ASCII letters is one piece. Texts of such tokenizers are cut there too, so pieces repeat more.
LETTERS_APART = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _bytes(chars: str) -> np.ndarray:
    kind = np.zeros(256, bool)
    kind[list(chars.encode())] = True
    return kind


_KIND = np.zeros(256, np.int8)
_KIND[_bytes("abcdefghijklmnopqrstuvwxyz")] = 1
_KIND[_bytes("!\"#$%&()*+,-./:;=?@[\\]^_`{}~")] = 2  # without ' and the characters of special tokens


def splits_at_spaces(made: dict) -> bool:
    """Whether a tokenizer (its JSON) encodes white-space separated pieces one by one: a pre-tokenizer that drops white
    space or splits by LETTERS_APART with the rest removed, a normaliser that looks at single characters only, no added
    tokens with white space inside or that reach over it, no truncation, and a model that marks no word's beginning."""
    def parts(x, name):
        return [] if x is None else [y for z in x[name] for y in parts(z, name)] if x["type"] == "Sequence" else [x]

    before = parts(made.get("pre_tokenizer"), "pretokenizers")
    normal = parts(made.get("normalizer"), "normalizers")
    splits = [x for x in before if x["type"] in ("Whitespace", "WhitespaceSplit", "BertPreTokenizer")]
    splits += [x for x in before if x["type"] == "Split" and x.get("pattern", {}).get("Regex") == LETTERS_APART and x.get("behavior") == "Removed" and x.get("invert")]
    others = [x for x in before if x not in splits]
    plain = all(x["type"] == "ByteLevel" and not x.get("add_prefix_space") and not x.get("use_regex", True) for x in others)
    # What folds white space changes nothing between pieces; NFC and NFKC compose within a piece, but for a combining
    # mark after white space, which is a piece of its own either way.
    normal = all(x["type"] in ("Lowercase", "NFC", "NFKC", "NFD", "NFKD", "StripAccents", "BertNormalizer") or (x["type"] == "Replace" and x.get("pattern", {}).get("Regex") == r"\s+" and x.get("content") == " ") for x in normal)
    added = all(not re.search(r"\s", x["content"]) and not x.get("lstrip") and not x.get("rstrip") and not x.get("single_word") for x in made.get("added_tokens") or [])
    return bool(splits) and before[0] in splits and plain and normal and added and not made.get("truncation") and not made.get("padding")


class Encoder:
    """Ids of texts. Where the tokenizer never joins pieces over white space, each piece is encoded once and remembered;
    any other tokenizer gets whole texts."""

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.bits = bits_for(self.tokenizer.get_vocab_size(with_added_tokens=True))
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        self.by_piece = splits_at_spaces(made)
        text = json.dumps([made.get("normalizer"), made.get("pre_tokenizer")])
        self.apart = json.dumps(LETTERS_APART) in text and '"type": "Lowercase"' in text and '"use_regex": false' in text
        self.apart &= all(x["content"].startswith("<|") for x in made.get("added_tokens") or [])
        self.clear()

    def clear(self):
        self.known: dict[int, int] = {}
        self.flat, self.bounds = np.array([END_ID], np.uint32), np.array([0, 1], np.int64)

    def _new(self, pieces: list[str]) -> list[list[int]]:
        plain = [self.apart and p.isascii() and p.isalpha() for p in pieces]
        rest = [p for p, x in zip(pieces, plain) if not x]
        found = []
        for i in range(0, len(rest), AT_ONCE):  # the library's results are large
            found += [x.ids for x in self.tokenizer.encode_batch_fast(rest[i : i + AT_ONCE], add_special_tokens=False)]
        others, model = iter(found), self.tokenizer.model
        # Lower-case letters of one piece need no normaliser and no pre-tokenizer.
        return [[t.id for t in model.tokenize(p)] if x else next(others) for p, x in zip(pieces, plain)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each text); the end id closes each text."""
        if not self.by_piece:
            found = [np.array([*self.tokenizer.encode(x or "", add_special_tokens=False).ids, END_ID], np.uint32) for x in texts.to_pylist()]
            return np.concatenate([np.zeros(0, np.uint32), *found]), np.array([len(x) for x in found], np.int64)
        data, offsets = text_bytes(texts)
        solid = NON_SPACE[data]
        begin = solid.copy()
        begin[1:] &= ~solid[:-1]
        begin[offsets[:-1][offsets[:-1] < len(data)]] |= solid[offsets[:-1][offsets[:-1] < len(data)]]
        if self.apart:
            raw_data, data = data, LOWER[data]
            kind = _KIND[data]  # 1 letter, 2 mark
            begin[1:] |= (kind[1:] + kind[:-1] == 3) & (kind[1:] > 0) & (kind[:-1] > 0)
        start = np.flatnonzero(begin)
        over = ~solid
        over[begin] = True
        stop = np.append(np.flatnonzero(over), len(data))
        end = stop[np.searchsorted(stop, start, "right")]
        doc = np.searchsorted(offsets, start, "right") - 1
        if self.apart and len(start):  # special tokens match the text as it stands, so pieces that may hold one do too
            held = np.unique(np.searchsorted(start, np.flatnonzero((data[:-1] == 60) & (data[1:] == 124)), "right") - 1)
            own = expand(start[held], end[held] - start[held])
            data[own] = raw_data[own]
        names, first, piece = np.unique(word_hashes(data, start, end), return_index=True, return_inverse=True)
        if len(self.known) > CACHE:
            self.clear()
        at = [self.known.get(h, 0) for h in names.tolist()]  # 0 is the end id, never a piece
        new = [k for k, i in enumerate(at) if not i]
        if new:
            raw = data.tobytes()
            ids = self._new([raw[start[first[k]] : end[first[k]]].decode("utf-8", "replace") for k in new])
            base = len(self.bounds) - 1
            self.flat = np.concatenate((self.flat, np.array([i for x in ids for i in x], np.uint32)))
            self.bounds = np.concatenate((self.bounds, self.bounds[-1] + np.cumsum([len(x) for x in ids])))
            for j, k in enumerate(new):
                at[k] = self.known[int(names[k])] = base + j
        pieces = np.array(at, np.int64)[piece] if len(piece) else np.zeros(0, np.int64)
        ends = np.searchsorted(doc, np.arange(len(texts)), "right")
        pieces, owner = np.insert(pieces, ends, 0), np.insert(doc, ends, np.arange(len(texts)))
        length = self.bounds[pieces + 1] - self.bounds[pieces]
        return self.flat[expand(self.bounds[pieces], length)], np.bincount(owner, weights=length, minlength=len(texts)).astype(np.int64)


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """This worker's encoder; later tasks find its pieces known."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def file_bytes(doc_ids: pa.Array, counts: np.ndarray, ids: list[np.ndarray], bits: int) -> list[bytes]:
    total = int(counts.sum())
    blocks = -(-total // BLOCK_IDS)
    head = np.array([VERSION, bits, len(counts), total, BLOCK_IDS, blocks], np.uint64)
    valid = np.array(doc_ids.is_valid(), np.uint8)
    out = [MAGIC, head.tobytes(), np.array(doc_ids.fill_null(0), np.int64).tobytes(), valid.tobytes(), np.concatenate(([0], np.cumsum(counts))).astype(np.uint64).tobytes()]
    size = bits * BLOCK_IDS // 8
    out.append((np.arange(blocks + 1, dtype=np.uint64) * np.uint64(size)).tobytes())
    rest = np.zeros(0, np.uint32)
    for k, part in enumerate([*ids, None]):
        rest = np.concatenate((rest, part)) if part is not None else np.concatenate((rest, np.zeros(-len(rest) % BLOCK_IDS, np.uint32)))
        whole = len(rest) // BLOCK_IDS * BLOCK_IDS
        out.append(pack(rest[:whole], bits).tobytes())
        rest = rest[whole:]
    return out


class TokenFile:
    """Reads one file's bytes; ids of any range of places."""

    def __init__(self, raw: bytes):
        if raw[:8] != MAGIC:
            raise ValueError("not a token file")
        version, self.bits, self.docs, self.total, self.block, self.blocks = np.frombuffer(raw, np.uint64, 6, 8).tolist()
        if version != VERSION:
            raise ValueError(f"unknown version {version}")
        at = 8 + 48
        self.doc_ids = np.frombuffer(raw, np.int64, self.docs, at)
        self.valid = np.frombuffer(raw, np.uint8, self.docs, at := at + 8 * self.docs)
        self.first = np.frombuffer(raw, np.uint64, self.docs + 1, at := at + self.docs).astype(np.int64)
        self.offsets = np.frombuffer(raw, np.uint64, self.blocks + 1, at := at + 8 * (self.docs + 1)).astype(np.int64)
        self.raw, self.at = raw, at + 8 * (self.blocks + 1)

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids at places start to end - 1; only their blocks are unpacked."""
        if start >= end:
            return np.zeros(0, np.uint32)
        a, b = start // self.block, -(-end // self.block)
        words = np.frombuffer(self.raw[self.at + self.offsets[a] : self.at + self.offsets[b]], np.uint64)
        return unpack(words, self.bits)[start - a * self.block : end - a * self.block]


def write_tokens(docs: DataFrame, path: str, tokenizer: str) -> DataFrame:
    """Write the files below path; the table of files: file (number), name, n_docs, n_tokens."""
    make_folder(docs.sparkSession, path)
    texts = docs.select("doc_id", "text")
    total = texts.select(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(1, math.ceil(total / FILE_BYTES))
    ordered = texts.withColumn("tie", F.xxhash64("text")).repartitionByRange(files, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").withColumn("file", F.spark_partition_id())

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        encoder, doc_ids, counts, ids, number = encoder_of(tokenizer), [], [], [], None
        for batch in batches:
            for part in slices(batch, 1, 1 << 20):
                i, n = encoder.encode(part.column(1))
                doc_ids.append(part.column(0))
                counts.append(n)
                ids.append(i.astype(np.uint16) if encoder.bits <= 16 else i)
                number = part.column(3)[0].as_py()
        if number is None:
            return
        counts = np.concatenate(counts)
        fs, folder = pyarrow.fs.FileSystem.from_uri(path)
        fs.create_dir(folder, recursive=True)
        name = f"part-{number:08d}.glyphtok"
        trial = f"{folder}/_{name}.{uuid.uuid4().hex}"  # an attempt's own file; the whole file is then moved in place
        with fs.open_output_stream(trial) as out:
            for piece in file_bytes(pa.concat_arrays(doc_ids), counts, ids, encoder.bits):
                out.write(piece)
        fs.move(trial, f"{folder}/{name}")
        yield pa.RecordBatch.from_pydict({"file": pa.array([number], pa.int32()), "name": [name], "n_docs": [len(counts)], "n_tokens": [int(counts.sum())]})

    # Written as a table at once: the files' numbers belong to this one run of the range partitioning.
    return materialise(ordered.mapInArrow(trimmed(run), "file int, name string, n_docs bigint, n_tokens bigint"))


def read_tokens(files: DataFrame, path: str) -> DataFrame:
    """One row a document, from the files: doc_id, start, n_tokens, ids_crc32."""
    spark = files.sparkSession
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    starts = files.select("name", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("bigint").alias("start"))
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.glyphtok").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    if files.count() <= 50_000:
        starts = F.broadcast(starts)

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                f = TokenFile(batch.column(1)[k].as_py())
                base, crc = batch.column(2)[k].as_py(), np.zeros(f.docs, np.int64)
                at = 0
                while at < f.docs:  # some blocks at a time
                    to = max(at + 1, int(np.searchsorted(f.first, f.first[at] + (1 << 20), "right")) - 1)
                    ids = f.ids(f.first[at], f.first[to]).astype("<u4")
                    view = memoryview(ids).cast("B")
                    for d in range(at, to):
                        crc[d] = zlib.crc32(view[4 * (f.first[d] - f.first[at]) : 4 * (f.first[d + 1] - f.first[at])])
                    at = to
                yield pa.RecordBatch.from_arrays([pa.array(f.doc_ids, mask=f.valid == 0), pa.array(f.first[:-1] + base), pa.array(np.diff(f.first)), pa.array(crc)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return raw.join(starts, "name").select("name", "content", "start").mapInArrow(trimmed(run), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def tokenise(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Encode docs, write the files in the shared folder, and read them back."""
    path = shared_dir(docs.sparkSession)
    return read_tokens(write_tokens(docs, path, tokenizer), path)
