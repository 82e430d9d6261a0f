"""Sharding, quality rules, mixing, decontamination and token files against plain Python."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from glyphmill.llm import decontamination, mixing, packing, quality, queries, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


# sharding ---------------------------------------------------------------------------------------------------------
def check_shards(rows, docs, shards=sharding.SHARDS):
    assert len(rows) == len(docs)
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(d.doc_id) for d in docs)
    for k in range(shards):
        slots = sorted(r.slot for r in rows if r.shard == k)
        assert slots == list(range(len(slots)))
    by = {d.doc_id: d.text or "" for d in docs}
    for r in rows:
        assert r.size == len(by[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(by[r.doc_id].encode())
        assert r.grown_shard in (r.shard, shards)


def test_sharding_query(spark, sf):
    rows = queries.op1_sharding(spark, sf).collect()
    check_shards(rows, documents(spark, sf).collect())
    assert sorted(map(str, rows)) == sorted(map(str, queries.op1_sharding(spark, sf).collect()))
    in_order = [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert in_order != sorted(in_order)


def test_sharding_edges(edge, empty):
    done = sharding.shard(edge, 3)
    assert done.count() == edge.count() and done.select("row.*").columns == edge.columns
    assert sharding.shard(empty, 3).count() == 0


def test_small_buckets(spark, sf, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_BYTES", 5000)
    rows = sharding.shard(documents(spark, sf), 4).select("doc_id", "shard", "slot", "bucket").collect()
    assert len({(r.shard, r.bucket) for r in rows}) > 20
    for k in range(4):
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(sum(r.shard == k for r in rows)))


# quality ----------------------------------------------------------------------------------------------------------
def brute_quality(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    n = len(words)
    return n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n


@pytest.mark.parametrize("which", ["sf", "edge"])
def test_quality(spark, sf, edge, which):
    docs = documents(spark, sf) if which == "sf" else edge
    got = quality.quality_report(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(got) == docs.count()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_quality(texts[r.doc_id]), r.doc_id
        assert not (r.base_failed and r.kept)
    kept = sorted(r.doc_id for r in got if r.kept)
    filtered = quality.quality_filter(docs)
    assert filtered.columns == docs.columns and sorted(r.doc_id for r in filtered.collect()) == kept


def test_quality_empty(empty):
    assert quality.quality_report(empty).count() == 0 and quality.quality_filter(empty).count() == 0


def test_quality_is_adaptive(spark):
    """A source where every document has many symbols keeps them; the same document elsewhere goes."""
    odd = " ".join(["word#"] * 3 + [f"a{i}#" for i in range(30)])
    plain = lambda i: " ".join(f"b{i}x{k}" for k in range(30))
    rows = [(i, odd + f" t{i}", "en", "code") for i in range(20)] + [(100 + i, plain(i), "en", "news") for i in range(20)] + [(200, odd, "en", "news")]
    got = {r.doc_id: r.kept for r in quality.quality_report(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i] for i in range(20)) and all(got[100 + i] for i in range(20)) and not got[200]


def test_quality_thresholds(spark):
    """Every fence of the real documents comes from a sketch; small groups take their language's."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    stats = quality.statistics(docs, repeats=False).select("*", "row.lang", "row.source")
    rows = quality.thresholds(stats).collect()
    assert len(rows) == docs.select("lang", "source").distinct().count()
    assert all(getattr(r, f"level_{k}") in ("own", "lang") and getattr(r, f"max_{k}") > 0 for r in rows for k in quality.MEASURES)
    assert {r.level_symbols for r in rows} == {"own", "lang"}
    assert len({r.max_symbols for r in rows}) > 4
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality.quality_report(docs).join(labels, "doc_id").filter("NOT base_failed").groupBy("quality", "kept").count().collect()
    count = {(r.quality, r.kept): r["count"] for r in got}
    assert count.get((1, False), 0) <= 0.01 * count[1, True] and count.get((0, True), 0) <= 0.15 * count[0, False]


# mixing -----------------------------------------------------------------------------------------------------------
def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        level = (total - sum(capped.values())) / max(1e-9, sum(weight[s] for s in free))
        over = [s for s in free if weight[s] * level > 3 * sizes[s]]
        if not over:
            return {s: capped.get(s, weight[s] * level) for s in order}
        capped |= {s: 3 * sizes[s] for s in over}


@pytest.mark.parametrize("bucket", [7, 2000])
@pytest.mark.parametrize("which", ["sf", "edge"])
def test_mixing(spark, sf, edge, which, bucket, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket)
    docs = documents(spark, sf) if which == "sf" else edge
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count()
    sizes = Counter()
    for d in docs.collect():
        sizes[d.source] += len(WORD.findall(d.text or ""))
    want, taken = brute_targets(sizes), Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * (1 + want[r.source])
        assert 0 <= r.taken <= 3 * r.size and r.taken // r.size >= int(r.target / r.source_size + 1e-9) if r.size else r.taken == 0
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(2)).collect()))


def test_mixed_documents(spark, sf, edge, empty):
    docs = documents(spark, sf)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    taken = {r.doc_id: r.taken // r.size for r in mixing.mix(docs, cut_last=False).collect() if r.size}
    assert Counter(r.doc_id for r in out.collect()) == Counter({d: n for d, n in taken.items() if n})
    assert mixing.mixed_documents(edge).columns == edge.columns
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


# decontamination --------------------------------------------------------------------------------------------------
def brute_decontaminate(texts, items):
    windows = {}
    for item, t in items:
        w = BENCH_WORD.findall(lower(t))
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(item)
    out = {}
    for doc, t in texts:
        w = BENCH_WORD.findall(lower(t))
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (s := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= s
        out[doc] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit))
    return out


def test_decontamination(spark, sf):
    docs, bench = documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet")
    want = brute_decontaminate([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in queries.op4_decontamination(spark, sf).collect()}
    assert got == want and any(x[4] for x in want.values())


@pytest.mark.parametrize("block", [1 << 20, 40, 25])
def test_decontamination_edges(spark, edge, empty, block, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    monkeypatch.setattr(decontamination, "AT_ONCE", 2)
    texts = {r.doc_id: r.text for r in edge.collect()}
    long = texts[5].split()
    items = [(1, " ".join(long[3:20]).upper()), (2, None), (3, ""), (4, "one"), (5, "B C"), (6, "b, c"), (7, " ".join(long[10:22])), (8, "never seen words"), (9, "日本語")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontamination.report(edge, bench).collect()}
    assert got == brute_decontaminate(texts.items(), items)
    clean = decontamination.removed(edge, bench)
    assert clean.columns == edge.columns and clean.count() == edge.count()
    after = {r.doc_id: r for r in clean.collect()}
    for d, t in texts.items():
        if not got[d][4]:
            assert after[d].text == t
        else:
            assert len(after[d].text) < len(t) and after[d].n_chars == len(after[d].text)
    assert decontamination.report(empty, bench).count() == 0
    assert not any(r.contaminated for r in decontamination.report(edge, bench.limit(0)).collect())


def test_items_without_an_id(spark):
    docs = spark.createDataFrame([(1, "one two three"), (2, "two"), (3, "four")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "two"), (None, "three"), ("null", "two"), ("a", "four")], "item_id string, text string")
    got = {r.doc_id: (r.n_hit, r.n_items, r.items_sha256) for r in decontamination.report(docs, bench).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert got == {1: (2, 2, sha("null")), 2: (1, 2, sha("null")), 3: (1, 1, sha("a"))}


def test_fm_index_against_search():
    r = np.random.default_rng(1)
    runs = [r.integers(1, 5, r.integers(1, 40)) for _ in range(30)]
    text = np.concatenate([np.concatenate((x, [0])) for x in runs])
    starts = np.cumsum([0] + [len(x) + 1 for x in runs])[:-1]
    index = decontamination.FMIndex(text, starts)
    for n in (1, 2, 3, 6):
        table = np.zeros((50, 6), np.int64)
        table[:, 6 - n :] = r.integers(1, 6, (50, n))
        low, high = index.search(table)
        for row, a, b in zip(table, low, high):
            want = [i for i in range(len(text) - n + 1) if (text[i : i + n] == row[6 - n :]).all()]
            assert sorted(index.locate(np.arange(a, max(a, b)))) == want


# token files ------------------------------------------------------------------------------------------------------
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("size", [24 << 20, 30_000])
@pytest.mark.parametrize("which", ["sf", "edge"])
def test_token_files(spark, sf, edge, which, size, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "FILE_BYTES", size)
    docs = documents(spark, sf) if which == "sf" else edge
    plain, start, want = Tokenizer.from_file(tokenizer()), 0, []
    for d in sorted(docs.collect(), key=lambda d: d.doc_id):
        ids = plain.encode(d.text or "", add_special_tokens=False).ids + [2]
        want.append((d.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted(tuple(r) for r in packing.tokenise(docs, tokenizer()).collect())
    assert got == sorted(want)


def test_special_tokens_match_raw_text(spark):
    """Mixed case is plain text, wherever it stands; only the exact form is the special token."""
    from tokenizers import Tokenizer

    texts = ["<|ENDOFTEXT|>", "<|endoftext|>", "<|EndOfText|> and <|StartOfText|>", "A<|endoftext|>B<|ENDOFTEXT|>C", "X<|Y.Z<|startoftext|>", "<| endoftext|> <|", "It'S <|ENDOFTEXT|>'S", "plain AFTER it", "<", "<<|endoftext|>ÀB", "ÀB<|endOftext|>"]
    plain, start, want = Tokenizer.from_file(tokenizer()), 0, []
    for d, t in enumerate(texts):
        ids = plain.encode(t, add_special_tokens=False).ids + [2]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    assert sorted(tuple(r) for r in packing.tokenise(docs, tokenizer()).collect()) == want


@pytest.mark.parametrize("name, by_piece", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_ids_equal_the_library(name, by_piece):
    """Any text, by a tokenizer that can be cut at white space and by one that can't."""
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    plain, encoder, r = Tokenizer.from_file(path), packing.Encoder(path), random.Random(name)
    assert encoder.by_piece == by_piece
    bits = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|startoftext|>", "<|", "|>", "<", "it's", "IT'S", "'ll", "we'LL", "'", "''s", "abc", "ABC", "x", "12", "3", "é", "E\u0301", "\u0301", "ÀB", "Σ", "ΑΣ", "İ", "ß", "ǅ", "日本語", "\u00a0", "\u3000", "\u200b", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x0c", "\x85", "\x00", "\x1f", ".", "...", "!?", "-", "--", "_", "a_b", "a.b", "👍🏽", "\U0010ffff", "ﬁ", "①", "²", "ａ", "à" * 40, "q" * 300]
    texts = [None, ""] + ["".join(r.choice(bits) for _ in range(r.randint(1, 30))) for _ in range(1500)]
    for at in range(0, len(texts), 100):
        part = texts[at : at + 100]
        ids, n = encoder.encode(pa.array(part, pa.string()))
        ends = np.cumsum(n)
        for t, a, b in zip(part, ends - n, ends):
            assert ids[a:b].tolist() == plain.encode(t or "", add_special_tokens=False).ids + [2], repr(t)


def test_token_files_empty(empty, spark):
    assert packing.tokenise(empty, tokenizer()).count() == 0


@pytest.mark.parametrize("bits", [1, 5, 16, 17, 31])
def test_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, packing.BLOCK_IDS * 2 + 77).astype(np.uint32)
    assert (packing.unpack(packing.pack(ids[: 64 * 50], bits), bits) == ids[: 64 * 50]).all()
    f = packing.TokenFile(b"".join(packing.file_bytes(pa.array([3, None]), np.array([70, len(ids) - 70]), [ids[:100], ids[100:]], bits)))
    assert (f.ids(0, len(ids)) == ids).all() and (f.ids(4090, 4200) == ids[4090:4200]).all() and f.valid.tolist() == [1, 0]
