"""The dataset engine: functions, generation invariants, validation with faults, sinks, streaming."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from glyphmill import api
from glyphmill.constants import ACTION_WORDS, MANGA_FORBIDDEN_TERMS
from glyphmill.functions import draws, geometry, text
from glyphmill.operators import banks, content, layout, validate
from glyphmill.sources import coco, files, images


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_clamp_rounds_half_to_even_and_repairs(spark):
    rows = [(0.5, 2.5, 3.5, 4.5), (-9.0, -3.2, -1.0, 700.0), (640.0, 639.6, 640.2, 639.9), (10.0, 10.0, 5.0, 10.0)]
    df = spark.createDataFrame(rows, "x1 double, y1 double, x2 double, y2 double").select(geometry.clamp(F.struct("*"), 640, 640).alias("b"))

    def brute(b):
        x1, y1 = (min(max(round(v), 0), 639) for v in b[:2])
        x2, y2 = (min(max(round(v), 0), 640) for v in b[2:])
        return (x1, y1, x2 if x2 > x1 else min(x1 + 1, 640), y2 if y2 > y1 else min(y1 + 1, 640))

    assert [tuple(r.b) for r in df.collect()] == [brute(r) for r in rows]


def test_affine_contains_corners(spark):
    r = random.Random(1)
    rows = [(r.randrange(400), r.randrange(400), r.uniform(-2, 2), r.uniform(0.985, 1.02)) for _ in range(50)]
    df = spark.createDataFrame(rows, "x int, y int, a double, s double")
    m = geometry.affine(F.col("a"), F.col("s"), F.lit(3.0), F.lit(-2.0), 640, 640)
    out = df.select("*", geometry.transformed(geometry.box(F.col("x"), F.col("y"), F.col("x") + 90, F.col("y") + 20), m).alias("b")).collect()
    for r in out:
        al, be = r.s * math.cos(math.radians(r.a)), r.s * math.sin(math.radians(r.a))
        for px, py in ((r.x, r.y), (r.x + 90, r.y), (r.x, r.y + 20), (r.x + 90, r.y + 20)):
            qx = al * px + be * py + (1 - al) * 320 - be * 320 + 3
            qy = -be * px + al * py + be * 320 + (1 - al) * 320 - 2
            assert r.b.x1 - 1e-6 <= qx <= r.b.x2 + 1e-6 and r.b.y1 - 1e-6 <= qy <= r.b.y2 + 1e-6


def test_overlap_uses_smaller_area(spark):
    a, b = geometry.box(0, 0, 10, 10), geometry.box(5, 5, 7, 7)
    r = one(spark, geometry.overlap(a, b).alias("o"), geometry.overlap(a, geometry.box(20, 20, 30, 30)).alias("n"), geometry.max_pairwise_overlap(F.array(a, b, geometry.box(9, 9, 19, 19))).alias("m"))
    assert (r.o, r.n) == (1.0, 0.0) and r.m == 1.0


def brute_wrap(t, width, most):
    if not t:
        return []
    words, sep = (t.split(), " ") if " " in t else (list(t), "")
    lines, now = [], ""
    for w in words:
        trial = w if not now else now + sep + w
        if len(trial) <= width:
            now = trial
            continue
        if now:
            lines.append(now)
        now = w
        if len(lines) >= most - 1 and (lines or most == 1):
            break
    if now:
        lines.append(now)
    lines = lines[:most]
    if lines and len(lines[-1]) > width:
        last = lines[-1]
        base = last
        while len(base) > 1 and len(base + "...") > width:
            base = base[:-1]
        lines[-1] = base + "..." if base != last else base
    return lines


@pytest.mark.parametrize("most", [1, 2, 3, 5])
def test_wrap(spark, most):
    r = random.Random(most)
    texts = ["", "x", "short one", "averyveryverylongword", "a averyveryverylongword b", "漢字だけの文章がここに続く", "two  spaces\tand tabs here"]
    texts += [" ".join("w" * r.randint(1, 14) for _ in range(r.randint(1, 14))) for _ in range(60)]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", text.wrapped(F.col("t"), 12, most).alias("l")).orderBy("i").collect()
    assert [r.l for r in got] == [brute_wrap(t, 12, most) for t in texts]


def test_text_functions(spark):
    r = one(spark, text.strip(F.lit(" \t hi  \n")).alias("s"), text.shout(F.lit("run?!.")).alias("h"), text.escape_html(F.lit("<a & 'b' \"c\">")).alias("e"), text.braces(F.lit("x {a} y {b} z")).alias("b"), text.braces(F.lit("none")).alias("n"),
            text.cache_key(F.lit("manga"), F.lit(42), 5, "en", "fallback", F.lit(None)).alias("k"), text.clock(F.lit(3725)).alias("c"), text.clock(F.lit(65)).alias("m"), text.clock(F.lit(None).cast("int")).alias("u"))
    import hashlib

    key = json.dumps({"schema_version": "content_v5_rich_en_only_api_routes", "category": "manga", "seed": 42, "count": 5, "source_language": "en", "provider": "fallback", "model": None}, sort_keys=True)
    assert (r.s, r.h, r.e, r.b, r.n) == ("hi", "run!", "&lt;a &amp; &#x27;b&#x27; &quot;c&quot;&gt;", "{a} y {b}", None)
    assert r.k == hashlib.sha256(key.encode()).hexdigest()[:20] and (r.c, r.m, r.u) == ("1:02:05", "01:05", "--:--")


def test_markers_are_substrings(spark):
    words = ["Bangle", "bằm", "a quiet word", "đùng"]
    got = spark.createDataFrame([(w,) for w in words], "t string").select(content.has_action_word(F.col("t")).alias("x")).collect()
    assert [r.x for r in got] == [any(m in w.casefold() for m in ACTION_WORDS) for w in words]


def test_draws(spark):
    df = spark.range(2000).select(draws.draw(7, F.col("id"), "a").alias("d"), draws.between(2, 9, F.col("id"), "b").alias("b"), draws.unit(F.col("id"), "c").alias("u"))
    rows = df.collect()
    assert {r.d for r in rows} == set(range(7)) and {r.b for r in rows} == set(range(2, 10)) and abs(sum(r.u for r in rows) / 2000 - 0.5) < 0.03
    assert rows == df.repartition(5).orderBy("u").select("d", "b", "u").collect() or sorted(rows) == sorted(df.repartition(5).collect())


# content ----------------------------------------------------------------------------------------------------------
def test_blocks(spark):
    got = content.make_blocks(spark, "game", 3030, 5, provider="gemini").collect()
    assert [r.id for r in got] == [1, 2, 3, 4, 5] and len({r.text.casefold() for r in got}) == 5
    assert got[0].group_id == "game_group_01" and {r.source_language for r in got} == {"en"}
    rows = spark.createDataFrame([("s", 3030, "game")], "sample_id string, seed bigint, category string")
    p = content.payloads(rows, 5, "gemini").first()
    assert p.generated_by == "fallback" and p.api_provider == "gemini" and p.api_error.startswith("RuntimeError") and p.model == "gemini-2.0-flash"


def test_block_variety(spark):
    rows = content.samples(spark, 18, 9000)
    items = content.payloads(rows, 8).select(F.explode("items").alias("x")).select("x.*").collect()
    assert len(items) == 18 * 8 and len({r.text for r in items}) / len(items) > 0.78
    assert not any(m in r.text.casefold() or m in r.translated_text.casefold() for r in items for m in ACTION_WORDS)


def test_provider_items_are_normalised(spark):
    fetch = lambda category, seed, language: [{"text": " Hello there ", "translated_text": "Xin chào", "kind": "SHOUT"}, {"text": "BOOM now", "translated_text": "x", "kind": "shout"}, {"text": "", "translated_text": "x"}, {"text": "Odd kind", "translated_text": "Lạ", "kind": "zzz"}]
    rows = spark.createDataFrame([("s", 7, "manga")], "sample_id string, seed bigint, category string")
    p = content.payloads(rows, 4, "openai", fetch=fetch).first()
    assert p.generated_by == "openai" and p.api_error is None and len(p.items) == 4
    assert (p["items"][0].text, p["items"][0].kind) == ("Hello there", "shout") and p["items"][1].text == "Odd kind" and p["items"][1].kind in ("dialogue", "whisper", "shout", "narration")


def test_cache_is_used(spark):
    rows = content.samples(spark, 4, 5)
    first = content.payloads(rows, 5).cache()
    marked = first.withColumn("generated_by", F.lit("kept"))
    again = content.payloads(content.samples(spark, 6, 5), 5, cache=marked)
    assert sorted(r.generated_by for r in again.collect()) == ["fallback"] * 2 + ["kept"] * 4


def test_bad_options(spark, tmp_path):
    with pytest.raises(ValueError):
        api.generate_records(spark, 1, difficulty="hard")
    with pytest.raises(ValueError):
        api.generate_dataset(spark, str(tmp_path), 1, content_provider="x")
    with pytest.raises(ValueError):
        api.generate_dataset(spark, str(tmp_path), 1, game_renderer="x")
    with pytest.raises(FileNotFoundError):
        api.validate_dataset(spark, str(tmp_path))


# whole data sets --------------------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    out, events = tmp_path_factory.mktemp("data") / "set", []
    summary = api.generate_dataset(spark, str(out), 4, 42, progress=events.append, sample_files=True)
    return out, summary, events


def test_dataset(spark, made):
    out, summary, events = made
    assert summary["validation"]["error_count"] == 0 and summary["category_counts"] == {"game": 2, "manga": 2}
    assert summary["difficulty"] == "normal" and summary["blocks_per_sample"] == 5
    assert [e["phase"] for e in events][-2:] == ["validate", "done"] and events[-1]["validation_errors"] == 0
    assert json.loads((out / "summary.json").read_text())["validation"]["sample_count"] == 4
    assert len(list((out / "images").glob("*.png"))) == 4 and (out / "annotations/vlm/manga_000000.json").exists()
    chat = [json.loads(r.record) for r in files.read_jsonl(spark, str(out / "chat_vlm.jsonl")).orderBy("ord").collect()]
    vlm = {(v := json.loads(r.record))["id"]: v["output"] for r in files.read_jsonl(spark, str(out / "annotations/vlm.jsonl")).collect()}
    assert [c["id"] for c in chat] == ["manga_000000", "game_000001", "manga_000002", "game_000003"]
    assert all(json.loads(c["messages"][1]["content"]) == vlm[c["id"]] for c in chat)
    sizes = {r.name: (r.width, r.height) for r in images.sizes(spark, str(out / "images")).collect()}
    assert sizes["images/manga_000000.png"] == (1024, 1440) and sizes["images/game_000001.png"] == (640, 640)


def test_determinism_and_density(spark):
    rows = lambda **k: sorted(map(str, api.generate_records(spark, 4, 99, **k)[0].collect()))
    assert rows(augment=True) == rows(augment=True)
    plain, dense = (api.generate_records(spark, 8, 404, augment=False, difficulty=x)[0].collect() for x in ("normal", "dense"))
    assert sum(len(r.content) for r in dense) > sum(len(r.content) for r in plain)
    for r in [*plain, *dense]:
        assert [x.id for x in r.content] == list(range(1, len(r.content) + 1))
        for x in r.content:
            x1, y1, x2, y2 = x.bbox_2d
            assert 0 <= x1 < x2 <= r.width and 0 <= y1 < y2 <= r.height
        if r.category == "manga":
            assert not any(t in x.text.casefold() for x in r.content for t in MANGA_FORBIDDEN_TERMS)
            assert len({x.group_id for x in r.content}) >= 5
    assert len({r.metadata.scene_style for r in dense if r.category == "game"}) >= 2
    assert max(r.metadata.bubble_overlap_max for r in dense if r.category == "manga") <= 0.6


def test_tables_of_layouts():
    for difficulty, sizes in (("normal", layout.NORMAL_PANELS), ("dense", layout.DENSE_PANELS)):
        for k, n in enumerate(sizes):
            assert sum(r[0] == difficulty and r[1] == k for r in banks.panel_rows()) == n
    slots = banks.slot_rows()
    assert sum(r[1] == "hud" and r[0] == "dense" for r in slots) == 24 and all(0 <= r[4] < 640 and 0 <= r[5] < 640 for r in slots)


# validation -------------------------------------------------------------------------------------------------------
LINE = {"bbox_2d": [1, 2, 30, 40], "text": "hello", "translated_text": "chào"}


def check(spark, vlm=None, ocr=None, trans=None, canonical=None, width=100):
    good = {"category": "game", "content": [LINE]}
    dump = lambda x, d: x if isinstance(x, str) else json.dumps(d if x is None else x, ensure_ascii=False)
    row = (0, "s", "images/s.png", width, 100, dump(vlm, good), dump(ocr, [LINE]), dump(trans, [{"id": 1, **LINE}]), dump(canonical, {"category": "game", "content": [{**LINE, "source_language": "en", "kind": "menu"}]}))
    df = spark.createDataFrame([row], "sample_ord bigint, id string, image string, width int, height int, vlm string, ocr string, trans string, canonical string")
    return [r.message for r in validate.ordered(validate.sample_errors(df)).collect()]


def boxes(b):
    return [{**LINE, "bbox_2d": b}]


@pytest.mark.parametrize(
    "case, want",
    [
        ({}, []),
        ({"width": None}, ["s: missing image images/s.png"]),
        ({"ocr": boxes([1, 2, 3])}, ["s:ocr[1]: invalid bbox_2d [1, 2, 3]"]),
        ({"ocr": boxes([10.0, 2, 30, 40])}, None),
        ({"ocr": boxes([True, 2, 30, 40])}, []),
        ({"ocr": boxes([1, 2, 1, 40])}, ["s:ocr[1]: invalid bbox_2d [1, 2, 1, 40]"]),
        ({"ocr": boxes([1, 2, 101, 40])}, ["s:ocr[1]: invalid bbox_2d [1, 2, 101, 40]"]),
        ({"ocr": boxes([-1, 2, 30, 40])}, ["s:ocr[1]: invalid bbox_2d [-1, 2, 30, 40]"]),
        ({"ocr": boxes("abc")}, None),
        ({"ocr": boxes(None)}, ["s:ocr[1]: invalid bbox_2d None"]),
        ({"ocr": [{**LINE, "text": "  "}]}, ["s:ocr[1]: missing text"]),
        ({"ocr": [{**LINE, "text": None}]}, []),
        ({"vlm": {"category": "film", "content": [LINE]}}, ["s:vlm: category must be manga or game"]),
        ({"vlm": {"category": "game", "content": [{k: v for k, v in LINE.items() if k != "translated_text"}]}}, ["s:vlm:content[1]: missing translated_text"]),
        ({"vlm": {"category": "game", "content": [{**LINE, "translated_text": None}]}}, []),
        ({"vlm": [1]}, ["s:vlm: expected object", "s: output line counts differ"]),
        ({"vlm": {"category": "game", "content": 5}}, ["s:vlm: content must be list", "s: output line counts differ"]),
        ({"ocr": {"a": 1}}, ["s:ocr: expected list", "s: output line counts differ"]),
        ({"ocr": [7]}, ["s:ocr[1]: expected object"]),
        ({"trans": [{"text": "a", "translated_text": " "}]}, ["s:trans[1]: missing id", "s:trans[1]: missing translated_text"]),
        ({"trans": []}, ["s: output line counts differ"]),
        ({"canonical": {"category": "game", "content": [{**LINE, "kind": "sfx", "source_language": "en"}]}}, ["s:canonical:content[1]: sfx kind is not allowed in default dataset"]),
        ({"canonical": {"category": "game", "content": [{**LINE, "text": "a bangle", "source_language": "en"}]}}, ["s:canonical:content[1]: action/sfx word leaked into text"]),
        ({"canonical": {"category": "manga", "content": [{**LINE, "text": "a question", "source_language": "en"}]}}, ["s:canonical:content[1]: game term leaked into manga text"]),
        ({"canonical": {"category": "manga", "content": [{**LINE, "translated_text": "quest", "source_language": "en"}]}}, []),
        ({"canonical": {"category": "game", "content": [{**LINE, "source_language": "en"}, {**LINE}]}}, ["s:canonical: mixed source languages ['en', None]"]),
        ({"canonical": "not json"}, ["s:canonical: expected object"]),
    ],
)
def test_faults(spark, case, want):
    got = check(spark, **case)
    if want is None:
        assert len(got) == 1 and "invalid bbox_2d" in got[0]
    elif any("mixed" in w for w in want):
        assert len(got) == 1 and "mixed source languages" in got[0] and "'en'" in got[0] and "None" in got[0]
    else:
        assert got == want


def test_chat_faults(spark):
    vlm = {"category": "game", "content": [LINE]}
    ask = {"role": "user", "content": [{"type": "text", "text": "x"}]}
    answer = lambda body: {"role": "assistant", "content": body}
    swapped = json.dumps({"content": [dict(reversed(LINE.items()))], "category": "game"})
    records = [{"id": "a", "messages": [ask, answer(json.dumps(vlm))]}, {"id": "b", "messages": [ask]}, {"id": "c", "messages": [ask, answer("{oops")]}, {"id": "d", "messages": [ask, answer(json.dumps({**vlm, "category": "manga"}))]}, {"id": "e", "messages": [ask, answer(swapped)]}, {"id": "nofile", "messages": [ask, answer("{}")]}, {"id": "f", "messages": [ask, ask, ask]}]
    chat = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "chat_ord bigint, record string")
    views = spark.createDataFrame([(x, json.dumps(vlm)) for x in "abcdef"], "id string, vlm string")
    got = [r.message for r in validate.ordered(validate.chat_errors(chat, views)).collect()]
    assert got == ["b: chat must have user and assistant messages", "c: assistant content is not JSON", "d: chat assistant JSON does not match vlm output", "f: chat must have user and assistant messages"]


# sources and streaming --------------------------------------------------------------------------------------------
def test_coco(spark, tmp_path):
    doc = {"info": {}, "licenses": [], "categories": [{"id": 1, "name": "text", "supercategory": "none"}], "images": [{"id": 5, "file_name": "a.png", "height": 100, "width": 100, "date_captured": "2025-03-24T00:00:00"}],
           "annotations": [{"id": 9, "image_id": 5, "category_id": 1, "bbox": [1, 2.5, 10, 4], "area": 40, "iscrowd": 0}]}
    (tmp_path / "c.json").write_text(json.dumps(doc, indent=1))
    r = coco.read(spark, str(tmp_path / "c.json")).first()
    assert (r.bbox_2d, r.category, r.area_gap, r.file_name) == ([1, 2, 11, 6], "text", 0.0, "a.png")


def test_stream(spark, made, tmp_path):
    from glyphmill.streaming import watch

    out, _, _ = made
    stream, seen = watch.manifest_stream(spark, str(out / "manifest.jsonl")), []
    watch.progress(stream, 4, seen.append, str(tmp_path / "c1")).awaitTermination()
    assert seen[-1] == {"phase": "generate", "completed": 4, "total": 4}
    q = watch.running_counts(stream).writeStream.outputMode("complete").format("memory").queryName("running").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r.category, r.n_samples) for r in spark.table("running").collect()} == {("manga", 2), ("game", 2)}


def test_command_line(spark, made, capsys):
    from glyphmill import cli

    assert cli.main(["validate", str(made[0])]) == 0 and '"error_count": 0' in capsys.readouterr().out


# layout of pages, sample files -------------------------------------------------------------------------------------
def test_font_size_is_the_largest_that_wraps(spark):
    r = random.Random(5)
    rows = [(i, " ".join("w" * r.randint(1, 11) for _ in range(r.randint(1, 25))), r.randint(90, 400), r.randint(40, 260)) for i in range(60)] + [(60, "", 200, 100), (61, "漢字だけの文章" * 9, 260, 160)]
    df = spark.createDataFrame(rows, "i int, t string, w int, h int")
    got = df.select("i", draws.between(26, 38, "font", F.col("i")).alias("start"), layout.font_size(F.col("t"), F.col("w"), F.col("h"), "normal", F.col("i")).alias("size")).collect()

    def units(x):
        return sum(100 if ord(c) > 0x10FF else 56 for c in x)

    def fits(t, room, most):
        words, sep = (t.split(), " ") if " " in t else (list(t), "")
        lines, now = 0, ""
        for w in words:
            if units(w) > room:
                return False
            trial = now + sep + w if now else w
            if units(trial) <= room:
                now = trial
            else:
                lines, now = lines + 1, w
        return lines + bool(now) <= most

    for x in got:
        _, t, w, h = rows[x.i]
        sizes = [s for s in range(x.start, 17, -2) if fits(t, w * 100 // s, min(5, h // max(s + 7, 24)))]
        assert x["size"] == (sizes[0] if sizes else 18), rows[x.i]


def test_clear_rect_leaves_room(spark):
    panel, taken = geometry.box(100, 50, 500, 450), F.array(geometry.box(100, 50, 300, 250))
    got = spark.range(30).select(layout.clear_rect(panel, taken, layout.ART_TRIES, F.col("id")).alias("b")).collect()
    for r in got:
        assert 100 <= r.b.x1 < r.b.x2 <= 500 and 50 <= r.b.y1 < r.b.y2 <= 450
        wide, high = min(r.b.x2, 300) - r.b.x1, min(r.b.y2, 250) - r.b.y1
        assert max(wide, 0) * max(high, 0) <= 0.1 * (r.b.x2 - r.b.x1) * (r.b.y2 - r.b.y1)


def test_page_metadata(spark):
    rows = [r.metadata for r in api.generate_records(spark, 6, 5150, difficulty="dense")[0].collect()]
    manga, game = [m for m in rows if m.panel_art], [m for m in rows if not m.panel_art]
    assert len(manga) == len(game) == 3 and len({m.panel_layout for m in manga}) >= 2
    for m in manga:
        assert m.panel_art.art_count == m.panel_noise.panel_count >= 5 and m.panel_art.color_clutter_count > 0
        assert m.panel_art.styles == sorted(set(m.panel_art.styles)) and m.panel_art.color_palettes == sorted(set(m.panel_art.color_palettes))
        assert {"paper_grain", "edge_shadow"} <= set(m.panel_noise.patterns) and m.bubble_count > 0 and len(m.augmentation.matrix) == 6
        assert m.bubble_overlap_max <= 0.2
    assert {"screentone", "hatching", "dust_scratches"} & {p for m in manga for p in m.panel_noise.patterns}
    assert all(m.scene_actor_count > 0 for m in game)


def test_sample_files_are_validated(spark, made, tmp_path):
    """A data set of sample files alone: no JSON lines of views, canonical ones included."""
    import shutil

    out = tmp_path / "set"
    shutil.copytree(made[0], out)
    for view in files.VIEWS:
        shutil.rmtree(out / f"annotations/{view}.jsonl")
    got = api.validate_dataset(spark, str(out))
    assert got["error_count"] == 0 and got["sample_count"] == 4 and got["language_counts"] == made[1]["validation"]["language_counts"]
    ocr = out / "annotations/ocr/game_000001.json"
    ocr.write_text(json.dumps([{**x, "bbox_2d": [1.5, 2, 3, 4]} for x in json.loads(ocr.read_text())][:1]))
    (out / "annotations/trans/manga_000000.json").unlink()
    for crc in out.rglob(".*.crc"):
        crc.unlink()
    errors = api.validate_dataset(spark, str(out))["errors"]
    assert errors == ["manga_000000:trans: expected list", "manga_000000: output line counts differ", "game_000001:ocr[1]: invalid bbox_2d [1.5, 2, 3, 4]", "game_000001: output line counts differ"]


def test_append_keeps_lines(spark, tmp_path):
    rows = spark.createDataFrame([('{"id": 1}',)], "value string")
    files.write_jsonl(rows, "value", str(tmp_path / "x.jsonl"))
    files.write_jsonl(rows, "value", str(tmp_path / "x.jsonl"), append=True)
    assert files.read_jsonl(spark, str(tmp_path / "x.jsonl")).count() == 2


def test_provider_of_the_session(spark, tmp_path):
    spark.conf.set("glyphmill.content.provider", "nobody")
    try:
        with pytest.raises(ValueError):
            api.generate_dataset(spark, str(tmp_path), 1)
    finally:
        spark.conf.unset("glyphmill.content.provider")
