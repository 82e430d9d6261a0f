"""From blocks to placed lines: scene slots (game), panels and bubbles (manga), font sizes, wrapping, line boxes.

Everything is one row a block or line, joined to small constant tables; the one ordered step, placing bubbles that
avoid each other, is a fold over a page's few blocks inside its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import ACTORS, CANVAS, COIN_TEXTURES, DENSE_ACTORS, DENSE_PANELS, DENSE_STYLES, NORMAL_PANELS, NORMAL_STYLES, TEXTURES
from ..functions import draws as D
from ..functions import geometry as G
from ..functions import text as X
from . import banks

TRIES = {"normal": 32, "dense": 72}
ACCEPT = {"normal": 0.12, "dense": 0.18}
FONT = {"normal": (38, 26), "dense": (31, 21)}
SMALLEST, MOST_LINES = 18, 5
ART_TRIES, PROP_TRIES = 96, 36
ART_STYLES = ("portrait", "landscape", "still_life", "silhouette", "crowd")
PALETTES = ("dawn", "harbor", "moss", "ember")
#: Corners and edge middles of a panel, as halves of the free room to the right and down.
ANCHORS = ((0, 0), (1, 0), (2, 0), (2, 1), (2, 2), (1, 2), (0, 2), (0, 1))
ART = "struct<art_count:int,styles:array<string>,color_clutter_count:bigint,color_palettes:array<string>,overlap_max:double>"
NOISE = "struct<panel_count:int,patterns:array<string>>"
SLOTS = "difficulty string, style string, slot int, first int, x int, y int, width int, size int, max_lines int, role string"
PANELS = "difficulty string, layout int, panel int, x1 int, y1 int, x2 int, y2 int"


def units(text: Column) -> Column:
    """Width of a text in hundredths of its font size: 56 a character, 100 a full-width one."""
    wide = F.length(text) - F.length(F.regexp_replace(text, r"[ᄀ-ᇿ⺀-꓏가-힯豈-﫿＀-｠]", ""))
    return F.length(text) * 56 + wide * 44


def room(width: Column, size: Column) -> Column:
    return F.floor(width * 100 / size).cast("int")


def _first_line_ids(lines: DataFrame) -> DataFrame:
    order = Window.partitionBy("sample_id").orderBy("block", "line")
    return lines.withColumn("id", F.row_number().over(order))


def game_lines(blocks: DataFrame, difficulty: str) -> DataFrame:
    """Blocks meet slots by ordinal (blocks beyond the slots are dropped), plates override texts, lines are wrapped."""
    spark = blocks.sparkSession
    styles = list(DENSE_STYLES) if difficulty == "dense" else list(NORMAL_STYLES)
    slots = F.broadcast(spark.createDataFrame(banks.slot_rows(), SLOTS).filter(F.col("difficulty") == difficulty).drop("difficulty"))  # under 200 rows
    plates = F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip(("name", "name_vi", "title", "title_vi"), row)]) for row in banks.NAMEPLATES])
    seed = F.col("seed")
    styled = blocks.withColumn("style", D.choice(styles, seed, "style")).withColumn("variant", F.concat_ws("_", "style", D.choice(["a", "b", "c"], seed, "variant")))
    s = styled.join(slots, (styled.block == slots.slot) & (styled["style"] == slots["style"])).drop(slots["style"])
    jitter = lambda n, name: D.between(-n, n, seed, name, F.col("slot"))
    width, height = CANVAS["game"]
    if difficulty == "dense":
        s = s.withColumns({"x": F.greatest(F.lit(12), F.least(F.col("x") + jitter(8, "x"), F.lit(width - 34))).cast("int"), "y": F.greatest(F.lit(12), F.least(F.col("y") + jitter(6, "y"), F.lit(height - 26))).cast("int")})
    plate = F.element_at(plates, (D.draw(len(banks.NAMEPLATES), seed, "plate", F.floor(F.col("slot") / 3)) + 1).cast("int"))
    said = lambda side, own: F.when(F.col("role") == "name", plate[f"name{side}"]).when(F.col("role") == "title", plate[f"title{side}"]).otherwise(F.col(own))
    s = s.withColumns({"text": said("", "text"), "translated_text": said("_vi", "translated_text"), "kind": F.when(F.col("role").isNotNull(), "floating_label").otherwise(F.col("kind"))})
    limit = room(F.col("width"), F.col("size"))
    s = s.withColumn("lines", F.when(F.col("max_lines") == 2, X.wrapped(F.col("text"), limit, 2, units)).otherwise(X.wrapped(F.col("text"), limit, 4, units)))
    each = s.select("*", F.posexplode("lines").alias("line", "fragment"))
    top = F.col("y") + F.col("line") * (F.col("size") + 7)
    wide = F.greatest(F.floor(units(F.col("fragment")) * F.col("size") / 100), F.lit(1))
    meta = F.struct(F.lit("pillow").alias("renderer"), F.lit("game_scene").alias("template"), F.col("style").alias("scene_style"), F.col("variant").alias("scene_variant"), actors(F.col("style"), difficulty).alias("scene_actor_count"), F.lit(None).cast("int").alias("panel_layout"), F.lit(None).cast(NOISE).alias("panel_noise"), F.lit(None).cast(ART).alias("panel_art"), F.lit(None).cast("int").alias("bubble_count"), F.lit(None).cast("double").alias("bubble_overlap_max"))
    return each.select("sample_id", "seed", "category", "block", "line", "group_id", G.box(F.col("x"), top, F.col("x") + wide, top + F.col("size")).alias("b"), F.col("fragment").alias("text"), "translated_text", "source_language", "kind", meta.alias("meta"))


def bubbles(rects: Column, seed: Column, difficulty: str) -> Column:
    """A bubble for each block of a page, in order: the first try that overlaps the earlier ones little enough, else the
    try that overlaps least. rects: array of the blocks' panels."""
    tries = F.sequence(F.lit(0), F.lit(TRIES[difficulty] - 1))
    kind = "array<struct<x1:int,y1:int,x2:int,y2:int>>"

    def candidate(panel: Column, block: Column, t: Column) -> Column:
        pw, ph = panel["x2"] - panel["x1"], panel["y2"] - panel["y1"]
        w = F.least((pw * D.between(42, 62, seed, "bw", block, t if difficulty == "dense" else F.lit(0)) / 100).cast("int"), pw - 16)
        h = F.least((ph * D.between(28, 40, seed, "bh", block, t if difficulty == "dense" else F.lit(0)) / 100).cast("int"), ph - 16)
        free_x, free_y = F.greatest(pw - w - 16, F.lit(1)), F.greatest(ph - h - 16, F.lit(1))
        if difficulty == "dense":  # the anchors first, from a drawn one on; then anywhere
            at = F.pmod(t + D.draw(len(ANCHORS), seed, "anchor", block), F.lit(len(ANCHORS))).cast("int")
            halves = F.get(F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y")) for a, b in ANCHORS]), at)
            some = lambda free, half, name: F.when(t < len(ANCHORS), F.floor((free - 1) * half / 2)).otherwise(D.draw(free, seed, name, block, t)).cast("int")
            x, y = panel["x1"] + 8 + some(free_x, halves["x"], "bx"), panel["y1"] + 8 + some(free_y, halves["y"], "by")
        else:  # the quarters of the panel by turns
            zone = F.pmod(t + D.draw(4, seed, "zone", block), F.lit(4))
            some = lambda free, second, name: (F.floor(free / 2) * second.cast("int") + D.draw(F.ceil(free / 2), seed, name, block, t)).cast("int")
            x, y = panel["x1"] + 8 + some(free_x, zone % 2 == 1, "bx"), panel["y1"] + 8 + some(free_y, zone >= 2, "by")
        return G.box(x.cast("int"), y.cast("int"), (x + w).cast("int"), (y + h).cast("int"))

    def place(got: Column, panel: Column) -> Column:
        scored = F.transform(tries, lambda t: F.struct(candidate(panel, F.size(got), t).alias("b"), t.alias("t")))
        scored = F.transform(scored, lambda c: F.struct(G.max_overlap(c["b"], got).alias("o"), c["t"].alias("t"), c["b"].alias("b")))
        best = F.array_min(F.transform(scored, lambda c: F.struct(F.when(c["o"] <= ACCEPT[difficulty], 0.0).otherwise(c["o"]).alias("o"), c["t"].alias("t"), c["b"].alias("b"))))
        return F.concat(got, F.array(best["b"]))

    return F.aggregate(rects, F.array().cast(kind), place)


def font_size(text: Column, width: Column, height: Column, difficulty: str, *parts) -> Column:
    """The largest size, from a drawn one down by two, at which the text wrapped fits in five lines and the height, no
    word being wider than a line; else the smallest."""
    high, low = FONT[difficulty]
    sizes = F.sequence(D.between(low, high, "font", *parts).cast("int"), F.lit(SMALLEST), F.lit(-2))
    widest = F.coalesce(F.array_max(F.transform(X.tokens(text), lambda w: units(w))), F.lit(0))
    fits = lambda s: F.size(X.broken(text, room(width, s), MOST_LINES + 2, units)) <= F.least(F.lit(MOST_LINES), F.floor(height / F.greatest(s + 7, F.lit(24))))
    return F.coalesce(F.get(F.filter(sizes, lambda s: F.when(widest <= room(width, s), fits(s)).otherwise(False)), 0), F.lit(SMALLEST))


def actors(style: Column, difficulty: str) -> Column:
    table = ACTORS | (DENSE_ACTORS if difficulty == "dense" else {})
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), style), F.lit(1))


def clear_rect(panel: Column, taken: Column, tries: int, *parts) -> Column:
    """Of the drawn rectangles in a panel the one that overlaps the taken ones least, less a twentieth of its share of
    the panel; the first of equals."""
    pw, ph = panel["x2"] - panel["x1"], panel["y2"] - panel["y1"]
    part = lambda whole, name, t: F.floor(whole * D.between(30, 60, name, *parts, t) / 100).cast("int")
    sizes = F.transform(F.sequence(F.lit(0), F.lit(tries - 1)), lambda t: F.struct(t.alias("t"), part(pw, "rw", t).alias("w"), part(ph, "rh", t).alias("h")))
    at = lambda low, free, name, t: (low + D.draw(free + 1, name, *parts, t)).cast("int")
    corners = F.transform(sizes, lambda s: F.struct(s["t"].alias("t"), s["w"].alias("w"), s["h"].alias("h"), at(panel["x1"], pw - s["w"], "rx", s["t"]).alias("x"), at(panel["y1"], ph - s["h"], "ry", s["t"]).alias("y")))
    rects = F.transform(corners, lambda c: F.struct(c["t"].alias("t"), G.box(c["x"], c["y"], c["x"] + c["w"], c["y"] + c["h"]).alias("b")))
    scored = F.transform(rects, lambda r: F.struct(F.round(G.max_overlap(r["b"], taken) - 0.05 * G.area(r["b"]) / G.area(panel), 9).alias("score"), r["t"].alias("t"), r["b"].alias("b")))
    return F.array_min(scored)["b"]


def panel_noise(panels: Column, seed: Column) -> Column:
    """Number of panels, and the sorted set of their textures: some always, others by a coin for each panel."""
    each = lambda i: F.concat(F.array(*[F.lit(x) for x in TEXTURES]), F.filter(F.array(*[F.when(D.draw(100, seed, x, i) < 45, x) for x in COIN_TEXTURES]), lambda x: x.isNotNull()))
    return F.struct(panels.alias("panel_count"), F.array_sort(F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), panels - 1), each)))).alias("patterns"))


def panel_art(panels: Column, bubbles: Column, seed: Column) -> Column:
    """A picture for each panel where the bubbles leave room: sorted sets of styles (in turn) and palettes (drawn), the
    number of coloured props, and the largest overlap with a bubble."""
    n, turn = F.size(panels), D.draw(len(ART_STYLES), seed, "art")
    pick = lambda names, at: F.get(F.array(*[F.lit(x) for x in names]), at.cast("int"))
    several = lambda f: F.array_sort(F.array_distinct(F.transform(panels, lambda p, i: f(i))))
    rects = F.transform(panels, lambda p, i: clear_rect(p, bubbles, ART_TRIES, seed, i))
    clutter = F.aggregate(F.transform(panels, lambda p, i: D.between(1, 4, seed, "props", i)), F.lit(0).cast("bigint"), lambda a, x: a + x)
    overlap = F.bround(F.array_max(F.transform(rects, lambda r: G.max_overlap(r, bubbles))), 4)
    return F.struct(n.alias("art_count"), several(lambda i: pick(ART_STYLES, F.pmod(i + turn, F.lit(len(ART_STYLES))))).alias("styles"), clutter.alias("color_clutter_count"), several(lambda i: pick(PALETTES, D.draw(len(PALETTES), seed, "palette", i))).alias("color_palettes"), overlap.alias("overlap_max"))


def zipped(boxes: Column, lines: Column) -> Column:
    """Boxes and lines that have the same place; what the longer of the two has beyond is dropped."""
    n = F.least(F.size(boxes), F.size(lines))
    return F.transform(F.slice(boxes, F.lit(1), n), lambda b, i: F.struct(i.alias("place"), b.alias("box"), F.get(lines, i).alias("line")))


def manga_lines(blocks: DataFrame, difficulty: str) -> DataFrame:
    """Blocks go round the panels of a drawn layout; bubbles are placed page by page; lines are centred in them."""
    spark = blocks.sparkSession
    sizes = DENSE_PANELS if difficulty == "dense" else NORMAL_PANELS
    panels = spark.createDataFrame(banks.panel_rows(), PANELS).filter(F.col("difficulty") == difficulty)
    layouts = F.broadcast(panels.groupBy("layout").agg(F.array_sort(F.collect_list(F.struct("panel", G.box(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")).alias("rect")))).alias("panels")))
    pages = blocks.groupBy("sample_id", "seed", "category").agg(F.array_sort(F.collect_list(F.struct("block", "group_id", "text", "translated_text", "source_language", "kind"))).alias("items"))
    pages = pages.withColumn("layout", D.draw(len(sizes), F.col("seed"), "layout").cast("int")).join(layouts, "layout")
    rects = F.transform("items", lambda x, i: F.get("panels", F.pmod(i, F.size("panels")))["rect"])
    pages = pages.withColumn("rects", rects).withColumn("bubbles", bubbles(F.col("rects"), F.col("seed"), difficulty))
    kept = ["panel_noise", "panel_art", "bubble_count"]
    pages = pages.withColumns({"overlap": F.bround(G.max_pairwise_overlap(F.col("bubbles")), 4), "bubble_count": F.size("bubbles"), "panel_noise": panel_noise(F.size("panels"), F.col("seed")), "panel_art": panel_art(F.transform("panels", lambda p: p["rect"]), F.col("bubbles"), F.col("seed"))})
    each = pages.select("sample_id", "seed", "category", "layout", "overlap", *kept, F.explode(F.arrays_zip("items", "bubbles")).alias("z")).select("sample_id", "seed", "category", "layout", "overlap", *kept, "z.items.*", F.col("z.bubbles").alias("bubble"))
    inner, tall = F.col("bubble.x2") - F.col("bubble.x1") - 20, F.col("bubble.y2") - F.col("bubble.y1") - 16
    each = each.withColumn("size", font_size(F.col("text"), inner, tall, difficulty, F.col("seed"), F.col("block")))
    lines = F.when(F.col("size") == SMALLEST, X.wrapped(F.col("text"), room(inner, F.col("size")), 4, units)).otherwise(X.wrapped(F.col("text"), room(inner, F.col("size")), 5, units))
    each = each.withColumn("lines", lines).withColumn("n", F.size("lines")).select("*", F.posexplode("lines").alias("line", "fragment"))
    step = F.greatest(F.col("size") + 7, F.lit(24))
    wide = F.greatest(F.floor(units(F.col("fragment")) * F.col("size") / 100), F.lit(1))
    x = F.floor((F.col("bubble.x1") + F.col("bubble.x2") - wide) / 2)
    y = F.floor((F.col("bubble.y1") + F.col("bubble.y2") - F.col("n") * step) / 2) + F.col("line") * step
    meta = F.struct(F.lit("manga").alias("renderer"), F.lit("manga_page").alias("template"), F.lit(None).cast("string").alias("scene_style"), F.lit(None).cast("string").alias("scene_variant"), F.lit(None).cast("int").alias("scene_actor_count"), F.col("layout").alias("panel_layout"), "panel_noise", "panel_art", "bubble_count", F.col("overlap").alias("bubble_overlap_max"))
    return each.select("sample_id", "seed", "category", "block", "line", "group_id", G.box(x, y, x + wide, y + F.col("size")).alias("b"), F.col("fragment").alias("text"), "translated_text", "source_language", "kind", meta.alias("meta"))


def lines(blocks: DataFrame, difficulty: str) -> DataFrame:
    """All lines with their box clamped to the canvas and their id in emission order."""
    game = game_lines(blocks.filter("category = 'game'"), difficulty)
    manga = manga_lines(blocks.filter("category = 'manga'"), difficulty)
    width = F.when(F.col("category") == "manga", CANVAS["manga"][0]).otherwise(CANVAS["game"][0])
    height = F.when(F.col("category") == "manga", CANVAS["manga"][1]).otherwise(CANVAS["game"][1])
    out = manga.unionByName(game).withColumns({"width": width, "height": height})
    return _first_line_ids(out.withColumn("b", G.clamp(F.col("b"), F.col("width"), F.col("height"))))
