"""The engine's operators as queries over the driver's tables, each with its SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import ACTORS, COIN_TEXTURES, DENSE_ACTORS, KIND_CYCLE, KIND_WEIGHTS, KINDS, SEED_STEP, TEXTURES
from ..functions import draws as D
from ..functions import geometry as G
from ..functions import text as T
from ..operators import banks
from ..operators import content as C
from ..operators import layout as L
from ..operators import validate as W
from ..operators import views as V
from ..streaming import watch as S

QUERIES: dict = {}
SQL: dict[str, str] = {}
BIG = "bigint"
MARKERS = ("ung", "clown", "idiot", "qué")
TERMS = ("quest", "tion ", "hp ", "licensed")
SEED = 1337
WRAP = 28
LANGS = ("en", "ja", "zh")


def query(sql: str):
    def add(f):
        name = f.__name__
        QUERIES[name], SQL[name] = f, sql
        return f

    return add


def read(spark: SparkSession, d: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{table}.parquet")


def _wide(spark: SparkSession) -> int:
    """Partitions for work that goes with the rows of small files, which would be a task or two."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * spark.sparkContext.defaultParallelism)


def values(rows) -> str:
    quote = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    return ", ".join("(" + ", ".join(map(quote, r)) + ")" for r in rows)


def sql_draw(n, *parts) -> str:
    return f"((('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8))::BIGINT) % {n})"


CATEGORY_SQL = "CASE WHEN doc_id % 2 = 0 THEN 'manga' ELSE 'game' END"
#: A box for each part, with many half pixels and some faults.
BOX_SQL = "p_size * 13.5 - 60 AS x1, (p_partkey % 97) * 10.5 - 40 AS y1, p_size * 13.5 - 60 + (p_partkey % 13) * 22.5 AS x2, (p_partkey % 97) * 10.5 - 40 + (p_partkey % 7) * 30.5 AS y2"


def boxes(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part")
    x, y = F.col("p_size") * 13.5 - 60, (F.col("p_partkey") % 97) * 10.5 - 40
    return p.select("p_partkey", "p_size", "p_brand", G.box(x, y, x + (F.col("p_partkey") % 13) * 22.5, y + (F.col("p_partkey") % 7) * 30.5).alias("b"))


#: Whole boxes, never empty, for overlaps.
WHOLE_SQL = "(p_partkey * 37 % 500)::INT AS x1, (p_partkey * 53 % 500)::INT AS y1, (p_partkey * 37 % 500 + 20 + p_partkey % 90)::INT AS x2, (p_partkey * 53 % 500 + 20 + p_partkey % 70)::INT AS y2"


def whole_boxes(spark: SparkSession, d: str, *more: str) -> DataFrame:
    k = F.col("p_partkey")
    i = lambda c: c.cast("int")
    return read(spark, d, "part").select("p_partkey", "p_size", "p_brand", *more, G.box(i(k * 37 % 500), i(k * 53 % 500), i(k * 37 % 500 + 20 + k % 90), i(k * 53 % 500 + 20 + k % 70)).alias("b"))


@query(f"SELECT doc_id, {SEED} + doc_id * {SEED_STEP} AS seed, {CATEGORY_SQL} AS category, printf('%s_%06d', {CATEGORY_SQL}, doc_id) AS sample_id, (['en','ja','zh'])[({SEED} + doc_id * {SEED_STEP}) % 3 + 1] AS language FROM documents")
def q01_sample_scaffold(spark, d):
    return C.scaffold(read(spark, d, "documents").select(F.col("doc_id").alias("index")), SEED, LANGS).withColumnRenamed("index", "doc_id")


@query(f"""SELECT doc_id, substr(sha256('{{"category": "' || {CATEGORY_SQL} || '", "count": 5, "model": ' || CASE WHEN doc_id % 3 = 0 THEN 'null' ELSE '"m' || (doc_id % 3) || '"' END || ', "provider": "fallback", "schema_version": "content_v5_rich_en_only_api_routes", "seed": ' || ({SEED} + doc_id * {SEED_STEP}) || ', "source_language": "en"}}'), 1, 20) AS cache_key FROM documents""")
def q02_content_cache_key(spark, d):
    s = C.scaffold(read(spark, d, "documents").select(F.col("doc_id").alias("index")), SEED, ("en",))
    model = F.when(F.col("index") % 3 != 0, F.concat(F.lit("m"), (F.col("index") % 3).cast("string")))
    return s.select(F.col("index").alias("doc_id"), T.cache_key(F.col("category"), F.col("seed"), 5, "en", "fallback", model).alias("cache_key"))


_KINDS_SQL = f"""
    SELECT doc_id, cycle * 5 + row_number() OVER (PARTITION BY doc_id, cycle ORDER BY md5(concat_ws('|', ({SEED} + doc_id * {SEED_STEP})::VARCHAR, 'kinds', cycle::VARCHAR, pos::VARCHAR))) - 1 AS slot,
           CASE WHEN doc_id % 2 = 0 THEN {list(KIND_CYCLE['manga'])}[pos + 1] ELSE {list(KIND_CYCLE['game'])}[pos + 1] END AS kind
    FROM documents, range(2) a(cycle), range(5) b(pos)"""


@query(f"SELECT doc_id, slot::BIGINT AS slot, kind FROM ({_KINDS_SQL}) WHERE slot < 8")
def q03_kind_sequence(spark, d):
    s = C.scaffold(read(spark, d, "documents").select(F.col("doc_id").alias("index")), SEED, ("en",))
    return s.select(F.col("index").alias("doc_id"), F.posexplode(C.kind_sequence(F.col("category"), F.col("seed"), 8)).alias("slot", "kind")).withColumn("slot", F.col("slot").cast(BIG))


@query(f"""
    WITH blocks AS (SELECT *, {SEED} + doc_id * {SEED_STEP} AS seed FROM ({_KINDS_SQL}) WHERE slot < 5),
    templates(kind, t, source, target) AS (VALUES {values(banks.template_rows())}),
    counts AS (SELECT kind, count(*) AS n FROM templates GROUP BY kind),
    bank(name, i, value, value_vi) AS (VALUES {values(banks.bank_rows())}),
    picked AS (
        SELECT b.*, t.source, t.target,
               {sql_draw(len(banks.BANKS['hero']), "seed::VARCHAR", "'hero'", "slot::VARCHAR")} AS hero, {sql_draw(len(banks.BANKS['place']), "seed::VARCHAR", "'place'", "slot::VARCHAR")} AS place,
               {sql_draw(163, "seed::VARCHAR", "'current'", "slot::VARCHAR")} + 18 AS current, {sql_draw(131, "seed::VARCHAR", "'max'", "slot::VARCHAR")} + 190 AS top,
               {sql_draw(47, "seed::VARCHAR", "'level'", "slot::VARCHAR")} + 2 AS level, {sql_draw(8, "seed::VARCHAR", "'combo'", "slot::VARCHAR")} + 2 AS combo
        FROM blocks b JOIN counts c USING (kind) JOIN templates t ON t.kind = b.kind AND t.t = {sql_draw("c.n", "seed::VARCHAR", "'template'", "slot::VARCHAR")}
    )
    SELECT doc_id, slot::BIGINT AS slot, kind,
           replace(replace(replace(replace(replace(replace(source, '{{hero}}', h.value), '{{place}}', p.value), '{{current}}', current::VARCHAR), '{{max}}', top::VARCHAR), '{{level}}', level::VARCHAR), '{{combo}}', combo::VARCHAR) AS text,
           replace(replace(replace(replace(replace(replace(target, '{{hero}}', h.value_vi), '{{place}}', p.value_vi), '{{current}}', current::VARCHAR), '{{max}}', top::VARCHAR), '{{level}}', level::VARCHAR), '{{combo}}', combo::VARCHAR) AS translated_text
    FROM picked JOIN bank h ON h.name = 'hero' AND h.i = hero JOIN bank p ON p.name = 'place' AND p.i = place""")
def q04_compose_blocks(spark, d):
    s = C.scaffold(read(spark, d, "documents").select(F.col("doc_id").alias("index")), SEED, ("en",))
    slots = s.select(F.col("index").alias("doc_id"), "seed", F.posexplode(C.kind_sequence(F.col("category"), F.col("seed"), 5)).alias("slot", "kind"))
    return C.composed(slots, F.col("slot")).select("doc_id", F.col("slot").cast(BIG).alias("slot"), "kind", "text", "translated_text")


_LINES_SQL = "SELECT doc_id, i AS line_no, string_split(text, chr(10))[i] AS line FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)"


def _lines(spark, d):
    return read(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("p", "line")).select("doc_id", (F.col("p") + 1).cast(BIG).alias("line_no"), "line")


@query("SELECT doc_id, line_no, n_markers FROM (SELECT doc_id, line_no, " + " + ".join(f"contains(lower(line), '{m}')::BIGINT" for m in MARKERS) + f" AS n_markers FROM ({_LINES_SQL})) WHERE n_markers > 0")
def q05_action_word_lint(spark, d):
    return _lines(spark, d).select("doc_id", "line_no", T.count_markers(F.lower("line"), MARKERS).alias("n_markers")).filter("n_markers > 0")


@query("SELECT doc_id FROM documents WHERE doc_id % 2 = 0 AND (" + " OR ".join(f"contains(lower(text), '{t}')" for t in TERMS) + ")")
def q06_domain_term_leak(spark, d):
    return read(spark, d, "documents").filter((F.col("doc_id") % 2 == 0) & T.contains_any(F.lower("text"), TERMS)).select("doc_id")


@query("SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY source, lower(text) ORDER BY doc_id) AS r FROM documents) WHERE r = 1")
def q07_dedupe_first_wins(spark, d):
    # The digest stands for the text in the shuffle; min() is combined before it.
    docs = read(spark, d, "documents").select("source", F.sha2(F.lower("text").cast("binary"), 256).alias("key"), "doc_id")
    return docs.groupBy("source", "key").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "source")


def _clamped_sql(width: int, height: int) -> str:
    r = lambda c, low, high: f"least(greatest(round_even({c}, 0)::INT, {low}), {high})"
    return f"""SELECT p_partkey, p_brand, p_size, c1 AS x1, r1 AS y1, CASE WHEN c2 <= c1 THEN least(c1 + 1, {width}) ELSE c2 END AS x2, CASE WHEN r2 <= r1 THEN least(r1 + 1, {height}) ELSE r2 END AS y2
        FROM (SELECT p_partkey, p_brand, p_size, {r('x1', 0, width - 1)} AS c1, {r('y1', 0, height - 1)} AS r1, {r('x2', 0, width)} AS c2, {r('y2', 0, height)} AS r2 FROM (SELECT *, {BOX_SQL} FROM part))"""


@query(f"SELECT p_partkey, x1, y1, x2, y2 FROM ({_clamped_sql(640, 640)})")
def q08_bbox_clamp(spark, d):
    return boxes(spark, d).select("p_partkey", G.clamp(F.col("b"), 640, 640).alias("c")).select("p_partkey", "c.*")


@query(f"SELECT CASE WHEN p_partkey % 2 = 0 THEN 'manga' ELSE 'game' END AS category, count(*) AS n, count(*) FILTER (x1 >= 0 AND x1 < x2 AND x2 <= 640 AND y1 >= 0 AND y1 < y2 AND y2 <= 640) AS n_valid FROM (SELECT *, {BOX_SQL} FROM part) GROUP BY 1")
def q09_bbox_validity(spark, d):
    ok = G.valid(F.col("b"), 640, 640)
    return boxes(spark, d).groupBy(F.when(F.col("p_partkey") % 2 == 0, "manga").otherwise("game").alias("category")).agg(F.count("*").alias("n"), F.count_if(ok).alias("n_valid"))


_A, _S, _TX, _TY = "(p_partkey % 41 - 20) / 10.0::DOUBLE", "(985 + p_partkey % 36) / 1000.0::DOUBLE", "(p_partkey % 17 - 8)", "(p_size % 17 - 8)"


@query(f"""
    WITH m AS (SELECT p_partkey, x1, y1, x2, y2, s * cos(radians(a)) AS ca, s * sin(radians(a)) AS sa, {_TX} AS tx, {_TY} AS ty FROM (SELECT *, {_A} AS a, {_S} AS s, {WHOLE_SQL} FROM part)),
    k AS (SELECT *, (1 - ca) * 320 - sa * 320 + tx AS e, sa * 320 + (1 - ca) * 320 + ty AS f FROM m)
    SELECT p_partkey, round(least(ca * x1 + sa * y1, ca * x1 + sa * y2, ca * x2 + sa * y1, ca * x2 + sa * y2) + e, 4) AS x1, round(least(ca * y1 - sa * x1, ca * y1 - sa * x2, ca * y2 - sa * x1, ca * y2 - sa * x2) + f, 4) AS y1,
           round(greatest(ca * x1 + sa * y1, ca * x1 + sa * y2, ca * x2 + sa * y1, ca * x2 + sa * y2) + e, 4) AS x2, round(greatest(ca * y1 - sa * x1, ca * y1 - sa * x2, ca * y2 - sa * x1, ca * y2 - sa * x2) + f, 4) AS y2 FROM k""")
def q10_affine_bbox(spark, d):
    k = F.col("p_partkey")
    m = G.affine((k % 41 - 20) / 10.0, (985 + k % 36) / 1000.0, k % 17 - 8, F.col("p_size") % 17 - 8, 640, 640)
    moved = whole_boxes(spark, d).select("p_partkey", G.transformed(F.col("b"), m).alias("t"))
    return moved.select("p_partkey", *[F.round(F.col("t")[n], 4).alias(n) for n in G.FIELDS])


_PAIR_SQL = f"""WITH b AS (SELECT p_partkey, p_size, {WHOLE_SQL} FROM part)
    SELECT a.p_size, a.p_partkey AS a_key, c.p_partkey AS b_key,
           greatest(least(a.x2, c.x2) - greatest(a.x1, c.x1), 0) * greatest(least(a.y2, c.y2) - greatest(a.y1, c.y1), 0) / least((a.x2 - a.x1) * (a.y2 - a.y1), (c.x2 - c.x1) * (c.y2 - c.y1))::DOUBLE AS o
    FROM b a JOIN b c ON a.p_size = c.p_size AND a.p_partkey < c.p_partkey"""


#: Boxes of a page meet in cells of about the largest box's size, so only neighbours are compared; the boxes of a full
#: cell meet in blocks of about so many, which is all that a task holds of it at once.
CELL, BLOCK = 110, 2048


def _page_boxes(spark, d):
    return whole_boxes(spark, d).filter("p_partkey IS NOT NULL AND p_size IS NOT NULL").select("p_size", F.col("p_partkey").alias("k"), "b.*")


def _pairs(b):
    """Pairs of boxes (p_size, k, x1, y1, x2, y2) of a page that overlap, each once: in the cell that holds the corner of
    what they share. Work goes with the pairs, not with the bytes, so the partitions are many and aren't coalesced."""
    spark, cell = b.sparkSession, ["p_size", "cx", "cy"]
    parts = _wide(spark)
    spread = lambda low, high: F.explode(F.sequence(F.floor(F.col(low) / CELL), F.floor((F.col(high) - 1) / CELL)))
    b = b.filter("x1 < x2 AND y1 < y2").withColumn("cx", spread("x1", "x2")).withColumn("cy", spread("y1", "y2"))
    b = b.join(b.groupBy(*cell).agg(F.ceil(F.count("*") / BLOCK).alias("blocks")), cell)
    a = b.withColumn("block", F.pmod(F.xxhash64("k"), "blocks")).repartition(parts, *cell, "block").alias("a")
    c = b.withColumn("block", F.explode(F.sequence(F.lit(0).cast(BIG), F.col("blocks") - 1))).repartition(parts, *cell, "block").alias("c")
    same = (F.col("a.k") < F.col("c.k")) & F.expr(" AND ".join(f"a.{x} = c.{x}" for x in (*cell, "block")))
    meet = F.expr("a.x1 < c.x2 AND c.x1 < a.x2 AND a.y1 < c.y2 AND c.y1 < a.y2")
    corner = (F.floor(F.greatest("a.x1", "c.x1") / CELL) == F.col("a.cx")) & (F.floor(F.greatest("a.y1", "c.y1") / CELL) == F.col("a.cy"))
    side = lambda n: G.box(*[F.col(f"{n}.{x}") for x in G.FIELDS])
    # A merge join holds the rows of its right side that have one key: a block.
    return c.join(a.hint("merge"), same & meet & corner).select("a.p_size", F.col("a.k").alias("a_key"), F.col("c.k").alias("b_key"), G.overlap(side("a"), side("c")).alias("o"))


@query(f"SELECT a_key, b_key, round(o, 6) AS overlap FROM ({_PAIR_SQL}) WHERE o > 0")
def q11_overlap_pairs(spark, d):
    return _pairs(_page_boxes(spark, d)).select("a_key", "b_key", F.round("o", 6).alias("overlap"))


def _settled(b):
    """Distinct boxes of pages with the least and greatest key of each, and the pages of which it is known that a box lies
    in another one: equal boxes, or two from one corner of which one is at least as wide and as high."""
    boxes = b.groupBy("p_size", *G.FIELDS).agg(F.min("k").alias("k"), F.max("k").alias("last"))
    beside = Window.partitionBy("p_size", "x1", "y1").orderBy("x2", "y2")
    within = (F.col("k") < F.col("last")) | F.coalesce(F.lag("y2").over(beside) <= F.col("y2"), F.lit(False))
    return boxes, boxes.filter("x1 < x2 AND y1 < y2").withColumn("within", within).filter("within").select("p_size").distinct()


@query(f"SELECT p_size, round(max(o), 6) AS max_overlap FROM ({_PAIR_SQL}) GROUP BY p_size")
def q12_max_overlap_per_page(spark, d):
    """A box in another one is an overlap of 1, which nothing exceeds. Only pages without such boxes need their pairs, and
    they are small: distinct boxes that all differ in corner or shape."""
    b = _page_boxes(spark, d)
    pages = b.groupBy("p_size").agg(F.min("k").alias("low"), F.max("k").alias("high")).filter("low < high").select("p_size")
    boxes, full = _settled(b)
    rest = _pairs(boxes.drop("last").join(full, "p_size", "left_anti")).groupBy("p_size").agg(F.round(F.max("o"), 6).alias("max_overlap"))
    found = full.select("p_size", F.lit(1.0).alias("max_overlap")).unionByName(rest)
    return pages.join(found, "p_size", "left").select("p_size", F.coalesce("max_overlap", F.lit(0.0)).alias("max_overlap"))


@query(f"SELECT p_brand, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2 FROM (SELECT p_brand, {WHOLE_SQL} FROM part) GROUP BY p_brand")
def q13_union_box(spark, d):
    return whole_boxes(spark, d).groupBy("p_brand").agg(*G.union(F.col("b")))


@query(f"SELECT p_partkey, fx AS x1, fy AS y1, fx + x2 - x1 AS x2, fy + y2 - y1 AS y2 FROM (SELECT *, greatest(110, least(x1, 390 - (x2 - x1))) AS fx, greatest(110, least(y1, 390 - (y2 - y1))) AS fy FROM (SELECT p_partkey, {WHOLE_SQL} FROM part))")
def q14_fit_rect(spark, d):
    return whole_boxes(spark, d).select("p_partkey", G.fit_in(F.col("b"), G.box(100, 100, 400, 400), 10).alias("f")).select("p_partkey", "f.*")


SLOT_ROWS = [(i, 40 + 90 * i, 30 + 60 * (i % 3), "plate" if i % 2 else None) for i in range(5)]
PLATE_ROWS = [("plate", "Warden", "Người canh giữ")]


@query(f"""WITH slots(i, x, y, plate) AS (VALUES {values(SLOT_ROWS)}), plates(plate, name, name_vi) AS (VALUES {values(PLATE_ROWS)})
    SELECT conv_id, turn, x::INT AS x, y::INT AS y, coalesce(name, text) AS shown FROM conversations JOIN slots ON turn = i LEFT JOIN plates USING (plate)""")
def q15_slot_join(spark, d):
    slots = spark.createDataFrame(SLOT_ROWS, "i bigint, x int, y int, plate string")
    plates = spark.createDataFrame(PLATE_ROWS, "plate string, name string, name_vi string")
    fixed = F.broadcast(slots.join(plates, "plate", "left"))  # five rows
    return read(spark, d, "conversations").join(fixed, F.col("turn") == F.col("i")).select("conv_id", "turn", "x", "y", F.coalesce("name", "text").alias("shown"))


@query("SELECT conv_id, turn, turn % (4 + conv_id % 3) AS panel, (turn % (4 + conv_id % 3)) * 120 AS x FROM conversations")
def q16_panel_round_robin(spark, d):
    c = read(spark, d, "conversations")
    layouts = F.broadcast(spark.range(7).select(F.col("id").alias("panel"), (F.col("id") * 120).alias("x")))  # seven rows
    return c.withColumn("panel", F.pmod("turn", 4 + F.col("conv_id") % 3)).join(layouts, "panel").select("conv_id", "turn", "panel", "x")


@query(f"SELECT doc_id, line_no, length(line)::BIGINT AS n_chars, md5(line) AS digest FROM ({_LINES_SQL})")
def q17_line_explode(spark, d):
    return _lines(spark, d).select("doc_id", "line_no", F.length("line").cast(BIG).alias("n_chars"), F.md5(F.col("line").cast("binary")).alias("digest"))


def _wrap_sql(width: int, most: int) -> str:
    full = max(1, most - 1)
    return f"""
    WITH w AS (SELECT conv_id, turn, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS words FROM conversations WHERE contains(text, ' ')),
    f AS (SELECT conv_id, turn, string_split(list_reduce(words, lambda s, t: CASE WHEN length(s) - length(replace(s, chr(10), '')) >= {full} THEN s
              WHEN length(string_split(s, chr(10))[-1]) + 1 + length(t) <= {width} THEN s || ' ' || t ELSE s || chr(10) || t END), chr(10))[1:{most}] AS lines FROM w WHERE len(words) > 0),
    e AS (SELECT *, lines[-1] AS last FROM f)
    SELECT conv_id, turn, len(lines)::BIGINT AS n_lines, array_to_string(lines[1:-2] || [CASE WHEN length(last) <= {width} OR length(last) <= 1 THEN last ELSE left(last, greatest(1, least(length(last) - 1, {width} - 3))::BIGINT) || '...' END], chr(10)) AS wrapped FROM e"""


@query(_wrap_sql(WRAP, 5))
def q18_wrap_text(spark, d):
    lines = read(spark, d, "conversations").filter(F.contains("text", F.lit(" "))).select("conv_id", "turn", T.wrapped(F.col("text"), WRAP, 5).alias("lines"))
    return lines.filter(F.size("lines") > 0).select("conv_id", "turn", F.size("lines").cast(BIG).alias("n_lines"), F.array_join("lines", "\n").alias("wrapped"))


def _conversation_lines(spark, d):
    c = read(spark, d, "conversations")
    bbox = F.array((10 + F.col("turn") * 5).cast("int"), F.lit(20), (200 + F.col("turn")).cast("int"), F.lit(60))
    line = F.struct((F.col("turn") + 1).cast("int").alias("id"), F.concat(F.lit("g_"), F.col("turn").cast("string")).alias("group_id"), bbox.alias("bbox_2d"), F.col("text"), F.upper("role").alias("translated_text"), F.lit("en").alias("source_language"), F.col("role").alias("kind"))
    return c.groupBy("conv_id").agg(F.array_sort(F.collect_list(line)).alias("content")).withColumn("category", F.when(F.col("conv_id") % 2 == 0, "manga").otherwise("game"))


_BOX = "[(10 + turn * 5)::INT, 20, (200 + turn)::INT, 60]"
_CAT = "CASE WHEN conv_id % 2 = 0 THEN 'manga' ELSE 'game' END"
_VLM = f"to_json({{'category': {_CAT}, 'content': list({{'bbox_2d': {_BOX}, 'text': text, 'translated_text': upper(role)}} ORDER BY turn)}})::VARCHAR"


@query(f"SELECT conv_id, {_VLM} AS vlm FROM conversations GROUP BY conv_id")
def q19_vlm_view(spark, d):
    return _conversation_lines(spark, d).select("conv_id", V.json(V.vlm()).alias("vlm"))


@query(f"SELECT conv_id, to_json(list({{'bbox_2d': {_BOX}, 'text': text}} ORDER BY turn))::VARCHAR AS ocr FROM conversations GROUP BY conv_id")
def q20_ocr_view(spark, d):
    return _conversation_lines(spark, d).select("conv_id", V.json(V.ocr()).alias("ocr"))


@query("SELECT conv_id, to_json(list({'id': (turn + 1)::INT, 'text': text, 'translated_text': upper(role)} ORDER BY turn))::VARCHAR AS trans FROM conversations GROUP BY conv_id")
def q21_trans_view(spark, d):
    return _conversation_lines(spark, d).select("conv_id", V.json(V.trans()).alias("trans"))


@query(f"""SELECT conv_id, '{{"id":' || to_json(printf('conv_%06d', conv_id))::VARCHAR || ',"image":' || to_json(printf('images/conv_%06d.png', conv_id))::VARCHAR || ',"messages":[{{"role":"user","content":[{{"type":"image","image":' || to_json(printf('images/conv_%06d.png', conv_id))::VARCHAR
    || '}},{{"type":"text","text":' || to_json('{V.INSTRUCTION}')::VARCHAR || '}}]}},{{"role":"assistant","content":' || to_json({_VLM})::VARCHAR || '}}]}}' AS chat FROM conversations GROUP BY conv_id""")
def q22_chat_record(spark, d):
    rows = _conversation_lines(spark, d).withColumn("id", F.format_string("conv_%06d", "conv_id")).withColumn("image_file", F.concat(F.lit("images/"), F.col("id"), F.lit(".png")))
    return rows.select("conv_id", V.chat().alias("chat"))


@query("SELECT conv_id, count(*) AS n_messages, count(*) = 2 AND max(role) FILTER (turn = 1) = 'assistant' AS valid FROM conversations GROUP BY conv_id")
def q23_chat_validity(spark, d):
    c = read(spark, d, "conversations").groupBy("conv_id").agg(F.count("*").alias("n_messages"), F.max(F.when(F.col("turn") == 1, F.col("role"))).alias("second"))
    return c.select("conv_id", "n_messages", ((F.col("n_messages") == 2) & (F.col("second") == "assistant")).alias("valid"))


@query(f"""SELECT d.doc_id, printf('%s_%06d', {CATEGORY_SQL.replace('doc_id', 'd.doc_id')}, d.doc_id) AS id, len(string_split(text, chr(10)))::BIGINT AS line_count, lang AS languages, coalesce('q' || quality || 't' || toxic, 'None') AS renderer,
    printf('annotations/vlm/%s_%06d.json', {CATEGORY_SQL.replace('doc_id', 'd.doc_id')}, d.doc_id) AS vlm_path FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def q24_manifest(spark, d):
    docs, labels = read(spark, d, "documents"), read(spark, d, "labels")
    renderer = F.coalesce(F.concat(F.lit("q"), F.col("quality").cast("string"), F.lit("t"), F.col("toxic").cast("string")), F.lit("None"))
    slim = docs.select("doc_id", "lang", F.size(F.split("text", "\n", -1)).cast(BIG).alias("line_count"))  # texts stay out of the shuffle
    out = slim.join(labels, "doc_id", "left").withColumn("id", C.sample_id(C.category_of(F.col("doc_id")), F.col("doc_id")))
    return out.select("doc_id", "id", "line_count", F.col("lang").alias("languages"), renderer.alias("renderer"), F.concat(F.lit("annotations/vlm/"), F.col("id"), F.lit(".json")).alias("vlm_path"))


@query(f"SELECT {CATEGORY_SQL} AS category, count(*) AS n FROM documents GROUP BY 1")
def q25_category_counts(spark, d):
    return read(spark, d, "documents").groupBy(C.category_of(F.col("doc_id")).alias("category")).agg(F.count("*").alias("n"))


@query("SELECT coalesce(lang, 'unknown') AS language, sum(len(string_split(text, chr(10))))::BIGINT AS n_lines FROM documents GROUP BY 1")
def q26_language_counts(spark, d):
    docs = read(spark, d, "documents").select(F.coalesce("lang", F.lit("unknown")).alias("language"), F.size(F.split("text", "\n", -1)).alias("n"))
    return docs.groupBy("language").agg(F.sum("n").cast(BIG).alias("n_lines"))


@query("SELECT coalesce(source, 'None') AS renderer, count(*) AS n FROM documents GROUP BY 1")
def q27_renderer_counts(spark, d):
    return read(spark, d, "documents").groupBy(F.coalesce("source", F.lit("None")).alias("renderer")).agg(F.count("*").alias("n"))


@query("SELECT source, count(DISTINCT coalesce(lang, '<none>')) AS n_languages, count(DISTINCT coalesce(lang, '<none>')) > 1 AS mixed, string_agg(DISTINCT coalesce(lang, '<none>'), ',' ORDER BY coalesce(lang, '<none>')) AS languages FROM documents GROUP BY source")
def q28_mixed_language(spark, d):
    seen = F.collect_set(F.coalesce("lang", F.lit("<none>")))  # a handful of languages; partial sets before the shuffle
    out = read(spark, d, "documents").groupBy("source").agg(F.sort_array(seen).alias("s"))
    return out.select("source", F.size("s").cast(BIG).alias("n_languages"), (F.size("s") > 1).alias("mixed"), F.array_join("s", ",").alias("languages"))


@query("SELECT d.doc_id, len(string_split(d.text, chr(10)))::BIGINT AS n_vlm, (strlen(p.html) % 12)::BIGINT AS n_ocr, l.quality::BIGINT + 5 AS n_trans, NOT (len(string_split(d.text, chr(10))) = strlen(p.html) % 12 AND len(string_split(d.text, chr(10))) = l.quality + 5) AS differ FROM documents d JOIN pages p ON d.doc_id = p.page_id JOIN labels l ON d.doc_id = l.doc_id")
def q29_cross_view_counts(spark, d):
    vlm = read(spark, d, "documents").select("doc_id", F.size(F.split("text", "\n", -1)).cast(BIG).alias("n_vlm"))
    ocr = read(spark, d, "pages").select(F.col("page_id").alias("doc_id"), (F.octet_length("html") % 12).cast(BIG).alias("n_ocr"))
    trans = read(spark, d, "labels").select("doc_id", (F.col("quality").cast(BIG) + 5).alias("n_trans"))
    out = vlm.join(ocr, "doc_id").join(trans, "doc_id")
    return out.withColumn("differ", ~((F.col("n_vlm") == F.col("n_ocr")) & (F.col("n_vlm") == F.col("n_trans"))))


@query("SELECT d.doc_id, d.doc_id || ': missing image images/' || d.doc_id || '.png' AS message FROM documents d ANTI JOIN labels l ON d.doc_id = l.doc_id")
def q30_missing_image(spark, d):
    missing = read(spark, d, "documents").select("doc_id").join(read(spark, d, "labels").select("doc_id"), "doc_id", "left_anti")
    name = F.col("doc_id").cast("string")
    return missing.select("doc_id", F.concat(name, F.lit(": missing image images/"), name, F.lit(".png")).alias("message"))


@query("SELECT lang, round(count(DISTINCT lower(text)) / count(*), 6) AS unique_ratio FROM documents GROUP BY lang")
def q31_unique_ratio(spark, d):
    docs = read(spark, d, "documents").select("lang", F.sha2(F.lower("text").cast("binary"), 256).alias("key"))
    per = docs.groupBy("lang", "key").agg(F.count("*").alias("n"))  # first per text, so that no language is one task
    return per.groupBy("lang").agg(F.round(F.count("*") / F.sum("n"), 6).alias("unique_ratio"))


@query("SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id)::BIGINT AS completed, count(*) OVER ()::BIGINT AS total FROM events")
def q32_progress_running(spark, d):
    # Two levels: hours are counted first, rows are ordered within their hour only.
    e = read(spark, d, "events").select("event_id", "ts", F.date_trunc("hour", "ts").alias("hour"))
    hours = e.groupBy("hour").agg(F.count("*").alias("n"))
    whole = Window.orderBy("hour")  # one row an hour
    offsets = hours.select(F.col("hour").alias("h"), (F.sum("n").over(whole) - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy()).alias("total"))
    ranked = e.withColumn("r", F.row_number().over(Window.partitionBy("hour").orderBy("ts", "event_id")))
    return ranked.join(offsets, ranked.hour.eqNullSafe(offsets.h)).select("event_id", "ts", (F.col("before") + F.col("r")).cast(BIG).alias("completed"), F.col("total").cast(BIG).alias("total"))


@query("SELECT page_id, length(e)::BIGINT AS n_chars, md5(e) AS digest FROM (SELECT page_id, replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;') AS e FROM pages)")
def q33_html_escape(spark, d):
    e = T.escape_html(F.col("html"))
    return read(spark, d, "pages").select("page_id", F.length(e).cast(BIG).alias("n_chars"), F.md5(e.cast("binary")).alias("digest"))


@query("SELECT event_id, payload, (payload::JSON ->> 'k')::BIGINT AS k FROM (SELECT event_id, regexp_extract('reply: ```json ' || props || ' ``` end', '(?s)\\{.*\\}', 0) AS payload FROM events)")
def q34_json_extract_braces(spark, d):
    said = F.concat(F.lit("reply: ```json "), F.col("props"), F.lit(" ``` end"))
    e = read(spark, d, "events").select("event_id", T.braces(said).alias("payload"))
    return e.select("event_id", "payload", F.get_json_object("payload", "$.k").cast(BIG).alias("k"))


@query("SELECT doc_id, md5(regexp_replace(text, '[.!?]+$', '') || '!') AS digest FROM documents")
def q35_shout_restyle(spark, d):
    return read(spark, d, "documents").select("doc_id", F.md5(T.shout(F.col("text")).cast("binary")).alias("digest"))


@query("SELECT l_orderkey, arg_min(l_linenumber, {'p': l_extendedprice, 'n': l_linenumber}) AS chosen, min(l_extendedprice) AS score FROM lineitem GROUP BY l_orderkey")
def q36_arg_min_candidate(spark, d):
    best = F.min_by("l_linenumber", F.struct("l_extendedprice", "l_linenumber"))
    return read(spark, d, "lineitem").groupBy("l_orderkey").agg(best.alias("chosen"), F.min("l_extendedprice").alias("score"))


@query("SELECT l_orderkey, count(DISTINCT l_suppkey) AS n_groups, count(DISTINCT l_suppkey) > 3 AS dense, bool_and(l_quantity > 1) AS all_ok FROM lineitem GROUP BY l_orderkey")
def q37_distinct_groups(spark, d):
    per = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count_distinct("l_suppkey").alias("n_groups"), F.bool_and(F.col("l_quantity") > 1).alias("all_ok"))
    return per.select("l_orderkey", "n_groups", (F.col("n_groups") > 3).alias("dense"), "all_ok")


@query("""WITH have AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id),
    library AS (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS i FROM benchmark),
    ranked AS (SELECT h.conv_id, h.n, l.item_id, row_number() OVER (PARTITION BY h.conv_id ORDER BY md5(concat_ws('|', h.conv_id::VARCHAR, l.item_id::VARCHAR))) AS r FROM have h, library l)
    SELECT conv_id, 'own' AS origin, turn AS item FROM conversations UNION ALL SELECT conv_id, 'library', item_id FROM ranked WHERE r <= 8 - n""")
def q38_top_up_union(spark, d):
    """Each conversation is topped up to eight items by a sample without replacement of all benchmark items: a row an
    item that could be wanted would be all pairs, so each conversation draws from the library's array, which is one row."""
    own = read(spark, d, "conversations")
    have = own.groupBy("conv_id").agg(F.count("*").alias("n")).filter("n < 8")
    library = read(spark, d, "benchmark").agg(F.collect_list("item_id").alias("library"))
    ranked = F.array_sort(F.transform("library", lambda i: F.struct(F.md5(F.concat_ws("|", F.col("conv_id").cast("string"), i.cast("string")).cast("binary")).alias("k"), i.alias("item"))))
    short = have.withColumn("one", F.lit(1)).join(F.broadcast(library.withColumn("one", F.lit(1))), "one")
    more = short.select("conv_id", F.lit("library").alias("origin"), F.explode(F.transform(F.slice(ranked, F.lit(1), (8 - F.col("n")).cast("int")), lambda s: s["item"])).alias("item"))
    return own.select("conv_id", F.lit("own").alias("origin"), F.col("turn").alias("item")).unionByName(more)


@query("SELECT count(*) AS sample_count, (SELECT '{' || string_agg('\"' || lang || '\":' || n, ',' ORDER BY lang) || '}' FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang)) AS language_counts FROM documents")
def q39_summary_map(spark, d):
    per = read(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("n"))
    ordered = F.array_sort(F.collect_list(F.struct("lang", "n")))
    return per.agg(F.sum("n").cast(BIG).alias("sample_count"), F.to_json(F.map_from_entries(ordered)).alias("language_counts"))


@query(f"""WITH faults AS (
        SELECT doc_id, 1 AS phase, 1 AS view_ord, 0 AS item, doc_id || ':vlm: category must be manga or game' AS message FROM documents WHERE doc_id % 11 = 0
        UNION ALL SELECT doc_id, 1, 2, line_no, doc_id || ':ocr[' || line_no || ']: missing text' FROM ({_LINES_SQL}) WHERE trim(line) = ''
        UNION ALL SELECT d.doc_id, 2, 5, 0, d.doc_id || ': chat must have user and assistant messages' FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality = 0)
    SELECT row_number() OVER (PARTITION BY phase, doc_id ORDER BY view_ord, item, message)::BIGINT AS place, phase::INT AS phase, doc_id, message FROM faults""")
def q40_error_report(spark, d):
    docs, name = read(spark, d, "documents"), F.col("doc_id").cast("string")
    row = lambda phase, view, item, message: ["doc_id", F.lit(phase).alias("phase"), F.lit(view).alias("view_ord"), item.cast(BIG).alias("item"), message.alias("message")]
    vlm = docs.filter("doc_id % 11 = 0").select(*row(1, 1, F.lit(0), F.concat(name, F.lit(":vlm: category must be manga or game"))))
    ocr = _lines(spark, d).filter(F.trim("line") == "").select(*row(1, 2, F.col("line_no"), F.concat(name, F.lit(":ocr["), F.col("line_no").cast("string"), F.lit("]: missing text"))))
    bad = docs.select("doc_id").join(read(spark, d, "labels").filter("quality = 0").select("doc_id"), "doc_id")
    chat = bad.select(*row(2, 5, F.lit(0), F.concat(name, F.lit(": chat must have user and assistant messages"))))
    order = Window.partitionBy("phase", "doc_id").orderBy("view_ord", "item", "message")
    return vlm.unionByName(ocr).unionByName(chat).select(F.row_number().over(order).cast(BIG).alias("place"), "phase", "doc_id", "message")


@query("SELECT c_custkey, lower(upper(c_name || ' ÀÉß')) AS folded, c_mktsegment AS stripped, c_acctbal < 0 AS is_blank FROM customer")
def q41_fold_strip(spark, d):
    """Case folding, and white space of any script off both ends."""
    c = read(spark, d, "customer")
    around = F.concat(F.lit("\u00a0 \t"), F.col("c_mktsegment"), F.lit("\u3000\n\u0085"))
    return c.select("c_custkey", T.fold(F.concat("c_name", F.lit(" ÀÉß"))).alias("folded"), T.strip(around).alias("stripped"), T.blank(F.when(F.col("c_acctbal") < 0, "\u2003 ").otherwise(F.col("c_name"))).alias("is_blank"))


@query("""SELECT o_orderkey, CASE WHEN s IS NULL OR s < 0 THEN '--:--' WHEN s >= 3600 THEN printf('%d:%02d:%02d', s // 3600, s % 3600 // 60, s % 60) ELSE printf('%02d:%02d', s // 60, s % 60) END AS clock
    FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 10 = 1 THEN -1 ELSE floor(o_totalprice / 9)::BIGINT END AS s FROM orders)""")
def q42_clock(spark, d):
    s = F.when(F.col("o_orderkey") % 10 == 0, None).when(F.col("o_orderkey") % 10 == 1, -1).otherwise(F.floor(F.col("o_totalprice") / 9))
    return read(spark, d, "orders").select("o_orderkey", T.clock(s).alias("clock"))


_PAGE_SQL = f"SELECT p_partkey, p_partkey // 8 AS page, {WHOLE_SQL} FROM part"


@query(f"""WITH b AS ({_PAGE_SQL}), o AS (
        SELECT a.page, a.p_partkey AS k, CASE WHEN least((a.x2 - a.x1) * (a.y2 - a.y1), (c.x2 - c.x1) * (c.y2 - c.y1)) > 0 THEN greatest(least(a.x2, c.x2) - greatest(a.x1, c.x1), 0) * greatest(least(a.y2, c.y2) - greatest(a.y1, c.y1), 0)
               / least((a.x2 - a.x1) * (a.y2 - a.y1), (c.x2 - c.x1) * (c.y2 - c.y1))::DOUBLE ELSE 0 END AS o FROM b a JOIN b c ON a.page = c.page AND a.p_partkey < c.p_partkey),
    f AS (SELECT page, min(p_partkey) AS k FROM b GROUP BY page)
    SELECT f.page, round(coalesce(max(o), 0), 6) AS any_two, round(coalesce(max(o) FILTER (o.k = f.k), 0), 6) AS first_and_others FROM f LEFT JOIN o ON o.page = f.page GROUP BY f.page""")
def q43_overlap_in_sets(spark, d):
    """Pages of eight boxes: the largest overlap of any two, and of the first with the others."""
    page = whole_boxes(spark, d).groupBy(F.floor(F.col("p_partkey") / 8).alias("page")).agg(F.array_sort(F.collect_list(F.struct("p_partkey", "b"))).alias("s"))
    boxes = page.select("page", F.transform("s", lambda x: x["b"]).alias("boxes"))
    return boxes.select("page", F.round(G.max_pairwise_overlap(F.col("boxes")), 6).alias("any_two"), F.round(G.max_overlap(F.get("boxes", 0), F.slice("boxes", 2, 8)), 6).alias("first_and_others"))


def _records(spark, d):
    """Conversations as samples, with the columns that the views read."""
    r = _conversation_lines(spark, d).withColumns({"id": F.concat("category", F.lit("_"), F.col("conv_id").cast("string")), "width": F.lit(640), "height": F.lit(480)})
    return r.withColumns({"image_file": F.concat(F.lit("images/"), F.col("id"), F.lit(".png")), "metadata": F.struct(F.lit("pillow").alias("renderer"), F.size("content").alias("rendered_line_count"))})


_ID = f"{_CAT} || '_' || conv_id"
_LINE = f"{{'id': (turn + 1)::INT, 'group_id': 'g_' || turn, 'bbox_2d': {_BOX}, 'text': text, 'translated_text': upper(role), 'source_language': 'en', 'kind': role}}"


@query(f"""SELECT conv_id, to_json({{'id': any_value({_ID}), 'category': any_value({_CAT}), 'image': {{'file_name': 'images/' || any_value({_ID}) || '.png', 'width': 640, 'height': 480}},
    'content': list({_LINE} ORDER BY turn), 'metadata': {{'renderer': 'pillow', 'rendered_line_count': count(*)}}}})::VARCHAR AS canonical FROM conversations GROUP BY conv_id""")
def q44_canonical_view(spark, d):
    return _records(spark, d).select("conv_id", V.json(V.canonical()).alias("canonical"))


@query(f"""SELECT conv_id, to_json({{'id': any_value({_ID}), 'image': 'images/' || any_value({_ID}) || '.png', 'output': list({{'id': (turn + 1)::INT, 'text': text, 'translated_text': upper(role)}} ORDER BY turn)}})::VARCHAR AS wrapped,
    to_json({{'canonical': 'annotations/canonical/' || any_value({_ID}) || '.json', 'vlm': 'annotations/vlm/' || any_value({_ID}) || '.json', 'ocr': 'annotations/ocr/' || any_value({_ID}) || '.json', 'trans': 'annotations/trans/' || any_value({_ID}) || '.json'}})::VARCHAR AS paths
    FROM conversations GROUP BY conv_id""")
def q45_wrapped_view(spark, d):
    return _records(spark, d).select("conv_id", V.json(V.wrapped(V.trans())).alias("wrapped"), V.json(V.paths()).alias("paths"))


@query(f"""WITH c AS (SELECT DISTINCT conv_id, {_ID} AS id FROM conversations)
    SELECT conv_id, 2 AS phase, id || CASE conv_id % 5 WHEN 1 THEN ': chat must have user and assistant messages' WHEN 2 THEN ': assistant content is not JSON' ELSE ': chat assistant JSON does not match vlm output' END AS message
    FROM c WHERE conv_id % 5 IN (1, 2) OR conv_id % 5 = 3 AND conv_id % 7 <> 0""")
def q46_chat_errors(spark, d):
    """Chat records with faults planted by their number; a sample without a view is none."""
    r = _records(spark, d)
    whole = V.chat()
    record = F.when(F.col("conv_id") % 5 == 1, F.concat(F.lit('{"messages": [], "id": "'), F.col("id"), F.lit('"}'))).when(F.col("conv_id") % 5 == 2, F.concat(F.lit('{"id": "'), F.col("id"), F.lit('", "messages": [{}, {"content": "not JSON"}]}')))
    record = record.when(F.col("conv_id") % 5 == 3, F.concat(F.lit('{"id": "'), F.col("id"), F.lit('", "messages": [{}, {"content": "{}"}]}'))).otherwise(whole)
    found = W.chat_errors(r.select(F.col("conv_id").alias("chat_ord"), record.alias("record")), r.filter("conv_id % 7 <> 0").select("id", V.json(V.vlm()).alias("vlm")))
    return found.select(F.col("sample_ord").alias("conv_id"), "phase", "message")


@query(f"""WITH b AS (SELECT p_partkey AS k, 'p_' || p_partkey AS id, p_name, {WHOLE_SQL} FROM part), s AS (
        SELECT *, CASE WHEN k % 7 = 0 THEN 'comic' ELSE 'game' END AS category, CASE WHEN k % 6 = 0 THEN x1 ELSE x2 END AS right_, CASE WHEN k % 8 = 0 THEN ' ' ELSE p_name END AS said FROM b),
    e AS (SELECT *, '[' || x1 || ', ' || y1 || ', ' || right_ || ', ' || y2 || ']' AS box, (right_ > x1 AND right_ <= 560 AND y2 <= 560) AS fits FROM s)
    SELECT k, 0 AS view_ord, 0 AS item, id || ': missing image images/' || id || '.png' AS message FROM e WHERE k % 9 = 0
    UNION ALL SELECT k, 1, 0, id || ':vlm: category must be manga or game' FROM e WHERE k % 9 <> 0 AND k % 7 = 0
    UNION ALL SELECT k, 1, 1, id || ':vlm:content[1]: invalid bbox_2d ' || box FROM e WHERE k % 9 <> 0 AND NOT fits
    UNION ALL SELECT k, 1, 1, id || ':vlm:content[1]: missing translated_text' FROM e WHERE k % 9 <> 0 AND k % 8 = 0
    UNION ALL SELECT k, 2, 1, id || ':ocr[1]: invalid bbox_2d ' || box FROM e WHERE k % 9 <> 0 AND k % 11 <> 0 AND NOT fits
    UNION ALL SELECT k, 3, 1, id || ':trans[1]: missing translated_text' FROM e WHERE k % 9 <> 0 AND k % 8 = 0
    UNION ALL SELECT k, 4, 0, id || ':canonical: mixed source languages [''en'', ''ja'']' FROM e WHERE k % 9 <> 0 AND k % 13 = 0
    UNION ALL SELECT k, 5, 0, id || ': output line counts differ' FROM e WHERE k % 9 <> 0 AND k % 11 = 0""")
def q47_sample_errors(spark, d):
    """Samples of one line with faults planted by their number: no image, category, box, blank translation, count, language."""
    k, b = F.col("p_partkey"), F.col("b")
    # Parts are a few file splits only, and each row has four documents to make and check.
    s = whole_boxes(spark, d, "p_name").select("p_partkey", "b", "p_name").repartition(_wide(spark))
    box = F.array(b["x1"], b["y1"], F.when(k % 6 == 0, b["x1"]).otherwise(b["x2"]), b["y2"]).alias("bbox_2d")
    text, said = F.col("p_name").alias("text"), F.when(k % 8 == 0, " ").otherwise(F.col("p_name")).alias("translated_text")
    category = F.when(k % 7 == 0, "comic").otherwise("game").alias("category")
    vlm = F.to_json(F.struct(category, F.array(F.struct(box, text, said)).alias("content")))
    ocr = F.when(k % 11 == 0, "[]").otherwise(F.to_json(F.array(F.struct(box, text))))
    trans = F.to_json(F.array(F.struct(F.lit(1).alias("id"), text, said)))
    line = lambda language: F.struct(text, F.lit("x").alias("translated_text"), language.alias("source_language"), F.lit("hud").alias("kind"))
    canonical = F.to_json(F.struct(F.lit("game").alias("category"), F.array(line(F.lit("en")), line(F.when(k % 13 == 0, "ja").otherwise("en"))).alias("content")))
    name = F.concat(F.lit("p_"), k.cast("string"))
    size = F.when(k % 9 != 0, 560)
    samples = s.select(k.alias("sample_ord"), name.alias("id"), F.concat(F.lit("images/"), name, F.lit(".png")).alias("image"), size.alias("width"), size.alias("height"), vlm.alias("vlm"), ocr.alias("ocr"), trans.alias("trans"), canonical.alias("canonical"))
    return W.sample_errors(samples).select(F.col("sample_ord").alias("k"), "view_ord", "item", "message")


@query("SELECT p_partkey, length(p_name) * 56 + 3 * 100 AS hundredths, floor(p_size * 1000 / 20)::INT AS room FROM part")
def q48_measure(spark, d):
    """Width of a text by the engine's metric (three wide characters added), and the room of a slot at a font size."""
    return read(spark, d, "part").select("p_partkey", L.units(F.concat("p_name", F.lit("日本語"))).cast(BIG).alias("hundredths"), L.room(F.col("p_size") * 10, F.lit(20)).alias("room"))


@query("SELECT a.conv_id, list_sort(list_intersect(a.roles, b.roles)) AS shared FROM (SELECT conv_id, list(DISTINCT role) AS roles FROM conversations GROUP BY conv_id) a JOIN (SELECT conv_id, list(DISTINCT role) AS roles FROM conversations WHERE turn >= 2 GROUP BY conv_id) b ON a.conv_id = b.conv_id")
def q49_shared_values(spark, d):
    """Values that two sets have in common: roles of a conversation that speak again from the third turn on."""
    per = read(spark, d, "conversations").groupBy("conv_id").agg(F.collect_set("role").alias("a"), F.collect_set(F.when(F.col("turn") >= 2, F.col("role"))).alias("b"))
    return per.filter(F.size("b") > 0).select("conv_id", F.array_sort(F.array_intersect("a", "b")).alias("shared"))


@query("SELECT x.index, x.seed, y.texts, y.kinds_kept, y.different FROM (SELECT NULL::BIGINT AS index, NULL::BIGINT AS seed) x, (SELECT 0::BIGINT AS texts, true AS kinds_kept, true AS different) y WHERE false")
def q50_fallback_items(spark, d):
    """Faults of generated items, a row a sample: too few or too many, a kind out of its order, a text twice, an action
    word. Every document is a sample of twelve; the rules promise none."""
    rows = C.scaffold(read(spark, d, "documents").select(F.col("doc_id").alias("index")).dropDuplicates(["index"]), SEED)
    made = C.fallback_items(rows.select("sample_id", "seed", "category"), 12)
    kinds = F.transform("items", lambda x: x["kind"])
    texts = F.transform("items", lambda x: T.fold(x["text"]))
    checks = made.select("sample_id", "seed", F.size("items").cast(BIG).alias("texts"), (kinds == C.kind_sequence(F.col("category"), F.col("seed"), 12)).alias("kinds_kept"), (F.size(F.array_distinct(texts)) == F.size(texts)).alias("different"), F.exists("items", lambda x: C.has_action_word(x["text"]) | C.has_action_word(x["translated_text"])).alias("loud"))
    faults = checks.filter("texts <> 12 OR NOT kinds_kept OR NOT different OR loud")
    return faults.join(rows.select("sample_id", "index"), "sample_id").select("index", "seed", "texts", "kinds_kept", "different")


_DRAWN = {c: [k for k, w in zip(KINDS[c], KIND_WEIGHTS[c]) for _ in range(w)] for c in KINDS}


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN " + " ELSE ".join(f"{_DRAWN[c]}[{sql_draw(len(_DRAWN[c]), 'doc_id::VARCHAR', chr(39) + 'kind' + chr(39))} + 1]" for c in ("manga", "game")) + " END AS kind FROM documents")
def q51_weighted_kind(spark, d):
    docs = read(spark, d, "documents")
    return docs.select("doc_id", C.drawn_kind(C.category_of(F.col("doc_id")), F.col("doc_id"), "kind").alias("kind"))


@query("SELECT page_id, replace(url_encode(url || ' é+*~/' || chr(38)), '%2F', '/') AS quoted FROM pages")
def q52_url_quote(spark, d):
    return read(spark, d, "pages").select("page_id", T.url_quoted(F.concat("url", F.lit(" é+*~/&"))).alias("quoted"))


@query("""SELECT o_orderkey, round(rate, 6) AS rate, CASE WHEN rate > 0 THEN floor((50 - done) / rate)::BIGINT END AS seconds_left
    FROM (SELECT o_orderkey, done, done / greatest(took, 0.001) AS rate FROM (SELECT o_orderkey, (o_orderkey % 50)::DOUBLE AS done, (o_orderkey % 7)::DOUBLE * 0.25 AS took FROM orders))""")
def q53_pace(spark, d):
    done, took = F.col("o_orderkey") % 50, (F.col("o_orderkey") % 7) * 0.25
    rate, left = S.pace(done.cast("double"), F.lit(50), took)
    return read(spark, d, "orders").select("o_orderkey", F.round(rate, 6).alias("rate"), F.floor(left).cast(BIG).alias("seconds_left"))


@query("SELECT conv_id, place, (100 * place)::BIGINT AS x, text FROM (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) - 1 AS place FROM conversations) WHERE place <= conv_id % 3")
def q54_box_line_zip(spark, d):
    """One to three boxes for each conversation meet its lines by place."""
    per = read(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("lines"))
    boxes = F.transform(F.sequence(F.lit(0).cast(BIG), F.col("conv_id") % 3), lambda i: i * 100)
    z = per.select("conv_id", F.explode(L.zipped(boxes, F.transform("lines", lambda x: x["text"]))).alias("z"))
    return z.select("conv_id", F.col("z.place").cast(BIG).alias("place"), F.col("z.box").cast(BIG).alias("x"), F.col("z.line").alias("text"))


_PART = lambda name: f"floor(600 * ({sql_draw(31, repr(name), 'page::VARCHAR', 't::VARCHAR')} + 30) / 100)::INT"


@query(f"""WITH b AS ({_PAGE_SQL}), s AS (SELECT page, t, {_PART('rw')} AS w, {_PART('rh')} AS h FROM (SELECT DISTINCT page FROM b), range({L.PROP_TRIES}) r(t)),
    c AS (SELECT page, t, x AS rx1, y AS ry1, x + w AS rx2, y + h AS ry2 FROM (SELECT *, ({sql_draw("(601 - w)", "'rx'", "page::VARCHAR", "t::VARCHAR")})::INT AS x, ({sql_draw("(601 - h)", "'ry'", "page::VARCHAR", "t::VARCHAR")})::INT AS y FROM s)),
    o AS (SELECT c.page, c.t, any_value(struct_pack(x1 := rx1, y1 := ry1, x2 := rx2, y2 := ry2)) AS r,
                 round(max(greatest(least(rx2, x2) - greatest(rx1, x1), 0) * greatest(least(ry2, y2) - greatest(ry1, y1), 0) / least((rx2 - rx1) * (ry2 - ry1), (x2 - x1) * (y2 - y1))::DOUBLE) - 0.05::DOUBLE * any_value((rx2 - rx1) * (ry2 - ry1)) / 360000::DOUBLE, 9) AS score
          FROM c JOIN b ON b.page = c.page GROUP BY c.page, c.t)
    SELECT page, r.x1 AS x1, r.y1 AS y1, r.x2 AS x2, r.y2 AS y2 FROM (SELECT page, arg_min(r, struct_pack(s := score, t := t)) AS r FROM o GROUP BY page)""")
def q55_clear_rect(spark, d):
    """Pages of eight boxes: of the drawn rectangles the one that they leave most room."""
    page = whole_boxes(spark, d).groupBy(F.floor(F.col("p_partkey") / 8).alias("page")).agg(F.collect_list("b").alias("taken"))
    return page.select("page", L.clear_rect(G.box(0, 0, 600, 600), F.col("taken"), L.PROP_TRIES, F.col("page")).alias("r")).select("page", "r.*")


_WIDE = "[\u1100-\u11ff\u2e80-\ua4cf\uac00-\ud7a3\uf900-\ufaff\ufe30-\ufe4f\uff00-\uff60]"
_UNITS = lambda x: f"(100 * length({x}) - 44 * length(regexp_replace({x}, '{_WIDE}', '', 'g')))"


@query(f"""WITH c AS (SELECT conv_id, turn, text, 220 + (turn % 5) * 30 AS w, CASE WHEN contains(text, ' ') THEN ' ' ELSE '' END AS sep,
        list_filter(CASE WHEN contains(text, ' ') THEN string_split_regex(text, '\\s+') ELSE string_split(text, '') END, lambda x: x <> '') AS words, {sql_draw(13, "'font'", "conv_id::VARCHAR", "turn::VARCHAR")} + 26 AS start FROM conversations),
    t AS (SELECT *, floor(w * 100 / s)::BIGINT AS room FROM (SELECT *, unnest(range(start, 17, -2)) AS s FROM c)),
    n AS (SELECT conv_id, turn, s, CASE WHEN len(words) = 0 THEN 0 ELSE len(string_split(list_reduce(words, lambda a, x: CASE WHEN length(a) - length(replace(a, chr(10), '')) >= 6 THEN a
            WHEN {_UNITS("(string_split(a, chr(10))[-1] || sep || x)")} <= room THEN a || sep || x ELSE a || chr(10) || x END), chr(10))) END AS lines FROM t WHERE coalesce(list_max(list_transform(words, lambda x: {_UNITS("x")})), 0) <= room)
    SELECT c.conv_id, c.turn, coalesce(max(n.s), 18)::INT AS size FROM c LEFT JOIN n ON c.conv_id = n.conv_id AND c.turn = n.turn AND n.lines <= least(5, floor(190 / greatest(n.s + 7, 24))) GROUP BY c.conv_id, c.turn""")
def q56_font_size(spark, d):
    """The size at which a turn fits its bubble, by wrapping it at each."""
    c = read(spark, d, "conversations")
    return c.select("conv_id", "turn", L.font_size(F.col("text"), 220 + (F.col("turn") % 5) * 30, F.lit(190), "normal", F.col("conv_id"), F.col("turn")).alias("size"))


_COINS = ", ".join(f"CASE WHEN {sql_draw(100, 'doc_id::VARCHAR', repr(x), 'i::VARCHAR')} < 45 THEN '{x}' END" for x in COIN_TEXTURES)


@query(f"""SELECT doc_id, (4 + doc_id % 3)::INT AS panel_count, array_to_string(list_sort(list_distinct(list_filter(flatten(list([{', '.join(repr(x) for x in TEXTURES)}, {_COINS}])), lambda x: x IS NOT NULL))), ',') AS patterns
    FROM (SELECT doc_id, unnest(range(4 + doc_id % 3)) AS i FROM (SELECT DISTINCT doc_id FROM documents)) GROUP BY doc_id""")
def q57_panel_noise(spark, d):
    ids = read(spark, d, "documents").select("doc_id").distinct()
    return ids.select("doc_id", L.panel_noise((4 + F.col("doc_id") % 3).cast("int"), F.col("doc_id")).alias("n")).select("doc_id", "n.panel_count", F.array_join("n.patterns", ",").alias("patterns"))


_ACTORS = ACTORS | DENSE_ACTORS


@query(f"SELECT p_partkey, style, CASE style {' '.join(f'WHEN {k!r} THEN {v}' for k, v in _ACTORS.items())} ELSE 1 END AS actors FROM (SELECT p_partkey, {[*_ACTORS, 'camp']}[p_partkey % 9 + 1] AS style FROM part)")
def q58_actor_count(spark, d):
    style = F.get(F.array(*[F.lit(x) for x in [*_ACTORS, "camp"]]), (F.col("p_partkey") % 9).cast("int"))
    return read(spark, d, "part").select("p_partkey", style.alias("style")).withColumn("actors", L.actors(F.col("style"), "dense"))


@query("SELECT doc_id, md5(printf('Make %d short text items for a %s picture, in the language %s, each with a Vietnamese translation. Allowed kinds: %s. No sound words. Reply with JSON alone: {\"items\": [{\"text\": ..., \"translated_text\": ..., \"kind\": ...}]}', 3 + doc_id % 5, " + CATEGORY_SQL + ", coalesce(lang, 'en'), CASE WHEN doc_id % 2 = 0 THEN '" + ", ".join(KINDS["manga"]) + "' ELSE '" + ", ".join(KINDS["game"]) + "' END)) AS digest FROM documents")
def q59_prompt(spark, d):
    p = C.prompt(C.category_of(F.col("doc_id")), F.coalesce("lang", F.lit("en")), 3 + F.col("doc_id") % 5)
    return read(spark, d, "documents").select("doc_id", F.md5(p.cast("binary")).alias("digest"))
