"""Quality rules with adaptive thresholds (DataFrame functions only).

Each document gets exact text statistics. The base rule is fixed: too few words, or too many words in repeated
five-word windows. Above it every threshold comes from quantile sketches alone: KLL sketches of three measures, built for
each language and source (one a task and group, merged in the shuffle, so a source with a third of all rows costs no
more), and documents are filtered by a join with them.

Measures are integers. Symbols per character of words and repeated per all lines are smoothed by half a symbol or line,
so that a document without any has a value too (the longer, the smaller) and a group has a spread where most have none;
their fence is SPREADS quartile distances above the third quartile on a logarithmic scale, q3 * (q3 / q1) ** SPREADS. The
mean word length's is LENGTH_SPREADS distances above on a plain scale. A group of fewer than MIN_GROUP documents, or
whose quartiles are equal, takes the fence of its language (its sources' sketches merged), and that failing, of all
documents; without any spread at all nothing is rejected. thresholds says which level each fence is from.

Defined cases: a null or empty text has no words and fails the base rule; null languages and sources form groups of
their own; repeated rows are judged alike; an empty table gives an empty result; extra columns are kept untouched. Above
SKETCH_K documents of a group quartiles are those of the sketch, within some 0.2 % of ranks; they may differ that much
between runs, but not within one, as the table of thresholds is written once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, packed

#: A word, as a pattern of java.util.regex and of RE2.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5
SPREADS, LENGTH_SPREADS = 3, 6
MEASURES = ("symbols", "dup_lines", "word_length")
MIN_GROUP = 20
SKETCH_K = 1024
#: Threshold rows that may be broadcast (some 60 bytes each); beyond it the join shuffles.
BROADCAST_ROWS = 50_000


def _repeats(stage: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words inside five-word windows that occur twice or more in the text."""
    hashed = F.transform("words", lambda w: F.xxhash64(w))
    stage = stage.withColumn("word_hashes", hashed)
    window = lambda i: F.xxhash64(*[F.get("word_hashes", i + k) for k in range(WINDOW)])
    stage = stage.withColumn(
        "windows",
        F.when(F.size("words") >= WINDOW, F.transform(F.sequence(F.lit(0), F.size("words") - WINDOW), window)).otherwise(F.array().cast("array<bigint>")),
    )
    # Only a text with a repeated window goes further; array_distinct is compiled and linear.
    by_hash = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    stage = stage.withColumn("by_hash", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), by_hash))
    twin = lambda p, j: (p["h"] == F.get("by_hash", j - 1)["h"]) | (p["h"] == F.get("by_hash", j + 1)["h"])
    places = F.sort_array(F.transform(F.filter("by_hash", lambda p, j: F.coalesce(twin(p, j), F.lit(False))), lambda p: p["i"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end")),
        lambda a, p: F.struct((a["n"] + (p + WINDOW - F.greatest(p, a["end"]))).cast("bigint").alias("n"), (p + WINDOW).alias("end")),
        lambda a: a["n"],
    )
    return stage.withColumn("n_repeat_words", F.when(F.col("by_hash").isNotNull(), covered).otherwise(F.lit(0)).cast("bigint"))


def _measures() -> dict[str, Column]:
    """Integers that the fences judge: two smoothed shares in millionths, and thousandths of a character a word."""
    share = lambda a, b: F.floor((2 * F.col(a) + 1) * 500_000 / (F.col(b) + 1)).cast("bigint")
    return {
        "symbols": share("n_symbols", "word_chars"),
        "dup_lines": share("n_dup_lines", "n_lines"),
        "word_length": F.when(F.col("n_words") > 0, F.floor(F.col("word_chars") * 1000 / F.col("n_words")).cast("bigint")),
    }


def statistics(docs: DataFrame, *, repeats: bool = True) -> DataFrame:
    """row (all columns of docs) with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words and the measures."""
    text = F.coalesce(F.col("row.text"), F.lit(""))
    stage = packed(docs).withColumn("words", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    stage = stage.withColumn("lines", lines).select(
        "row", "words",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("bigint").alias("n_symbols"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
    )
    kept = ["row", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    if repeats:
        stage, kept = _repeats(stage), [*kept, "n_repeat_words"]
    return stage.select(*kept).select("*", *[c.alias(k) for k, c in _measures().items()])


def _fence(q1: Column, q3: Column, measure: str) -> Column:
    if measure == "word_length":
        return (q3 + LENGTH_SPREADS * (q3 - q1)).cast("double")
    fence = q3.cast("double")
    for _ in range(SPREADS):
        fence = fence * (q3.cast("double") / q1.cast("double"))
    return fence


def _quartiles(level: DataFrame, name: str) -> DataFrame:
    """For each row with a sketch of every measure, its fences; null where there are too few documents or no spread."""
    for k in MEASURES:
        many = F.kll_sketch_get_n_bigint(k) >= MIN_GROUP
        level = level.withColumn(f"q_{k}", F.when(many, F.kll_sketch_get_quantile_bigint(k, F.array(F.lit(0.25), F.lit(0.75)))))
    found = lambda k: F.when(F.col(f"q_{k}")[0] < F.col(f"q_{k}")[1], _fence(F.col(f"q_{k}")[0], F.col(f"q_{k}")[1], k))
    return level.select(*[c for c in level.columns if c.startswith("f_")], *[found(k).alias(f"{name}_{k}") for k in MEASURES])


def thresholds(stats: DataFrame) -> DataFrame:
    """f_lang, f_source and, for each measure, max_ (null: none) and level_ (own, lang, all, none). stats has lang, source,
    n_words and the measures; documents of fewer than MIN_WORDS words have no say."""
    measured = lambda k: F.when(F.col("n_words") >= MIN_WORDS, F.col(k))
    own = stats.groupBy(F.col("lang").alias("f_lang"), F.col("source").alias("f_source")).agg(*[F.kll_sketch_agg_bigint(measured(k), F.lit(SKETCH_K)).alias(k) for k in MEASURES])
    own = materialise(own)  # one row a group
    merged = [F.kll_merge_agg_bigint(k, F.lit(SKETCH_K)).alias(k) for k in MEASURES]
    lang = _quartiles(own.groupBy(F.col("f_lang").alias("f_of")).agg(*merged), "lang")
    every = _quartiles(own.groupBy().agg(*merged, F.count("*").alias("groups")).filter("groups > 0").drop("groups"), "all").first()
    rows = _quartiles(own, "own").join(lang, F.col("f_lang").eqNullSafe(F.col("f_of")), "left")
    for k in MEASURES:
        whole = F.lit(every[f"all_{k}"] if every else None).cast("double")
        rows = rows.withColumn(f"max_{k}", F.coalesce(f"own_{k}", f"lang_{k}", whole))
        rows = rows.withColumn(f"level_{k}", F.when(F.col(f"own_{k}").isNotNull(), "own").when(F.col(f"lang_{k}").isNotNull(), "lang").when(whole.isNotNull(), "all").otherwise("none"))
    return rows.select("f_lang", "f_source", *[f"{x}_{k}" for k in MEASURES for x in ("max", "level")])


def judged(stats: DataFrame, limits: DataFrame) -> DataFrame:
    """stats with base_failed and kept. stats has lang and source, n_repeat_words and the measures."""
    limits = materialise(limits.select("f_lang", "f_source", *[f"max_{k}" for k in MEASURES]))
    if limits.count() <= BROADCAST_ROWS:
        limits = F.broadcast(limits)
    own = F.col("lang").eqNullSafe(F.col("f_lang")) & F.col("source").eqNullSafe(F.col("f_source"))
    fails = F.lit(False)
    for k in MEASURES:
        fails = fails | F.coalesce(F.col(k) > F.col(f"max_{k}"), F.lit(False))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return stats.join(limits, own, "left").withColumn("base_failed", base).withColumn("kept", ~(base | fails))


def quality_report(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, the statistics, base_failed and kept. Statistics are computed once and written."""
    stats = statistics(docs).withColumns({"doc_id": F.col("row.doc_id"), "lang": F.col("row.lang"), "source": F.col("row.source")}).drop("row")
    stats = materialise(stats)
    return judged(stats, thresholds(stats)).drop("f_lang", "f_source")


def quality_filter(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with their own columns. Texts are never shuffled: a first pass makes the
    sketches, a second one judges."""
    named = lambda s: s.withColumns({"lang": F.col("row.lang"), "source": F.col("row.source")})
    limits = thresholds(named(statistics(docs, repeats=False)).drop("row"))
    # inline, not filter: a filter would be pushed below the statistics, with their expressions copied many times over.
    return judged(named(statistics(docs)), limits).select(F.inline(F.when(F.col("kept"), F.array("row"))))
