"""Sample scaffold and text blocks: seeded generation, filters, first-wins dedupe, top-up, fallback and cache."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import ACTION_WORDS, CONTENT_SCHEMA_VERSION, DEFAULT_MODELS, KIND_CYCLE, KIND_WEIGHTS, KINDS, LANGUAGES, PROVIDERS, SEED_STEP
from ..functions import draws as D
from ..functions import text as X
from . import banks

ITEM = T.StructType([T.StructField("text", T.StringType()), T.StructField("translated_text", T.StringType()), T.StructField("kind", T.StringType())])
PAYLOAD = T.StructType(
    [T.StructField("cache_key", T.StringType()), T.StructField("schema_version", T.StringType()), T.StructField("generated_by", T.StringType()), T.StructField("api_provider", T.StringType()), T.StructField("api_error", T.StringType()), T.StructField("model", T.StringType())]
    + [T.StructField("seed", T.LongType()), T.StructField("category", T.StringType()), T.StructField("source_language", T.StringType()), T.StructField("items", T.ArrayType(ITEM))]
)


def category_of(index: Column) -> Column:
    return F.when(index % 2 == 0, "manga").otherwise("game")


def sample_id(category: Column, index: Column) -> Column:
    return F.format_string("%s_%06d", category, index)


def scaffold(indexes: DataFrame, seed: int, languages: Sequence[str] = LANGUAGES) -> DataFrame:
    """index -> seed, category, sample_id, language."""
    s = indexes.select("index", (F.lit(seed).cast("bigint") + F.col("index") * SEED_STEP).alias("seed")).withColumn("category", category_of(F.col("index")))
    language = F.element_at(F.array(*[F.lit(x) for x in languages]), (F.pmod("seed", F.lit(len(languages))) + 1).cast("int"))
    return s.withColumns({"sample_id": sample_id(F.col("category"), F.col("index")), "language": language})


def samples(spark: SparkSession, count: int, seed: int) -> DataFrame:
    return scaffold(spark.range(count).withColumnRenamed("id", "index"), seed)


def kind_sequence(category: Column, seed: Column, count: int) -> Column:
    """count kinds: whole cycles of five, each in an order of its own; inside the row, without a shuffle."""
    cycles = []
    for c in range(-(-count // 5)):
        bases = {k: D.shuffled(F.array(*[F.lit(x) for x in base]), seed, "kinds", c) for k, base in KIND_CYCLE.items()}
        cycles.append(F.when(category == "manga", bases["manga"]).otherwise(bases["game"]))
    return F.slice(F.concat(*cycles), 1, count)


def drawn_kind(category: Column, *parts) -> Column:
    """A kind by weight, for an item that has no place in a sequence."""
    drawn = {c: D.weighted(KINDS[c], KIND_WEIGHTS[c], *parts) for c in KINDS}
    return F.when(category == "manga", drawn["manga"]).otherwise(drawn["game"])


def prompt(category: Column, language: Column, count: Column) -> Column:
    """What a provider is asked for; the reply is read from its first brace to its last."""
    kinds = F.when(category == "manga", ", ".join(KINDS["manga"])).otherwise(", ".join(KINDS["game"]))
    ask = "Make %d short text items for a %s picture, in the language %s, each with a Vietnamese translation. Allowed kinds: %s. No sound words. Reply with JSON alone: {\"items\": [{\"text\": ..., \"translated_text\": ..., \"kind\": ...}]}"
    return F.format_string(ask, count, category, language, kinds)


def _tables(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    templates = spark.createDataFrame(banks.template_rows(), "kind string, t bigint, source string, target string")
    words = spark.createDataFrame(banks.bank_rows(), "name string, i bigint, value string, value_vi string")
    return templates, words


def composed(slots: DataFrame, at: Column, how: str = "inner") -> DataFrame:
    """Fill a drawn template for each row (seed, kind); at tells draws of one seed apart. Tables of some dozens of rows are
    broadcast. With how="left" rows without a kind stay."""
    templates, words = _tables(slots.sparkSession)
    seed = F.col("seed")
    sizes = F.create_map(*[x for k, rows in banks.TEMPLATES.items() for x in (F.lit(k), F.lit(len(rows)))])
    named = lambda n: F.broadcast(words.filter(F.col("name") == n).select(F.col("i").alias(n), F.col("value").alias(f"{n}_s"), F.col("value_vi").alias(f"{n}_t")))
    s = slots.withColumns({"t": D.draw(F.element_at(sizes, F.col("kind")), seed, "template", at), "hero": D.draw(len(banks.BANKS["hero"]), seed, "hero", at), "place": D.draw(len(banks.BANKS["place"]), seed, "place", at),
                           "current": D.between(18, 180, seed, "current", at), "max": D.between(190, 320, seed, "max", at), "level": D.between(2, 48, seed, "level", at), "combo": D.between(2, 9, seed, "combo", at)})
    s = s.join(F.broadcast(templates), ["kind", "t"], how).join(named("hero"), "hero", how).join(named("place"), "place", how)

    def filled(text: str, side: str) -> Column:
        out = F.col(text)
        for name in ("hero", "place"):
            out = F.replace(out, F.lit("{" + name + "}"), F.col(f"{name}_{side}"))
        for name in ("current", "max", "level", "combo"):
            out = F.replace(out, F.lit("{" + name + "}"), F.col(name).cast("string"))
        return out

    return s.withColumns({"text": filled("source", "s"), "translated_text": filled("target", "t")})


def has_action_word(text: Column) -> Column:
    return X.bound(X.fold(text), lambda folded: X.contains_any(folded, ACTION_WORDS))


def _filled_rows(kind: str, seed: Column, at: Column) -> list[Column]:
    """The texts of a kind's templates, with drawn names and numbers, as columns."""
    name = lambda bank: D.choice([x for x, _ in banks.BANKS[bank]], seed, "re", bank, at)
    slots = {"hero": name("hero"), "place": name("place")} | {k: D.between(low, high, seed, "re", k, at).cast("string") for k, (low, high) in {"current": (18, 180), "max": (190, 320), "level": (2, 48), "combo": (2, 9)}.items()}
    out = []
    for text, _ in banks.TEMPLATES[kind]:
        column = F.lit(text)
        for k, v in slots.items():
            if "{" + k + "}" in text:
                column = F.replace(column, F.lit("{" + k + "}"), v)
        out.append(column)
    return out


def restyled(text: Column, kind: Column, seed: Column, at: Column) -> Column:
    """Library texts in the style of their kind: a quest's prefix, a shout's mark; a menu entry or a display's line is one
    of its kind's own templates, filled."""
    quest = F.when(F.lower(text).startswith("quest"), text).otherwise(F.concat(F.lit("QUEST: "), text))
    menu, hud = (D.choice(_filled_rows(k, seed, at), seed, k, at) for k in ("menu", "hud"))
    return F.when(kind == "quest", quest).when(kind == "menu", menu).when(kind == "hud", hud).when(kind == "shout", X.shout(text)).otherwise(text)


#: Attempts for each text: a few, and for samples that these leave short all of them.
FEW, ATTEMPTS = 4, 40


def _folded(made: DataFrame, count: int, attempts: int, wanting: Column | None = None) -> DataFrame:
    """made (sample_id, seed, category, kinds) with items, out of attempts for each kind of the sequence, in order. With
    wanting, rows that have items already, and only those for which it holds get others.

    made is dealt out by sample_id, so that the attempts of a sample meet where they are made."""
    slots = F.flatten(F.transform("kinds", lambda k, i: F.transform(F.sequence(F.lit(0), F.lit(attempts - 1)), lambda a: F.struct((i * ATTEMPTS + a).alias("attempt"), k.alias("kind")))))
    keep = ["kinds"] if wanting is None else ["kinds", "items"]
    slots = slots if wanting is None else F.when(wanting, slots)
    flat = made.select("sample_id", "seed", "category", *keep, F.explode_outer(slots).alias("x")).select("sample_id", "seed", "category", *keep, "x.*")
    tried = composed(flat, F.concat(F.lit("a"), F.col("attempt").cast("string")), "left").withColumns({"known": X.fold(F.col("text")), "known_t": X.fold(F.col("translated_text"))})
    ok = ~X.contains_any(F.col("known"), ACTION_WORDS) & ~X.contains_any(F.col("known_t"), ACTION_WORDS)
    tries = F.array_sort(F.collect_list(F.when(ok, F.struct("attempt", "text", "translated_text", "kind", "known"))))
    tried = tried.groupBy("sample_id", "seed", "category").agg(*[F.first(k).alias(k) for k in keep], tries.alias("tries"))
    none = F.filter("tries", lambda a: F.lit(False))
    wanted = lambda got, a: (F.size(got) < count) & (F.get("kinds", F.size(got)) == a["kind"]) & ~F.exists(got, lambda g: g["known"] == a["known"])
    taken = F.aggregate("tries", none, lambda got, a: F.when(wanted(got, a), F.concat(got, F.array(a))).otherwise(got))
    items = F.transform(taken, lambda a: F.struct(a["text"].alias("text"), a["translated_text"].alias("translated_text"), a["kind"].alias("kind")))
    return tried.withColumn("items", items if wanting is None else F.when(wanting, items).otherwise(F.col("items"))).drop("tries")


def _known(got: Column, a: Column) -> Column:
    return F.exists(got, lambda g: X.fold(g["text"]) == X.fold(a["text"]))


def fallback_items(rows: DataFrame, count: int) -> DataFrame:
    """rows (sample_id, seed, category) with items: count accepted texts, first wins by folded text, topped up.

    Up to ATTEMPTS * count attempts a sample: the fold takes, in order, an attempt whose kind is the one that is wanted
    next, that holds no action word and that isn't known yet. All samples get FEW attempts a text; only those that these
    leave short are folded again with all of them, which gives the others the same. What is still missing comes from the
    library of all templates' plain sentences, in drawn order, restyled.
    """
    spark = rows.sparkSession  # work goes with the attempts, so slim rows are dealt out widely first
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * spark.sparkContext.defaultParallelism)
    made = rows.select("sample_id", "seed", "category").repartition(parts, "sample_id").withColumn("kinds", kind_sequence(F.col("category"), F.col("seed"), count))
    few = _folded(made, count, FEW)
    short = F.size("items") < count
    tried = _folded(few, count, ATTEMPTS, short)
    library = F.array(*[F.struct(F.lit(s.replace("{hero}", "Mira").replace("{place}", "the orchard")).alias("text"), F.lit(t.replace("{hero}", "Mira").replace("{place}", "vườn cây")).alias("translated_text")) for k in ("dialogue", "whisper", "narration") for s, t in banks.TEMPLATES[k]])
    kinds = F.when(F.col("category") == "manga", F.array(*[F.lit(k) for k in KINDS["manga"]])).otherwise(F.array(*[F.lit(k) for k in KINDS["game"]]))
    extra = F.transform(D.shuffled(library, F.col("seed"), "library"), lambda s, i: F.struct(s["text"].alias("text"), s["translated_text"].alias("translated_text"), F.element_at(kinds, (F.pmod(i + F.col("seed"), F.size(kinds)) + 1).cast("int")).alias("kind"), i.alias("i")))
    unseen = F.filter(extra, lambda e: ~_known(F.col("items"), e))
    styled = F.transform(F.slice(unseen, F.lit(1), F.lit(count) - F.size("items")), lambda e: F.struct(restyled(e["text"], e["kind"], F.col("seed"), e["i"]).alias("text"), e["translated_text"].alias("translated_text"), e["kind"].alias("kind")))
    topped = F.when(short, F.concat("items", styled)).otherwise(F.col("items"))  # the library is for the few that need it
    return tried.select("sample_id", "seed", "category", topped.alias("items"))


def normalised(items: Column, category: Column, seed: Column, fallback: Column, count: int) -> Column:
    """A provider's items: kinds lower-cased or drawn, texts stripped, empty ones and action words gone, cut to count, topped up."""
    names = F.when(category == "manga", F.array(*[F.lit(k) for k in KINDS["manga"]])).otherwise(F.array(*[F.lit(k) for k in KINDS["game"]]))
    drawn = lambda i: F.element_at(names, (D.draw(F.size(names), seed, "kind", i) + 1).cast("int"))
    kind = lambda x, i: F.when(F.array_contains(names, F.lower(F.coalesce(x["kind"], F.lit("dialogue")))), F.lower(F.coalesce(x["kind"], F.lit("dialogue")))).otherwise(drawn(i))
    clean = F.transform(items, lambda x, i: F.struct(X.strip(F.coalesce(x["text"], F.lit(""))).alias("text"), X.strip(F.coalesce(x["translated_text"], F.lit(""))).alias("translated_text"), kind(x, i).alias("kind")))
    good = F.filter(clean, lambda x: (x["text"] != "") & (x["translated_text"] != "") & ~has_action_word(x["text"]) & ~has_action_word(x["translated_text"]))
    return F.slice(F.concat(good, fallback), 1, count)


Provider = Callable[[str, int, str], list[dict]]


def payloads(rows: DataFrame, count: int, provider: str = "fallback", model: str | None = None, fetch: Provider | None = None, cache: DataFrame | None = None) -> DataFrame:
    """One content payload a sample: from the cache by key, else from the provider, else from the rules.

    fetch(category, seed, language) is called on the executors for a provider other than fallback; whatever it raises
    is kept as api_error and the sample gets the rules' items.
    """
    if provider not in PROVIDERS:
        raise ValueError(f"content provider must be one of {', '.join(PROVIDERS)}")
    chosen = model or DEFAULT_MODELS.get(provider)
    keyed = rows.withColumn("cache_key", X.cache_key(F.col("category"), F.col("seed"), count, "en", provider, F.lit(chosen)))
    todo = keyed if cache is None else keyed.join(cache.select("cache_key"), "cache_key", "left_anti")
    made = fallback_items(todo.select("sample_id", "seed", "category"), count).select("sample_id", "items")
    todo = todo.join(made, "sample_id")
    said, error = F.lit(None).cast(T.ArrayType(ITEM)), F.lit(None).cast("string")
    if provider != "fallback":

        @F.udf(T.StructType([T.StructField("items", T.ArrayType(ITEM)), T.StructField("error", T.StringType())]))
        def ask(category, seed):
            try:
                if fetch is None:
                    raise RuntimeError(f"no API key for {provider}")
                return ([(x.get("text"), x.get("translated_text"), x.get("kind")) for x in fetch(category, seed, "en")], None)
            except Exception as e:  # noqa: BLE001  any failure falls back to the rules
                return (None, f"{type(e).__name__}: {e}")

        todo = todo.withColumn("said", ask("category", "seed"))
        said, error = F.col("said.items"), F.col("said.error")
    items = F.when(said.isNotNull(), normalised(said, F.col("category"), F.col("seed"), F.col("items"), count)).otherwise(F.col("items"))
    new = todo.select("cache_key", F.lit(CONTENT_SCHEMA_VERSION).alias("schema_version"), F.when(said.isNotNull(), provider).otherwise("fallback").alias("generated_by"), F.lit(provider if provider != "fallback" else None).cast("string").alias("api_provider"), error.alias("api_error"), F.lit(chosen).cast("string").alias("model"), "seed", "category", F.lit("en").alias("source_language"), items.alias("items"))
    if cache is not None:
        new = new.unionByName(cache.join(keyed.select("cache_key"), "cache_key", "left_semi"))
    return new


def blocks(payload: DataFrame, rows: DataFrame) -> DataFrame:
    """sample_id, block (from 0), id, group_id, text, translated_text, source_language, kind."""
    each = rows.select("sample_id", "seed", "category").join(payload.select("seed", "category", "source_language", "items"), ["seed", "category"])
    out = each.select("sample_id", "seed", "category", "source_language", F.posexplode("items").alias("block", "item"))
    return out.select("sample_id", "seed", "category", "block", (F.col("block") + 1).alias("id"), F.format_string("%s_group_%02d", "category", F.col("block") + 1).alias("group_id"), "item.text", "item.translated_text", "source_language", "item.kind")


def make_blocks(spark: SparkSession, category: str, seed: int, count: int, **options) -> DataFrame:
    one = spark.createDataFrame([("sample", seed, category)], "sample_id string, seed bigint, category string")
    return blocks(payloads(one, count, **options), one).orderBy("block")
