"""Mixing sources to target weights by Efraimidis-Spirakis sampling (DataFrame functions only).

Each source gets a token target: its weight's part of the total budget, stopped at a number of epochs, the excess
shared again by weight (water filling, solved in closed form over one row a source). A source gives its complete
epochs first; the rest is a weighted sample without replacement: every document draws an exponential key, -ln(u)
divided by its quality weight, documents are sorted by key within their source, and a running sum of their sizes is
cut at the rest of the target. u comes from md5 of the seed and doc_id, so reruns agree.

The running sum is made in two levels: keys fall into ordered buckets, bucket sums are added up first, and only rows
of one bucket of one source are sorted together, so a source with a third of all rows is no single task.

Defined cases: a null or empty text has size 0 and nothing is taken; a null source is a source, in the last place;
ties and repeated rows have an order by key, doc_id and size, and equal rows are interchangeable; a source without
words has target 0; an empty table gives an empty result; extra columns are kept by mixed_documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, packed

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 20
#: Rows of one source in a bucket, on average.
BUCKET_ROWS = 2_000
#: Rows of the source table that may be broadcast (under 100 bytes each).
BROADCAST_ROWS = 50_000
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """row (all columns), doc_id, source, size and the sampling key of each document."""
    text = F.coalesce(F.col("row.text"), F.lit(""))
    stage = packed(docs).select("row", F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"), F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("bigint").alias("size"),
                                F.length(text).alias("chars"), F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).alias("symbols"))
    # Quality weight: 1 for clean prose, down to 1/4 for a text of symbols only.
    weight = F.when(F.col("chars") > 0, 1 - 0.75 * F.col("symbols") / F.col("chars")).otherwise(1.0)
    draw = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary")), 1, 12), 16, 10).cast("bigint")
    u = (draw.cast("double") + 0.5) / float(1 << 48)
    return stage.withColumn("key", -F.log(u) / weight).drop("chars", "symbols")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, target: one row a source. sizes has source and size."""
    per = sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row a source, never documents
    rank = (F.row_number().over(order) - 1) % len(weights)
    weighed = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), rank + 1)).withColumn("cap", (max_epochs * F.col("source_size")).cast("double"))
    # Sources in the order in which they reach their caps: with the first k at theirs, the level of the rest is
    # (total - their caps) / weight of the rest; the smallest k whose level stays under the next cap holds.
    filled = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = filled.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(every).cast("double") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    levels = weighed.withColumn("level", level).withColumn("open", F.col("level") <= F.col("cap") / F.col("weight"))
    level = F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), F.col("level").alias("level")))).over(Window.partitionBy())["level"]
    return levels.withColumn("final", level).select("source", "source_size", F.least(F.col("cap"), F.col("final") * F.col("weight")).alias("target"))


def mix(docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED, cut_last: bool = True, keep_rows: bool = False) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for each document (row too with keep_rows).

    cut_last: the document at which a source's budget ends gives only the words that are left of it, so every source
    meets its target to a word. Otherwise it is taken whole if that comes nearer to the target than leaving it.
    """
    rows = sized(docs, seed)
    if not keep_rows:
        rows = materialise(rows.drop("row"))
    light = rows.select("source", "size", "key")
    per_source = materialise(targets(light, weights, max_epochs).join(light.groupBy(F.col("source").alias("s")).agg(F.count("*").alias("n")), F.col("source").eqNullSafe(F.col("s")), "left").drop("s"))
    small = per_source.count() <= BROADCAST_ROWS
    near = F.broadcast if small else (lambda x: x)
    own = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))
    joined = rows.alias("r").join(near(per_source).alias("t"), own("r", "t")).select("r.*", "t.source_size", "t.target", "t.n")
    # 1 - exp(-key) is near uniform for weights near 1, and rises with the key.
    joined = joined.withColumn("bucket", F.floor((1 - F.exp(-F.col("key"))) * F.ceil(F.col("n") / BUCKET_ROWS)).cast("int")).drop("n")
    sums = materialise(joined.groupBy("source", "bucket").agg(F.sum("size").alias("sum")))
    sums = sums.withColumn("before", F.coalesce(F.sum("sum").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    few = F.broadcast if sums.count() <= BROADCAST_ROWS else (lambda x: x)
    joined = joined.alias("r").join(few(sums).alias("b"), own("r", "b") & (F.col("r.bucket") == F.col("b.bucket"))).select("r.*", "b.before")
    place = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = joined.withColumn("upto", F.col("before") + F.sum("size").over(place))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    joined = joined.withColumn("epochs", epochs).withColumn("rest", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("bigint"))
    left = F.col("rest") - (F.col("upto") - F.col("size"))
    last = F.when(left <= 0, 0).when(left >= F.col("size"), F.col("size"))
    last = last.otherwise(left) if cut_last else last.otherwise(F.when(2 * left > F.col("size"), F.col("size")).otherwise(0))
    joined = joined.withColumn("taken", (F.col("epochs") * F.col("size") + last).cast("bigint"))
    return joined.select(*(["row"] if keep_rows else []), "doc_id", "source", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, whole, with its own columns."""
    mixed = mix(docs, cut_last=False, keep_rows=True, **options)
    copies = F.when(F.col("size") > 0, (F.col("taken") / F.col("size")).cast("int")).otherwise(0)
    each = F.when(copies > 0, F.sequence(F.lit(1), copies)).otherwise(F.array().cast("array<int>"))
    return mixed.withColumn("copy", F.explode(each)).select("row.*")
