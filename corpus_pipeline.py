"""The corpus pipeline: documents to packed token ids.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet in the shared folder and read again as the next one's docs. All but the last return the columns of documents.

1. quality_rules: documents that the rules reject go.
2. jaccard_join: of each component of near duplicates (five-word shingles, similarity 0.8 or more) the document of
   smallest doc_id stays.
3. decontamination: benchmark passages are cut out of the texts.
4. source_mixing: each document as often as the mix takes it, whole.
5. token_ids: the token files of what is left, read back: a row a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from glyphmill.llm import decontamination, jaccard, mixing, packing, quality
from glyphmill.llm.common import shared_dir

TOKENIZER = "word_bpe_49k.json"
SHINGLE, PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.quality_filter(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.deduplicated(docs, SHINGLE, PERCENT)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.removed(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.tokenise(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mixing),
    ("token-ID / binary output", token_ids),
]

#: The tokenizer's ids and the connected components are beyond SQL; tests/llm compares each stage with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = shared_dir(spark)
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
