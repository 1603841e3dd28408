"""Corpus preparation in five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept:

1. language: documents whose language is not recognised go (no letter, or a narrow margin);
2. near copies: one document of each group stays;
3. benchmark leaks: documents that hold a passage of a test item go;
4. secrets: every span found is replaced by its kind in brackets, ``n_chars`` follows;
5. tokens: the text becomes its token ids, with digests of the ids and of the text decoded from them.

All but the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import bpe, decontaminate, langid, minhash, secrets
from eventloom.llm.common import ship, stored, table
from eventloom.llm.queries import tokenizer_path

# The learned dictionaries and formats, and the components of a graph, are not expressible in SQL.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    found = langid.identify(docs, langid.learned(docs), carry=tuple(docs.columns), prefix="_language_")
    return found.where("not _language_rejected").select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return minhash.deduplicated(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    keyed = docs.select(F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash")).alias("row"), "text")
    found = decontaminate.leaks(keyed, table(spark, sf_dir, "benchmark"), key="row")
    gone = stored(found.select(F.col("row.id").alias("_key"), F.col("row.hash").alias("_hash")).distinct(), "leaks")
    return minhash.without(docs, gone)


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    carry = tuple(c for c in docs.columns if c != "text")
    found = secrets.scan(docs, secrets.learned(docs), carry=carry, prefix="_secret_")
    changed = F.size("_secret_found") > 0
    new = {"text": F.col("_secret_redacted"), "n_chars": F.when(changed, F.length("_secret_redacted").cast("long")).otherwise(F.col("n_chars"))}
    return found.select([new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    outputs = ("n_tokens", "ids_sha256", "decoded_sha256", "ids")
    carry = tuple(c for c in docs.columns if c != "text" and c not in outputs)
    return bpe.round_trip(docs, tokenizer_path(), carry=carry, outputs=outputs)


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("benchmark_leaks", benchmark_leaks),
    ("secrets", secret_spans),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
