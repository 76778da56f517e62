"""Corpus preparation in five stages, each written and read again before the next.

1. Language identification: documents without a letter have no language and are rejected; all others stay, however many
   languages were learned, and also where there is none to learn from.
2. Near duplicates: of each component the document with the smallest doc_id stays.
3. Benchmark decontamination: documents that contain a benchmark item are rejected.
4. Secrets: every span found is replaced by a mark, n_chars follows.
5. Byte-level BPE: the token ids of every document that is left.

All stages but the last return the columns of documents, and further columns as they are, whatever their names; the last adds token_ids
(with underscores in front where that name is taken). Rows with a null doc_id are never surplus; of equal rows one stays. An empty table passes through all stages.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from sundial.llm import bpe, contamination, jaccard, language, secrets  # noqa: E402
from sundial.llm.queries import BPE_PATTERN, BPE_RANKS, language_training  # noqa: E402
from sundial.llm.shared import bounded, fresh, saved, small_batches  # noqa: E402

def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    if not language_training(docs).where("lang IS NOT NULL AND length(text) > 0").limit(1).count():
        return docs.where(language.has_letter(F.col("text")))
    predicted, *rest = names = fresh(list(language.RESULTS), docs.columns)
    return language.identify(docs, language_training(docs), docs.columns, results=names).where(F.col(f"`{predicted}`") != "und").drop(predicted, *rest)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    own, = fresh(["__id"], docs.columns)
    classes = jaccard.join(docs).where("component_id < doc_id").select(F.col("doc_id").alias(own)).distinct()
    kept = docs.join(bounded(saved(classes, "surplus")), F.col("doc_id") == F.col(own), "left_anti")
    ids = docs.select(F.col("doc_id").alias(own)).where(F.col(own).isNotNull())
    repeated = bounded(saved(ids.groupBy(own).agg(F.count("*").alias("rows")).where("rows > 1").select(own), "repeated"))
    if not repeated.limit(1).count():
        return kept
    same = F.col("doc_id") == F.col(own)
    return kept.join(repeated, same, "left_anti").unionByName(kept.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"]))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination.clean(docs, spark.read.parquet(f"{str(sf_dir).rstrip('/')}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = fresh(list(secrets.RESULTS), docs.columns)
    found, spans = secrets.scan(docs, docs.columns, results=names), F.col(f"`{names[-1]}`")
    text = F.when(F.size(spans) > 0, secrets.redacted(F.col("text"), spans)).otherwise(F.col("text"))
    return (found.withColumn("n_chars", F.when(F.size(spans) > 0, F.length(text).cast("long")).otherwise(F.col("n_chars")))
            .withColumn("text", text).drop(*names))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return bpe.encode(docs, BPE_RANKS, BPE_PATTERN, ids=fresh(["token_ids"], docs.columns)[0])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("bpe", encode),
]

#: Learned language models and token ids have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{str(sf_dir).rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
