"""Corpus pipeline: documents in, packed training windows out. Every stage is stored before the next one reads it."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import packing, pii, quality_classifier, substring, trie_join
from tidewatch.llm.common import fresh
from tidewatch.llm.word_ids import default_vocabulary
from tidewatch.session import scratch_path
from tidewatch.sources.tables import read_raw

#: A document goes when its chance of being good is below this; a doubtful one stays.
LEAST_QUALITY = 0.5


def _recount(docs: DataFrame) -> DataFrame:
    """n_chars says how long the text is now."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else docs


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents below ``LEAST_QUALITY`` go. All columns and all other rows stay."""
    model = quality_classifier.train(docs, read_raw(spark, sf_dir, "labels"))
    [out] = fresh(docs, "_score_")
    scored = quality_classifier.score(docs, model, out=out)
    return scored.where(F.col(out) >= LEAST_QUALITY).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join (five words, 0.8): the document with the smallest id of each group stays."""
    return trie_join.keep_one(docs, words=5, percent=80)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Substring dedup: a passage of 50 words or more that an earlier document holds is cut out."""
    return _recount(substring.remove(docs))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data: every found span becomes its kind in angle brackets."""
    return _recount(pii.redact(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: one row per piece with its sequence and offset."""
    return packing.pack(docs, default_vocabulary())


STAGES = [
    ("quality classifier", good_documents),
    ("n-gram Jaccard join", one_of_each_group),
    ("substring dedup", without_repeated_passages),
    ("personal data", without_personal_data),
    ("packing", packed),
]

#: SQL has no tokenizer and no trained model; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last one."""
    docs = read_raw(spark, sf_dir, "documents")
    base = scratch_path(spark, f"pipeline-{uuid.uuid4().hex[:12]}")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            path = os.path.join(base, str(n))
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
