"""Corpus pipeline: raw documents to tokenized training text, in five stages.

Each stage is a function of (spark, docs, sf_dir) that returns a DataFrame; the
runner writes it as Parquet in the shared folder and hands the reread table to
the next stage. All but the last return the columns of ``documents``.

Defined results: documents without text or letters, or with no evidence of a learned
language, leave at the first stage, so a table without any document gives no rows; null sources and languages pass through;
rows that repeat a document's id count as that document once from the second stage
on.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm import byte_bpe, decontam, language, pii, simhash
from tierline.llm.common import staged, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts of undetermined language: none at all, no letter, or a score below the calibrated bar."""
    model, bar = language.train_with_bar(docs)
    found = language.identify(docs, model)
    kept = found.filter((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= bar))
    return kept.select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the least id of every group of documents that fingerprint links connect."""
    return simhash.keep_one_per_group(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of a benchmark item."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; ``n_chars`` follows the text."""
    found = pii.redacted(docs, pii.train(docs))
    if "n_chars" in found.columns:
        kind = docs.schema["n_chars"].dataType
        found = found.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return found


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of each kept text, their number, their digest and that of the bytes decoded from them."""
    return byte_bpe.document_digests(
        docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True
    )


STAGES: list[tuple[str, Stage]] = [
    ("language ID", keep_known_languages),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("PII", redact_personal_data),
    ("byte-level BPE encoding and decoding", tokenize),
]

#: Learned classifiers, fingerprints and the vocabulary have no SQL form; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
