"""From raw documents to token ids: quality rules, near duplicates, personal data, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet and
reads it again as the next stage's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cadastre.llm import bpe, line_rules, mixing, pii, simhash
from cadastre.llm.common import table
from cadastre.sources.scratch import settle

RANKS = "byte_bpe_multi_50k.tiktoken"
ROWS, ROWS_SETTING = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"  # rows that pass to Python and back at once
SHINGLE, LIMIT = 3, 2  # words of a shingle, bits that fingerprints of near duplicates may differ in


def small_batches(spark: SparkSession) -> None:
    """Whole texts are large rows: fewer of them at once, unless the session asks for fewer still.

    Spark's 10,000 (also 0, no limit) are a whole partition of texts, which JVM and worker then hold several
    times.  It stays set, as a stage is computed after its function has returned.
    """
    if not 0 < int(spark.conf.get(ROWS_SETTING)) <= ROWS:
        spark.conf.set(ROWS_SETTING, ROWS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules go; frequent lines of the others go."""
    return line_rules.passed(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates by SimHash stays, that with the smallest id."""
    small_batches(spark)
    return simhash.one_per_class(docs, shingle=SHINGLE, limit=LIMIT)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked by a tag of its kind; n_chars follows the text."""
    small_batches(spark)
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document is left out, taken once or taken twice, and then is two rows."""
    small_batches(spark)
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of their decoded bytes, per row."""
    small_batches(spark)
    return bpe.digests(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

# Hashing, linking, masking, mixing and encoding are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs
