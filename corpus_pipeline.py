"""The corpus pipeline: stages in order, each on all rows that the one before kept.

Rows of ``documents`` pass a quality classifier, lose near duplicates (five-word shingles, Jaccard 0.8 or
more), lose documents that hold a benchmark item, get their secrets replaced, and are packed into
sequences. A stage's result is written as Parquet and read back as the next stage's documents.

Defined results: as the operators define them. Null texts pass every stage up to packing, unless the
classifier rejects texts without words; columns beyond those of ``documents`` are kept by all stages but the
last. Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docquarry.llm import decontaminate, jaccard, packing, quality, secrets
from docquarry.llm.common import reachable, store, table
from docquarry.llm.tokens import vocabulary_path

# No SQL: the classifier is trained, and texts are tokenized by a library.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.without_rejected(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.without_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced."""
    return secrets.redact(docs, length="n_chars")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, vocabulary_path("byte_bpe_50k.json"))


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    reachable(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
