"""Id map and relevance judgments as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.operators.search import normal_label


def clean_id_map(rows: DataFrame, order: str, source: str = "DocID", target: str = "CelexID") -> DataFrame:
    """``(source_id, doc_id)``; rows without an id drop out first, then the last row wins."""
    usable = rows.where(
        F.col(source).isNotNull() & (F.col(source) != "")
        & F.col(target).isNotNull() & (F.col(target) != "") & (F.lower(target) != "null")
    )
    return usable.groupBy(F.col(source).alias("source_id")).agg(
        F.max_by(F.lower(target), F.col(order)).alias("doc_id")
    )


def parse_judgments(lines: DataFrame, order: str, line: str = "line") -> DataFrame:
    """``(order, label, source_id, rel)`` from lines with exactly three fields.

    ``rel`` stays text: only judgments that pass the label and id filters must hold a number.
    """
    fields = F.split(F.regexp_replace(line, r"(?U)^\s+|\s+$", ""), r"(?U)\s+")
    return (
        lines.select(order, fields.alias("fields"))
        .where(F.size("fields") == 3)
        .select(
            order,
            F.col("fields")[0].alias("label"),
            F.col("fields")[1].alias("source_id"),
            F.col("fields")[2].alias("rel"),
        )
    )


def vocabulary_judgments(parsed: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Judgments with their query text, kept when the label is in the vocabulary."""
    known = vocabulary.select(normal_label(F.col("label")).alias("qid")).distinct()
    # The vocabulary has at most top_labels rows.
    return parsed.withColumn("qid", normal_label(F.col("label"))).join(F.broadcast(known), "qid", "left_semi")


def skipped_judgments(parsed: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """How many parsed lines name a label outside the vocabulary."""
    known = vocabulary.select(normal_label(F.col("label")).alias("qid")).distinct()
    outside = parsed.select(normal_label(F.col("label")).alias("qid")).join(
        F.broadcast(known), "qid", "left_anti"
    )
    return outside.agg(F.count(F.lit(1)).alias("skipped"))


def mapped_judgments(kept: DataFrame, ids: DataFrame) -> DataFrame:
    """Judgment lines with the act id and ``rel`` as a number; lines whose id has no match drop out.

    The cast stands behind the join: a plan may not move one that can fail below it.
    """
    return kept.join(ids, "source_id").withColumn("rel", F.when(F.col("doc_id").isNotNull(), F.col("rel").cast("int")))


def final_judgments(mapped: DataFrame, order: str) -> DataFrame:
    """``(qid, doc_id, rel)``; the last line about a pair wins."""
    return mapped.groupBy("qid", "doc_id").agg(F.max_by("rel", order).alias("rel"))


def evaluation_queries(mapped: DataFrame, order: str, limit: int | None = None) -> DataFrame:
    """Query texts with the place of their first judgment; ``limit`` keeps the first ones only."""
    first = mapped.groupBy("qid").agg(F.min(order).alias("first_seen"))
    return first if limit is None else first.orderBy("first_seen", "qid").limit(limit)
