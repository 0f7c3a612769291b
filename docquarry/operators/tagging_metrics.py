"""Multi-label classification metrics from long tables ``(doc_id, label)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ratio(top: Column, bottom: Column) -> Column:
    """0 when undefined."""
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def _scores(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    return {
        "precision": _ratio(tp, tp + fp),
        "recall": _ratio(tp, tp + fn),
        "f1": _ratio(2 * tp, 2 * tp + fp + fn),
    }


def outcome_cells(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """One row per true or predicted pair with ``tp``, ``fp`` and ``fn`` as 0 or 1.

    Pairs meet by grouping, not by a join, and are distributed on ``doc_id``, so counting per
    document afterwards needs no second shuffle.
    """
    sides = truth.select("doc_id", "label", F.lit(1).alias("t"), F.lit(0).alias("p")).unionByName(
        predicted.select("doc_id", "label", F.lit(0).alias("t"), F.lit(1).alias("p"))
    )
    met = sides.repartition("doc_id").groupBy("doc_id", "label").agg(F.max("t").alias("t"), F.max("p").alias("p"))
    return met.select(
        "doc_id", "label",
        (F.col("t") * F.col("p")).alias("tp"),
        ((1 - F.col("t")) * F.col("p")).alias("fp"),
        (F.col("t") * (1 - F.col("p"))).alias("fn"),
    )


def _totals(cells: DataFrame, *keys: str) -> DataFrame:
    return cells.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])


def label_report(cells: DataFrame, labels: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per label of the vocabulary."""
    counted = labels.select("label").join(_totals(cells, "label"), "label", "left").fillna(0, ["tp", "fp", "fn"])
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counted.select(
        "label",
        *[column.alias(name) for name, column in _scores(tp, fp, fn).items()],
        (tp + fn).alias("support"),
    )


def average_report(cells: DataFrame, labels: DataFrame, documents: int) -> DataFrame:
    """Micro, macro, weighted and per-document averages, one row each."""
    names = ("precision", "recall", "f1")
    per_label = label_report(cells, labels)
    tp, fp, fn = F.sum("tp"), F.sum("fp"), F.sum("fn")
    micro = cells.agg(
        F.lit("micro").alias("average"),
        *[F.coalesce(column, F.lit(0.0)).alias(name) for name, column in _scores(tp, fp, fn).items()],
        F.coalesce(tp + fn, F.lit(0)).alias("support"),
    )
    macro = per_label.agg(
        F.lit("macro").alias("average"),
        *[F.avg(name).alias(name) for name in names],
        F.sum("support").alias("support"),
    )
    weight = F.sum("support")
    weighted = per_label.agg(
        F.lit("weighted").alias("average"),
        *[_ratio(F.sum(F.col(name) * F.col("support")), weight).alias(name) for name in names],
        weight.alias("support"),
    )
    per_document = _totals(cells, "doc_id")
    one = _scores(F.col("tp"), F.col("fp"), F.col("fn"))
    samples = per_document.select(*[c.alias(n) for n, c in one.items()], "tp", "fn").agg(
        F.lit("samples").alias("average"),
        # Documents without a true or predicted label have no row and count as 0.
        *[F.coalesce(F.sum(name) / max(documents, 1), F.lit(0.0)).alias(name) for name in names],
        F.coalesce(F.sum(F.col("tp") + F.col("fn")), F.lit(0)).alias("support"),
    )
    return micro.unionByName(macro).unionByName(weighted).unionByName(samples)


def hamming_loss(cells: DataFrame, documents: int, labels: int) -> DataFrame:
    """Share of wrong cells among all documents x labels."""
    wrong = F.coalesce(F.sum(F.col("fp") + F.col("fn")), F.lit(0))
    return cells.agg(
        wrong.alias("wrong_cells"),
        F.lit(documents * labels).cast("long").alias("cells"),
        (wrong / F.lit(float(max(documents * labels, 1)))).alias("hamming_loss"),
    )
