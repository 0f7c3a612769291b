"""Ranking metrics of a run ``(qid, doc_id, rank)`` against judgments ``(qid, doc_id, rel)``.

A relevance of at least 1 counts as relevant. Means are taken over the judged queries; a query
without results or without a relevant document scores 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _gain(rel: Column, rank: Column, depth: int) -> Column:
    """Linear gain with a log2 discount; a judged 0 adds nothing."""
    return F.sum(F.when(rank <= depth, rel / F.log2(rank + 1.0)).otherwise(F.lit(0.0)))


def query_metrics(run: DataFrame, judgments: DataFrame, cutoffs: tuple[int, ...] = (10, 20)) -> DataFrame:
    """AP, RR, and nDCG, precision, recall and F1 at each cutoff, one row per judged query.

    Judgments of one query may be many: they are counted with a partial aggregation, and the ideal
    ranking keeps only its first rows per task.
    """
    judged = judgments.groupBy("qid").agg(F.sum((F.col("rel") >= 1).cast("long")).alias("relevant"))
    deepest = max(cutoffs)
    best_first = Window.partitionBy("qid").orderBy(F.col("rel").desc(), F.col("doc_id"))
    ideal = (
        judgments.withColumn("place", F.row_number().over(best_first))
        .where(F.col("place") <= deepest)
        .groupBy("qid")
        .agg(*[_gain(F.col("rel"), F.col("place"), k).alias(f"ideal_{k}") for k in cutoffs])
    )
    so_far = Window.partitionBy("qid").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    found = run.select("qid", "doc_id", "rank").join(judgments, ["qid", "doc_id"])
    marked = found.withColumn("hit", (F.col("rel") >= 1).cast("int")).withColumn("hits", F.sum("hit").over(so_far))
    rank, hit = F.col("rank"), F.col("hit")
    seen = marked.groupBy("qid").agg(
        F.sum(hit * F.col("hits") / rank).alias("precision_sum"),
        F.max(F.when(hit == 1, 1.0 / rank)).alias("rr"),
        *[_gain(F.col("rel"), rank, k).alias(f"gain_{k}") for k in cutoffs],
        *[F.sum(F.when(rank <= k, hit).otherwise(0)).alias(f"hits_{k}") for k in cutoffs],
    )
    joined = judged.join(ideal, "qid", "left").join(seen, "qid", "left").fillna(0)

    def share(top: Column, bottom: Column) -> Column:
        return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))

    columns = [
        F.col("qid"),
        share(F.col("precision_sum"), F.col("relevant")).alias("map"),
        F.col("rr").alias("mrr"),
    ]
    for k in cutoffs:
        hits = F.col(f"hits_{k}")
        columns += [
            share(F.col(f"gain_{k}"), F.col(f"ideal_{k}")).alias(f"ndcg_{k}"),
            (hits / F.lit(float(k))).alias(f"precision_{k}"),
            share(hits, F.col("relevant")).alias(f"recall_{k}"),
            # 2PR/(P+R) with P = hits/k and R = hits/relevant.
            share(2.0 * hits, F.col("relevant") + k).alias(f"f1_{k}"),
        ]
    return joined.select(*columns)


def mean_metrics(per_query: DataFrame) -> DataFrame:
    """``(metric, value)``: the mean of each metric and the number of queries."""
    names = [name for name in per_query.columns if name != "qid"]
    means = per_query.agg(
        F.count(F.lit(1)).cast("double").alias("queries"), *[F.avg(name).alias(name) for name in names]
    )
    return means.unpivot([], ["queries", *names], "metric", "value")
