"""Retrieval for whole tables of queries: candidates, BM25 scores and top-k.

A query table has ``qid`` and ``tokens``; every result is keyed by ``qid``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docquarry.config import DEFAULTS, Settings
from docquarry.functions.scoring import bm25_idf, bm25_saturation
from docquarry.operators.index import Index
from docquarry.session import join_hot, store

# Ranges of terms that a scan of postings is told to look at.
TERM_RANGES = 16


def query_terms(queries: DataFrame) -> DataFrame:
    """``(qid, term, qtf)``; a token that repeats in the query counts again."""
    return (
        queries.select("qid", F.explode("tokens").alias("term"))
        .groupBy("qid", "term")
        .agg(F.count(F.lit(1)).alias("qtf"))
    )


def idf_table(doc_freq: DataFrame, total_documents: int) -> DataFrame:
    return doc_freq.select("term", "df", bm25_idf(total_documents, F.col("df")).alias("idf"))


def weighted_terms(queries: DataFrame, index: Index) -> DataFrame:
    """Query terms the index knows, with ``qtf`` and idf, stored because two plans read them."""
    known = query_terms(queries).join(idf_table(index.doc_freq, index.total_documents), "term")
    return store(known.select("qid", "term", "qtf", "idf"), "query_terms")


def term_ranges(terms: DataFrame, most: int = TERM_RANGES) -> list[tuple[str, str]]:
    """At most ``most`` ranges that hold every term, in order.

    Terms with the same first two characters are a range, a term without such neighbours a range of its own.
    Neighbouring ranges are merged while there are too many, so the predicate has a fixed size.
    """
    first = F.substring("term", 1, 2)
    rows = terms.groupBy(first.alias("first")).agg(F.min("term").alias("low"), F.max("term").alias("high"))
    found = sorted((row.low.encode(), row.high.encode()) for row in rows.collect())
    width = -(-len(found) // most)
    return [(found[i][0].decode(), found[min(i + width, len(found)) - 1][1].decode()) for i in range(0, len(found), width or 1)]


def pruned_postings(terms: DataFrame, index: Index) -> DataFrame:
    """The postings in the ranges of the terms. Files are sorted by term, so the scan skips what lies between."""
    term, wanted = F.col("term"), F.lit(False)
    for low, high in term_ranges(terms):
        wanted = wanted | (term == low if low == high else term.between(low, high))
    return index.postings.where(wanted)


def matching_postings(terms: DataFrame, index: Index, settings: Settings = DEFAULTS) -> DataFrame:
    """Postings joined to the query terms; common terms do not pile up in one task."""
    return join_hot(pruned_postings(terms, index), terms, "term", "doc_id", settings.broadcast_rows)


def union_retrieval(terms: DataFrame, index: Index, settings: Settings = DEFAULTS) -> DataFrame:
    """Documents that hold any term of the query."""
    return matching_postings(terms.select("qid", "term"), index, settings).select("qid", "doc_id").distinct()


def bm25_scores(terms: DataFrame, index: Index, settings: Settings = DEFAULTS) -> DataFrame:
    """``(qid, doc_id, score)`` for every document with a matching term."""
    share = (
        F.col("qtf")
        * F.col("idf")
        * bm25_saturation(F.col("tf"), F.col("length"), index.avgdl, settings.k1, settings.b)
    )
    return (
        matching_postings(terms, index, settings)
        .groupBy("qid", "doc_id")
        .agg(F.sum(share).alias("score"))
    )


def restricted_scores(
    query_labels: DataFrame, doc_labels: DataFrame, scores: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """``(qid, doc_id, score)`` of all documents that carry a label of the query; one without a matching token keeps 0.0.

    ``query_labels`` has ``qid`` and ``label``, ``doc_labels`` has ``doc_id`` and ``labels``. The scores of a
    document become one row, which meets its labels where both lie: tables distributed on ``doc_id`` are not
    shuffled, nor are the scores.
    """
    by_document = scores.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("qid", "score"))).alias("scored"))
    labelled = doc_labels.join(by_document, "doc_id", "left").select("doc_id", "scored", F.explode("labels").alias("label"))
    found = join_hot(labelled, query_labels, "label", "doc_id", settings.broadcast_rows)
    score = F.coalesce(F.try_element_at("scored", F.col("qid")), F.lit(0.0))
    return found.select("qid", "doc_id", score.alias("score")).groupBy("qid", "doc_id").agg(F.max("score").alias("score"))


def top_k(scores: DataFrame, k: int, settings: Settings = DEFAULTS) -> DataFrame:
    """The k best documents per query with their rank; ties go to the smaller id.

    Scores that agree to ``score_digits`` places tie, so the order of a sum cannot decide a rank.
    Spark keeps at most k rows per query in each task before the shuffle.
    """
    best_first = Window.partitionBy("qid").orderBy(
        F.round("score", settings.score_digits).desc(), F.col("doc_id")
    )
    return scores.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)


def hit_counts(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates per query before any cut; 0 for a query without one."""
    counted = candidates.groupBy("qid").agg(F.count(F.lit(1)).alias("total_hits"))
    return (
        queries.select("qid")
        .join(counted, "qid", "left")
        .select("qid", F.coalesce("total_hits", F.lit(0)).alias("total_hits"))
    )


def label_documents(
    query_labels: DataFrame, label_index: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """Union of the documents of all labels of a query; both tables carry ``label``."""
    found = join_hot(label_index, query_labels, "label", "doc_id", settings.broadcast_rows)
    return found.select("qid", "doc_id").distinct()
