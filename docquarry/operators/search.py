"""Search over a table of queries: pick the candidates, rank them, assemble the answers.

Method per query, first match:

* a target label in the vocabulary: that label's documents, ``classifier_eval``
* predicted tags: the union of their documents, ``ml_prediction + bm25``; if the union is empty,
  documents with any query token, ``boolean_fallback``
* no tags and no tokens: nothing, ``none``
* no tags: documents with any query token, ``boolean_only``
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docquarry.config import DEFAULTS, Settings
from docquarry.operators.corpus import with_query_tokens
from docquarry.operators.index import Index
from docquarry.operators.retrieve import bm25_scores, top_k, union_retrieval, weighted_terms
from docquarry.operators.svm import LinearModel, predict
from docquarry.operators.tfidf import TfidfModel, with_text_grams
from docquarry.session import fits, join_hot, store


@dataclass(frozen=True)
class Tagger:
    """A fitted vocabulary and the linear models over it."""

    tfidf: TfidfModel
    model: LinearModel


# Smallest ids kept of each label: as many candidates without a matching token as a search may ask for.
HEADS = 1000

# Labels that one word of bits holds.
WORD_BITS = 62


@dataclass(frozen=True)
class TagIndex:
    """Tables of the tagged corpus.

    ``doc_labels(doc_id, labels)`` is hash-distributed like the postings. ``combos(labels, n)``
    counts the documents of each distinct set of labels. ``heads(label, doc_id, place)`` holds the
    ``HEADS`` smallest ids of each label.
    """

    doc_labels: DataFrame
    combos: DataFrame
    heads: DataFrame

    def label_index(self, only: DataFrame | None = None) -> DataFrame:
        """``(label, doc_id)`` rows; ``only`` is a table of the ``doc_id`` to keep, such as a test side."""
        rows = self.doc_labels
        if only is not None:
            rows = rows.join(only.select("doc_id"), "doc_id", "left_semi")
        return rows.select(F.explode_outer("labels").alias("label"), "doc_id").where("label is not null")


def tag_documents(vectors: DataFrame, model: LinearModel) -> DataFrame:
    """Labels of every document of the corpus."""
    return predict(vectors, model)


def build_tag_index(vectors: DataFrame, model: LinearModel) -> TagIndex:
    doc_labels = store(
        tag_documents(vectors, model), "doc_labels", bucket_by="doc_id", sort_by=("doc_id",), distributed=True
    )
    combos = doc_labels.where(F.size("labels") > 0).groupBy("labels").agg(F.count(F.lit(1)).alias("n"))
    return TagIndex(doc_labels, store(combos, "label_combos"), store(label_heads(doc_labels), "label_heads"))


def label_heads(doc_labels: DataFrame, most: int = HEADS) -> DataFrame:
    """``(label, doc_id, place)``: the smallest ids of each label. Spark keeps at most ``most`` per task before the shuffle."""
    rows = doc_labels.select(F.explode_outer("labels").alias("label"), "doc_id").where("label is not null")
    by_id = Window.partitionBy("label").orderBy("doc_id")
    return rows.withColumn("place", F.row_number().over(by_id)).where(F.col("place") <= most)


def query_vectors(queries: DataFrame, tfidf: TfidfModel, query_text: str = "raw", settings: Settings = DEFAULTS) -> DataFrame:
    """Vectors of the query text: as typed, or of its ``tokens``. Rows that share an id add up to one."""
    if query_text not in ("raw", "tokens"):
        raise ValueError("query_text is 'raw' or 'tokens'")
    text = F.col("raw_query") if query_text == "raw" else F.array_join("tokens", " ")
    grams = with_text_grams(queries, text, settings).groupBy("qid").agg(F.flatten(F.collect_list("grams")).alias("grams"))
    return tfidf.transform(grams, key="qid", settings=settings)


def classify_queries(queries: DataFrame, tagger: Tagger, query_text: str = "raw", settings: Settings = DEFAULTS) -> DataFrame:
    """``(qid, labels)``: predicted tags of each query in vocabulary rank order."""
    return predict(query_vectors(queries, tagger.tfidf, query_text, settings), tagger.model, key="qid")


def normal_label(name: Column) -> Column:
    return F.lower(F.replace(name, F.lit("_"), F.lit(" ")))


def matched_target(target: Column, labels: list[str], strict: bool = False) -> Column:
    """The vocabulary label that a requested label names, else NULL.

    ``strict`` compares as given; otherwise ``_`` counts as a space and case is ignored on both
    sides.
    """
    wanted = target if strict else normal_label(target)
    hits = F.filter(
        F.array(*[F.lit(label) for label in labels]),
        lambda label: (label if strict else normal_label(label)) == wanted,
    )
    return F.when(target.isNotNull() & (target != ""), F.get(hits, F.lit(0)))


def label_bits(held: Column, names: list[str]) -> list[Column]:
    """One bit per name that the array holds, in words of ``WORD_BITS`` bits."""
    words = []
    for start in range(0, len(names), WORD_BITS):
        bits = F.create_map(*[F.lit(x) for i, name in enumerate(names[start: start + WORD_BITS]) for x in (name, 1 << i)])
        bit = lambda label, bits=bits: F.coalesce(F.try_element_at(bits, label), F.lit(0)).cast("long")
        words.append(F.aggregate(held, F.lit(0).cast("long"), lambda word, label: word.bitwiseOR(bit(label))))
    return words


def tag_set_hits(tag_sets: DataFrame, combos: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Documents with any label of a tag set, counted from the distinct label sets.

    ``tag_sets`` has ``tags``; the result adds ``tag_hits``. No document row is touched. Each tag set meets each
    distinct label set once, as bits of the labels that any tag set holds; the label sets are spread over all cores.
    """
    wanted = tag_sets.select("tags").distinct()
    # At most the vocabulary of labels.
    names = sorted(row.label for row in wanted.select(F.explode("tags").alias("label")).distinct().collect())
    words = range(-(-len(names) // WORD_BITS))
    tag_words, label_words = [f"tag_word_{i}" for i in words], [f"label_word_{i}" for i in words]
    if not names:
        return wanted.where("false").withColumn("tag_hits", F.lit(0).cast("long"))
    wanted = wanted.withColumns(dict(zip(tag_words, label_bits(F.col("tags"), names))))
    cores = combos.sparkSession.sparkContext.defaultParallelism
    held = combos.select("n", *[bits.alias(name) for name, bits in zip(label_words, label_bits(F.col("labels"), names))])
    held = held.repartition(cores, *label_words).groupBy(*label_words).agg(F.sum("n").alias("n"))
    sought = wanted.select(*tag_words).distinct()
    if fits(sought, settings.broadcast_rows):
        sought = F.broadcast(sought)
    shared = [F.col(tag).bitwiseAND(F.col(label)) != 0 for tag, label in zip(tag_words, label_words)]
    hits = held.join(sought, reduce(or_, shared)).groupBy(*tag_words).agg(F.sum("n").alias("tag_hits"))
    return wanted.join(hits, tag_words).select("tags", "tag_hits")


def choose_methods(
    queries: DataFrame, tags: DataFrame, tag_index: TagIndex, labels: list[str], strict: bool = False,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Add ``tags``, ``tag_hits`` and ``method`` to queries with ``tokens`` and ``target_label``."""
    target = matched_target(F.col("target_label"), labels, strict)
    chosen = (
        queries.join(tags.select("qid", "labels"), "qid", "left")
        .withColumn("target", target)
        .withColumn("tags", F.when(F.col("target").isNotNull(), F.array("target")).otherwise(F.col("labels")))
        .drop("labels")
    )
    # Only queries with tags have hits to look up, so untagged ones do not meet in one task.
    hits = store(tag_set_hits(chosen.where(F.size("tags") > 0), tag_index.combos, settings), "tag_hits")
    tagged = join_hot(chosen.where(F.size("tags") > 0).select("qid", "tags"), hits, "tags", "qid", settings.broadcast_rows)
    counted = chosen.join(tagged.select("qid", "tag_hits"), "qid", "left").withColumn(
        "tag_hits", F.coalesce("tag_hits", F.lit(0))
    )
    method = (
        F.when(F.col("target").isNotNull(), "classifier_eval")
        .when((F.size("tags") > 0) & (F.col("tag_hits") > 0), "ml_prediction + bm25")
        .when(F.size("tags") > 0, "boolean_fallback")
        .when(F.size("tokens") == 0, "none")
        .otherwise("boolean_only")
    )
    return counted.withColumn("method", method).withColumn(
        "by_tags", F.col("method").isin("classifier_eval", "ml_prediction + bm25")
    )


def ranked_candidates(
    chosen: DataFrame, terms: DataFrame, index: Index, tag_index: TagIndex, k: int, settings: Settings = DEFAULTS
) -> DataFrame:
    """The k best candidates of each query.

    Scores are summed where the postings lie. Tag-restricted queries keep scored documents that
    share a tag. Candidates without a matching token score 0.0 and only matter for queries with
    fewer than k scored ones; the k smallest ids of each label always hold enough of them.
    """
    plan = chosen.select("qid", "by_tags", "tags")
    if fits(plan, settings.broadcast_rows):
        plan = F.broadcast(plan)
    scored = (
        bm25_scores(terms, index, settings)
        .join(tag_index.doc_labels, "doc_id", "left")
        .join(plan, "qid")
        .where(~F.col("by_tags") | F.arrays_overlap("tags", "labels"))
        .select("qid", "doc_id", "score")
    )
    if k > HEADS:
        raise ValueError(f"k is at most {HEADS}")
    heads = tag_index.heads.where(F.col("place") <= k).select("label", "doc_id")
    unscored = (
        chosen.where("by_tags")
        .select("qid", F.explode("tags").alias("label"))
        .join(heads, "label")
        .select("qid", "doc_id", F.lit(0.0).alias("score"))
    )
    best = top_k(scored, k, settings).select("qid", "doc_id", "score").unionByName(unscored)
    return top_k(best.groupBy("qid", "doc_id").agg(F.max("score").alias("score")), k, settings)


def search(
    queries: DataFrame,
    index: Index,
    tag_index: TagIndex,
    tagger: Tagger,
    k: int = 10,
    query_text: str = "raw",
    strict_label_match: bool = False,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Answer every row of ``(qid, raw_query, target_label)``.

    One row per result: ``qid, method, tokens, tags, total_hits, rank, doc_id, score``. A query
    without results has one row with a NULL rank.
    """
    tokenized = with_query_tokens(queries.select("qid", "raw_query", "target_label"), settings=settings)
    # Stored: the plan below reads the tags of each query more than once.
    tags = store(classify_queries(tokenized, tagger, query_text, settings), "query_tags")
    chosen = store(
        choose_methods(tokenized, tags, tag_index, tagger.model.labels, strict_label_match, settings), "search_plan"
    )
    terms = weighted_terms(chosen, index)
    ranked = ranked_candidates(chosen, terms, index, tag_index, k, settings)
    free = terms.join(chosen.where("not by_tags").select("qid"), "qid", "left_semi")
    union_hits = (
        union_retrieval(free, index, settings).groupBy("qid").agg(F.count(F.lit(1)).alias("union_hits"))
    )
    return (
        chosen.join(union_hits, "qid", "left")
        .withColumn(
            "total_hits",
            F.when(F.col("by_tags"), F.col("tag_hits")).otherwise(F.coalesce("union_hits", F.lit(0))),
        )
        .join(ranked, "qid", "left")
        .select("qid", "method", "tokens", "tags", "total_hits", "rank", "doc_id", "score")
    )


def responses(results: DataFrame) -> DataFrame:
    """One row per query; ``top_results`` is an array of ``(doc_id, score)`` in rank order."""
    listed = F.array_sort(
        F.collect_list(F.when(F.col("rank").isNotNull(), F.struct("rank", "doc_id", "score")))
    )
    return (
        results.groupBy("qid", "method", "tokens", "tags", "total_hits")
        .agg(listed.alias("listed"))
        .select(
            "qid",
            F.col("tokens").alias("query_tokens"),
            F.col("tags").alias("predicted_tags"),
            "total_hits",
            F.transform("listed", lambda r: F.struct(r["doc_id"].alias("doc_id"), r["score"].alias("score"))).alias(
                "top_results"
            ),
            "method",
        )
    )
