"""Stored stages shared by the registered queries: corpus and index of one data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.config import ACT_COLUMNS, DEFAULTS
from docquarry.operators import judgments, labels, svm, tagging_metrics
from docquarry.operators.clean import blank_to_null, clean_acts
from docquarry.operators.corpus import build_corpus, with_query_tokens
from docquarry.operators.index import Index, build_index
from docquarry.operators.retrieve import weighted_terms
from docquarry.operators.search import Tagger, TagIndex, build_tag_index, search
from docquarry.operators.tfidf import TfidfModel, fit_tfidf, vector_column, with_grams
from docquarry.plans.fixtures import id_map, judgment_lines, query_set, raw_acts
from docquarry.session import store


# Intercept of the fixed coefficient table.
INTERCEPT = -0.0625


def sign_coefficients(train: DataFrame, vocabulary: DataFrame, rows: int) -> DataFrame:
    """A coefficient table that SQL can rebuild.

    +1 where a gram's share of documents is greater with the label than without it, else -1, over
    all grams of the vocabulary that occur with the label. Shares are compared as whole numbers.

    ``train`` has a row per document with ``grams`` and ``kept_tags``. A row holds all that a document
    adds, so the places of its known grams meet its distinct labels without a grouping or a join of documents.
    """
    places = vector_column(vocabulary, F.col("grams")).getField("indices")
    # Exploded as outer: for an inner one Spark asks for the size first, and makes the places twice.
    held = train.select(F.array_distinct("kept_tags").alias("labels"), places.alias("places"))
    together = (
        held.select("labels", F.explode_outer("places").alias("idx"))
        .select("idx", F.explode("labels").alias("label"))
        .groupBy("label", "idx")
        .agg(F.count(F.lit(1)).alias("both"))
        .join(F.broadcast(vocabulary.select("idx", "df")), "idx")  # at most max_features rows
    )
    labelled = train.select(F.explode(F.array_distinct("kept_tags")).alias("label"))
    sizes = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    more = F.col("both") * (rows - F.col("size")) > (F.col("df") - F.col("both")) * F.col("size")
    return together.join(sizes, "label").select(
        "label", "idx", F.when(more, 1.0).otherwise(-1.0).alias("coef")
    )


class Stages:
    """Builds each stage once, on first use, as tables in the shared folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._built: dict[str, object] = {}

    def once(self, name: str, build):
        if name not in self._built:
            self._built[name] = build()
        return self._built[name]

    def acts(self) -> DataFrame:
        known = blank_to_null(raw_acts(self.spark, self.sf_dir), ACT_COLUMNS)
        return clean_acts(known, carry=("row_no",))

    @property
    def corpus(self) -> DataFrame:
        return self.once("corpus", lambda: build_corpus(self.acts(), "row_no", DEFAULTS))

    @property
    def index(self) -> Index:
        return self.once("index", lambda: build_index(self.corpus))

    def queries(self) -> DataFrame:
        return with_query_tokens(query_set(self.spark, self.sf_dir))

    @property
    def query_terms(self) -> DataFrame:
        return self.once("query_terms", lambda: weighted_terms(self.queries(), self.index))

    # --- labels and vectors ---

    @property
    def label_vocabulary(self) -> DataFrame:
        return self.once("label_vocabulary", lambda: store(labels.top_labels(self.corpus), "label_vocabulary"))

    @property
    def label_names(self) -> list[str]:
        return self.once("label_names", lambda: labels.label_names(self.label_vocabulary))

    def kept(self) -> DataFrame:
        """Documents with a vocabulary tag, their targets and their side of the split."""
        return labels.with_split(
            labels.binarized(labels.with_kept_tags(self.corpus, self.label_names), self.label_names)
        )

    def kept_pairs(self, is_test: bool | None = None) -> DataFrame:
        rows = self.kept()
        if is_test is not None:
            rows = rows.where(F.col("is_test") == is_test)
        return rows.select("doc_id", F.explode(F.array_distinct("kept_tags")).alias("label"))

    @property
    def train_rows(self) -> int:
        return self.once("train_rows", lambda: self.kept().where("not is_test").count())

    @property
    def test_rows(self) -> int:
        return self.once("test_rows", lambda: self.kept().where("is_test").count())

    @property
    def tfidf(self) -> TfidfModel:
        return self.once("tfidf", lambda: fit_tfidf(self.kept().where("not is_test")))

    def vectors(self, rows: DataFrame | None = None) -> DataFrame:
        source = self.corpus if rows is None else rows
        return self.tfidf.transform(with_grams(source))

    # --- the fixed coefficient table and what follows from it ---

    @property
    def tagger(self) -> Tagger:
        def build() -> Tagger:
            train = with_grams(self.kept().where("not is_test"))
            signs = sign_coefficients(train, self.tfidf.table, self.train_rows)
            model = svm.LinearModel.from_coefficients(
                self.label_names, signs, self.tfidf.size, INTERCEPT
            )
            return Tagger(self.tfidf, model)

        return self.once("tagger", build)

    @property
    def tag_index(self) -> TagIndex:
        return self.once("tag_index", lambda: build_tag_index(self.vectors(), self.tagger.model))

    @property
    def cells(self) -> DataFrame:
        return self.once("cells", lambda: self.outcomes(self.tag_index))

    def outcomes(self, tag_index: TagIndex) -> DataFrame:
        test = self.kept().where("is_test").select("doc_id")
        guessed = tag_index.label_index().join(test, "doc_id", "left_semi")
        met = tagging_metrics.outcome_cells(self.kept_pairs(True), guessed)
        return store(met, "cells", bucket_by="doc_id", distributed=True)

    # --- the fitted model ---

    @property
    def training_table(self) -> DataFrame:
        def build() -> DataFrame:
            train = self.kept().where("not is_test")
            joined = self.vectors(train).join(train.select("doc_id", "targets"), "doc_id")
            return store(joined, "training")

        return self.once("training_table", build)

    @property
    def fitted(self) -> tuple[svm.LinearModel, object]:
        return self.once(
            "fitted", lambda: svm.fit_model(self.training_table, self.label_names, self.tfidf.size)
        )

    @property
    def fitted_tag_index(self) -> TagIndex:
        return self.once("fitted_tag_index", lambda: build_tag_index(self.vectors(), self.fitted[0]))

    # --- judgments and the evaluation run ---

    def parsed_judgments(self) -> DataFrame:
        return judgments.parse_judgments(judgment_lines(self.spark, self.sf_dir), "line_no")

    @property
    def mapped_judgments(self) -> DataFrame:
        def build() -> DataFrame:
            ids = judgments.clean_id_map(id_map(self.spark, self.sf_dir), "row_no")
            kept = judgments.vocabulary_judgments(self.parsed_judgments(), self.label_vocabulary)
            return store(judgments.mapped_judgments(kept, ids).select("line_no", "qid", "doc_id", "rel"), "judged")

        return self.once("mapped_judgments", build)

    def evaluation_queries(self, limit: int | None = None) -> DataFrame:
        return judgments.evaluation_queries(self.mapped_judgments, "line_no", limit)

    @property
    def evaluation_judgments(self) -> DataFrame:
        def build() -> DataFrame:
            final = judgments.final_judgments(self.mapped_judgments, "line_no")
            return store(final.join(self.evaluation_queries().select("qid"), "qid", "left_semi"), "evaluation_judgments")

        return self.once("evaluation_judgments", build)

    @property
    def evaluation_run(self) -> DataFrame:
        def build() -> DataFrame:
            label_queries = self.evaluation_queries().select(
                "qid",
                F.col("qid").alias("raw_query"),
                F.replace(F.col("qid"), F.lit(" "), F.lit("_")).alias("target_label"),
            )
            found = search(label_queries, self.index, self.tag_index, self.tagger, k=50)
            return store(found.where("rank is not null").select("qid", "doc_id", "score", "rank"), "run")

        return self.once("evaluation_run", build)


_stages: dict[tuple[str, str], Stages] = {}


def stages(spark: SparkSession, sf_dir: str) -> Stages:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stages:
        _stages[key] = Stages(spark, sf_dir)
    return _stages[key]
