"""TF-IDF vocabulary and document vectors.

Everything is made row by row, or by a join or grouping by document. On a corpus distributed by
``doc_id`` none of it shuffles documents; only n-gram totals are exchanged.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docquarry.config import DEFAULTS, Settings
from docquarry.functions.scoring import smooth_idf
from docquarry.functions.text import gram_words, ngrams, term_counts
from docquarry.session import join_hot, store

# The functions below that run in tasks travel with the job: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def with_text_grams(df: DataFrame, text: Column, settings: Settings = DEFAULTS) -> DataFrame:
    """Add ``grams``: the n-grams of the words of a text, in order, with repeats."""
    return df.withColumn("grams", ngrams(gram_words(text), settings.ngram_max))


def with_grams(corpus: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return with_text_grams(corpus, F.array_join("tokens", " "), settings)


def document_gram_counts(grams: DataFrame) -> DataFrame:
    """``(doc_id, gram, tf)``, one row of each document; grams are counted within their row."""
    held = grams.select("doc_id", F.explode_outer(term_counts(F.col("grams"))).alias("held")).where("held.term is not null")
    return held.select("doc_id", F.col("held.term").alias("gram"), F.col("held.tf").cast("long").alias("tf"))


def gram_counts(grams: DataFrame) -> DataFrame:
    """Total count ``n`` and document frequency ``df`` of each n-gram."""
    return (
        document_gram_counts(grams)
        .groupBy("gram")
        .agg(F.sum("tf").alias("n"), F.count(F.lit(1)).alias("df"))
    )


def count_threshold(counts: DataFrame, size: int) -> int:
    """The count of the ``size``-th most frequent gram, or of the last one.

    Grams are first grouped by their count, so one task orders the distinct counts only, whose
    number grows with the square root of the text.
    """
    above = Window.orderBy(F.col("n").desc()).rowsBetween(Window.unboundedPreceding, -1)
    sizes = counts.groupBy("n").agg(F.count(F.lit(1)).alias("grams"))
    reached = sizes.withColumn("before", F.coalesce(F.sum("grams").over(above), F.lit(0)))
    lowest = reached.where(F.col("before") < size).agg(F.min("n")).first()[0]
    return lowest or 0


def vocabulary(counts: DataFrame, documents: int, settings: Settings = DEFAULTS) -> DataFrame:
    """``(gram, idx, n, df, idf)`` of the most frequent grams; ties at the cut go by gram.

    Only grams at or above the count threshold are sorted: fewer than ``max_features`` of them
    plus the ties.
    """
    frequent = counts.where(F.col("n") >= count_threshold(counts, settings.max_features))
    kept = frequent.orderBy(F.col("n").desc(), "gram").limit(settings.max_features)
    place = Window.orderBy(F.col("n").desc(), F.col("gram"))
    return kept.select(
        "gram",
        (F.row_number().over(place) - 1).alias("idx"),
        "n",
        "df",
        smooth_idf(documents, F.col("df")).alias("idf"),
    )


def _vectors(lists: pa.Array, known: pa.Array, places: np.ndarray, idf: np.ndarray) -> pa.StructArray:
    """``(indices, values)`` of each list of grams; ``known`` are the grams that have these places and idfs."""
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    found = pc.index_in(lists.flatten(), value_set=known.cast(lists.type.value_type)).fill_null(-1)
    found = found.to_numpy(zero_copy_only=False).astype(np.int64)
    hit = found >= 0
    rows = np.repeat(np.arange(len(lists)), lengths)[hit]
    entries, tf = np.unique(rows * len(known) + found[hit], return_counts=True)
    rows, at = np.divmod(entries, max(len(known), 1))
    weights = tf * idf[at]
    norms = np.sqrt(np.bincount(rows, weights * weights, len(lists)))
    ends = pa.array(np.searchsorted(rows, np.arange(len(lists) + 1)).astype(np.int32))
    columns = [pa.ListArray.from_arrays(ends, pa.array(column)) for column in (places[at], weights / norms[rows])]
    return pa.StructArray.from_arrays(columns, ["indices", "values"])


def vector_column(vocabulary: DataFrame, grams: Column) -> Column:
    """``struct<indices, values>``: the unit-length tf-idf weights of an array of grams, by place.

    The vocabulary goes to every task; each row is looked up and added up on its own.
    """
    table = vocabulary.select("gram", F.col("idx").cast("int"), F.col("idf").cast("double")).toArrow().combine_chunks()
    known = pa.concat_arrays(table["gram"].chunks) if len(table) else pa.array([], pa.string())
    shared = vocabulary.sparkSession.sparkContext.broadcast(
        (known, table["idx"].to_numpy().astype(np.int32), table["idf"].to_numpy().astype(np.float64))
    )

    @F.arrow_udf("struct<indices: array<int>, values: array<double>>")
    def vectors(lists: pa.Array) -> pa.Array:
        return _vectors(lists, *shared.value)

    return vectors(grams)


@dataclass(frozen=True)
class TfidfModel:
    """The fitted vocabulary ``(gram, idx, n, df, idf)`` and its size."""

    table: DataFrame
    size: int

    def transform(self, df: DataFrame, key: str = "doc_id", settings: Settings = DEFAULTS) -> DataFrame:
        """``(key, indices, values)``: unit-length tf-idf weights of the rows' ``grams``.

        Unknown grams are ignored; a row without a known one gets empty arrays. ``key`` must be
        unique per row.
        """
        if self.size <= settings.broadcast_rows:
            rows = df.select(key, vector_column(self.table, F.col("grams")).alias("vector"))
            return rows.select(key, "vector.indices", "vector.values")
        weights = (F.col("tf") * F.col("idf")).alias("weight")
        entries = F.collect_list(F.when(F.col("idx").isNotNull(), F.struct("idx", "weight")))
        found = (
            df.select(key, F.explode_outer("grams").alias("gram"))
            .join(self.table.select("gram", "idx", "idf"), "gram", "left")
            .groupBy(key, "idx", "idf")
            .agg(F.count(F.lit(1)).alias("tf"))
            .select(key, "idx", weights)
            .groupBy(key)
            .agg(entries.alias("entries"), F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
        )
        return found.select(
            key,
            F.col("entries.idx").alias("indices"),
            F.transform("entries.weight", lambda weight: weight / F.col("norm")).alias("values"),
        )


def fit_tfidf(train: DataFrame, settings: Settings = DEFAULTS) -> TfidfModel:
    """Fit on a corpus table; vocabulary and idf come from its documents only."""
    counts = store(gram_counts(with_grams(train, settings)), "gram_counts")
    table = store(vocabulary(counts, train.count(), settings), "tfidf_vocabulary")
    return TfidfModel(table, table.count())


def long_weights(vectors: DataFrame, model: TfidfModel, key: str = "doc_id", settings: Settings = DEFAULTS) -> DataFrame:
    """``(key, gram, weight)`` rows of transformed documents."""
    # Outer: for an inner one Spark asks for the size of the arrays first, and makes the vectors twice.
    entries = vectors.select(key, F.inline_outer(F.arrays_zip("indices", "values"))).select(
        key, F.col("indices").alias("idx"), F.col("values").alias("weight")
    ).where("idx is not null")
    return join_hot(entries, model.table.select("idx", "gram"), "idx", key, settings.broadcast_rows).drop("idx")
