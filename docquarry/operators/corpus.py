"""From cleaned acts to the corpus table of token arrays."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docquarry.config import DEFAULTS, ID_COLUMN, TAG_COLUMN, TEXT_COLUMN, Settings
from docquarry.functions.text import cap_text, document_tokens, kept_words, listed, query_tokens, rows_of, singular, singulars
from docquarry.operators.clean import require_columns
from docquarry.session import fits, store

# The functions below that run in tasks travel with the job: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def with_tokens(df: DataFrame, text_column: str = TEXT_COLUMN, settings: Settings = DEFAULTS) -> DataFrame:
    """Add the column ``tokens``; all other columns stay."""
    require_columns(df, [text_column])
    return df.withColumn("tokens", document_tokens(F.col(text_column), settings))


def _lemmas(lists: pa.Array, surfaces: pa.Array, starts: np.ndarray, lemmas: pa.Array) -> pa.Array:
    """The lemmas of each list of words; surface ``i`` has those from ``starts[i]`` on. Other words get their singular."""
    coded = lists.flatten().dictionary_encode()
    found = pc.index_in(coded.dictionary, value_set=surfaces).fill_null(-1).to_numpy()
    # After the lemmas come the singulars of the distinct words.
    tokens = pa.concat_arrays([lemmas, singulars(coded.dictionary)])
    begin = np.where(found >= 0, starts[found], len(lemmas) + np.arange(len(found)))
    sizes = np.where(found >= 0, starts[found + 1] - starts[found], 1)
    codes = coded.indices.to_numpy()
    times = sizes[codes]
    ends = np.cumsum(times)
    at = np.repeat(begin[codes] - (ends - times), times) + np.arange(times.sum())
    return listed(np.repeat(rows_of(lists), times), tokens.take(pa.array(at)), lists)


def looked_up(kept: Column, lemmas: DataFrame) -> Column:
    """An array of words as an array of lemmas; the table goes to every task. A word with several lemmas becomes all of them."""
    known = lemmas.where("surface is not null").select("surface", F.coalesce("lemma", singular(F.col("surface"))).alias("lemma"))
    table = known.toArrow().sort_by([("surface", "ascending"), ("lemma", "ascending")])
    coded = pa.chunked_array(table["surface"].chunks, pa.string()).combine_chunks().dictionary_encode()
    codes = coded.indices.to_numpy()
    starts = np.append(np.searchsorted(codes, np.arange(len(coded.dictionary) + 1)), len(codes))
    held = pa.chunked_array(table["lemma"].chunks, pa.string()).combine_chunks()
    shared = lemmas.sparkSession.sparkContext.broadcast((coded.dictionary, starts, held))

    @F.arrow_udf("array<string>")
    def lemma(lists: pa.Array) -> pa.Array:
        return _lemmas(lists, *shared.value)

    return lemma(kept)


def with_lemma_table(
    df: DataFrame, lemmas: DataFrame, key: str, text_column: str = TEXT_COLUMN, settings: Settings = DEFAULTS,
    letters_only: bool = True,
) -> DataFrame:
    """Like ``with_tokens`` (or, without ``letters_only``, the tokens of queries), with lemmas looked up in a table ``(surface, lemma)``.

    Words the table lacks fall back to the stemmer. ``key`` must be unique per row. A table of up to
    ``Settings.broadcast_rows`` words goes to every task and each text is looked up on its own; a larger one is
    joined with the exploded words.
    """
    require_columns(df, [text_column, key])
    kept = kept_words(F.col(text_column), settings, letters_only)
    if fits(lemmas, settings.broadcast_rows):
        return df.withColumn("tokens", F.coalesce(looked_up(kept, lemmas), F.array().cast("array<string>")))
    surface = df.select(key, F.posexplode_outer(kept).alias("pos", "surface")).where("pos is not null")
    found = surface.join(lemmas.select("surface", "lemma"), "surface", "left").select(
        key, "pos", F.coalesce("lemma", singular(F.col("surface"))).alias("token")
    )
    # One group is one document, so its size is that of a single text.
    tokens = found.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "token"))).alias("placed"))
    tokens = tokens.select(key, F.col("placed.token").alias("tokens"))
    return df.join(tokens, key, "left").withColumn(
        "tokens", F.coalesce("tokens", F.array().cast("array<string>"))
    )


def with_query_tokens(
    queries: DataFrame, text_column: str = "raw_query", settings: Settings = DEFAULTS, lemmas: DataFrame | None = None,
    key: str = "qid",
) -> DataFrame:
    """Add ``tokens``; with ``lemmas`` by the same table as the documents."""
    if lemmas is not None:
        return with_lemma_table(queries, lemmas, key, text_column, settings, letters_only=False)
    return queries.withColumn("tokens", query_tokens(F.col(text_column), settings))


def last_copy(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the greatest ``order`` for each key.

    ``row_number() <= 1`` is cut down per task before the shuffle, so an id shared by a third of
    all rows sends one row per task.
    """
    newest = Window.partitionBy(key).orderBy(F.col(order).desc())
    return df.withColumn("copy", F.row_number().over(newest)).where("copy = 1").drop("copy")


def text_cap_report(df: DataFrame, cap: int, text_column: str = TEXT_COLUMN) -> DataFrame:
    """Length of each text before and after a character cap."""
    text = F.col(text_column)
    return df.withColumns({
        "n_chars": F.length(text),
        "n_kept": F.length(cap_text(text, cap)),
    }).withColumn("is_cut", F.col("n_chars") > F.col("n_kept"))


def build_corpus(
    acts: DataFrame, order: str, settings: Settings = DEFAULTS, lemmas: DataFrame | None = None
) -> DataFrame:
    """Cleaned acts to the stored table ``(doc_id, row_no, tags, tokens)`` with unique ids.

    ``lemmas`` is a table ``(surface, lemma)`` (see ``with_lemma_table``).

    The table is hash-distributed on ``doc_id``; postings, n-gram counts, scores and tag tables
    are all grouped by document and so need no shuffle of their own.
    """
    unique = last_copy(acts.select(ID_COLUMN, order, TEXT_COLUMN, TAG_COLUMN), ID_COLUMN, order)
    if lemmas is None:
        tokenized = with_tokens(unique, settings=settings)
    else:
        tokenized = with_lemma_table(unique, lemmas, ID_COLUMN, settings=settings)
    return store(
        tokenized.select(
            F.col(ID_COLUMN).alias("doc_id"),
            F.col(order).alias("row_no"),
            F.col(TAG_COLUMN).alias("tags"),
            "tokens",
        ),
        "corpus",
        bucket_by="doc_id",
        distributed=lemmas is None or fits(lemmas, settings.broadcast_rows),
    )
