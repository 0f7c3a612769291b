"""Postings and collection statistics."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquarry.functions.text import rows_of, term_counts
from docquarry.session import bucket_count, store

# The functions below that run in tasks travel with the job: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Index:
    """Tables of a document-partitioned index.

    ``postings(doc_id, term, tf, length)`` is hash-distributed on ``doc_id`` and sorted by term
    within each file: every common term is spread over all files, and scores add up per document
    without a shuffle. A batch of queries reads all postings.
    """

    postings: DataFrame
    doc_freq: DataFrame
    total_documents: int
    avgdl: float


# Rows of a batch that tasks hand back.
STEP = 100_000

# Bits, as a power of 2, of the map that tells which ids repeat.
FILTER_BITS = 24


def _postings(batch: pa.RecordBatch) -> pa.RecordBatch:
    """``(doc_id, term, tf, length)`` of the rows of a batch, by bucket, then term."""
    lists = batch.column("tokens")
    coded = lists.flatten().dictionary_encode(null_encoding="encode")
    terms = pc.array_sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(terms), np.int64)
    rank[terms] = np.arange(len(terms))
    order = np.argsort(batch.column("bucket").to_numpy(), kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    # A key holds bucket, term and row; buckets are numbered by their first row.
    first = np.searchsorted(batch.column("bucket").to_numpy()[order], batch.column("bucket").to_numpy())
    rows = rows_of(lists)
    size, high = max(len(lists), 1), max(len(terms), 1)
    held, tf = np.unique((first[rows] * high + rank[coded.indices.to_numpy()]) * size + place[rows], return_counts=True)
    rows, codes = pa.array(order[held % size]), terms[held // size % high]
    return pa.record_batch(
        [batch.column("doc_id").take(rows), coded.dictionary.take(pa.array(codes)), pa.array(tf.astype(np.int32)),
         lists.value_lengths().take(rows)],
        ["doc_id", "term", "tf", "length"],
    )


def postings(corpus: DataFrame) -> DataFrame:
    """Term frequency and document length per ``(doc_id, term)`` for a corpus with unique ids.

    Terms are counted row by row, so nothing is grouped or shuffled. The rows of a batch come in the order of the
    bucketed table, so that its sort merges a few long runs.
    """
    bucket = F.pmod(F.hash("doc_id"), F.lit(bucket_count(corpus.sparkSession)))
    rows = corpus.select("doc_id", F.col("tokens").cast("array<string>").alias("tokens"), bucket.alias("bucket"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _postings(batch)
            yield from (found.slice(at, STEP) for at in range(0, len(found), STEP))

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(counted, f"doc_id {id_type}, term string, tf int, length int")


def doc_lengths(corpus: DataFrame) -> DataFrame:
    return corpus.select("doc_id", F.size("tokens").alias("length"))


def doc_freq(postings_table: DataFrame) -> DataFrame:
    return postings_table.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def corpus_stats(corpus: DataFrame) -> DataFrame:
    """Rows, tokens and average length; the average of an empty corpus is 0."""
    return corpus.agg(
        F.count(F.lit(1)).alias("total_documents"),
        F.coalesce(F.sum(F.size("tokens").cast("long")), F.lit(0)).alias("total_length"),
        F.coalesce(F.avg(F.size("tokens")), F.lit(0.0)).alias("avgdl"),
    )


def unique_terms(doc_freq_table: DataFrame) -> DataFrame:
    return doc_freq_table.agg(F.count(F.lit(1)).alias("unique_terms"))


def repeated_ids(rows: DataFrame, bits: int = FILTER_BITS) -> Column:
    """Whether the id of a row of ``rows`` repeats: true for all that do, and for a few others.

    Ids are counted by their hash. Those that come more than once are marked in a bit map, which every task gets;
    it has a fixed size, so an id that shares a bit with a repeated one is taken for repeated too.
    """
    code = F.xxhash64("doc_id")
    again = rows.groupBy(code.alias("code")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    places = again.select(F.pmod("code", F.lit(1 << bits)).cast("int").alias("place")).distinct().toArrow()["place"]
    marks = np.zeros(1 << bits, bool)
    marks[places.to_numpy()] = True
    shared = rows.sparkSession.sparkContext.broadcast(np.packbits(marks, bitorder="little"))

    @F.arrow_udf("boolean")
    def marked(at: pa.Array) -> pa.Array:
        place = at.to_numpy()
        return pa.array((shared.value[place >> 3] >> (place & 7) & 1).astype(bool))

    return marked(F.pmod(code, F.lit(1 << bits)).cast("int"))


def overwriting_postings(tokens: DataFrame, order: str) -> DataFrame:
    """Postings when ids repeat: per term the latest copy that holds it wins.

    A term only an earlier copy holds stays. ``tokens`` has ``doc_id``, ``order`` and ``tokens``. Terms are
    counted within each row. Rows whose id comes once stay where they are. The copies of a term of the others meet in
    one shuffle, merged per task before it, so an id that very many rows share sends each of its terms once a task.
    """
    repeats = repeated_ids(tokens)

    def counted(rows: DataFrame) -> DataFrame:
        held = rows.select("doc_id", order, F.explode_outer(term_counts(F.col("tokens"))).alias("held"))
        return held.where("held is not null")

    copies = counted(tokens.where(repeats)).groupBy("held.term", "doc_id").agg(F.max_by("held.tf", order).alias("tf"))
    return counted(tokens.where(~repeats)).select("held.term", "doc_id", "held.tf").unionByName(copies)


def overwriting_lengths(tokens: DataFrame, order: str) -> DataFrame:
    return tokens.groupBy("doc_id").agg(F.max_by(F.size("tokens"), F.col(order)).alias("length"))


def build_index(corpus: DataFrame, on_duplicate: str = "last", order: str | None = None) -> Index:
    """The index of ``(doc_id, tokens)``.

    ``on_duplicate="last"`` expects unique ids (see ``build_corpus``). With ``"overwrite"`` ids may
    repeat, and a later row by ``order`` overwrites term by term: a term that only an earlier copy
    holds stays, lengths are those of the last copy, and every copy counts in the statistics.
    """
    if on_duplicate not in ("last", "overwrite"):
        raise ValueError("on_duplicate is 'last' or 'overwrite'")
    if on_duplicate == "last":
        stored = store(postings(corpus), "postings", bucket_by="doc_id", sort_by=("term",), distributed=True)
    else:
        rows = overwriting_postings(corpus, order).join(overwriting_lengths(corpus, order), "doc_id")
        stored = store(
            rows.select("doc_id", "term", "tf", "length"), "postings", bucket_by="doc_id", sort_by=("term",)
        )
    frequencies = store(doc_freq(stored), "doc_freq")
    stats = corpus_stats(corpus).first()
    return Index(stored, frequencies, stats.total_documents, stats.avgdl)
