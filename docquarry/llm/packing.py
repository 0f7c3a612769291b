"""Packing of token ids into sequences by minimum bin slack.

A document longer than a sequence is cut into full sequences and one remainder. The remainders are packed
by their lengths alone: how many pieces have each length is all that the search needs, at most as many
numbers as a sequence has tokens. Each step takes the longest length left and, with a bitset of the sums
that the other lengths can reach, the multiset that fills the sequence closest to capacity. The multiset
is read back from the bitsets, and is used as often as the counts allow, so each step uses up a length and
the plan stays short however large the corpus is.

Pieces then find their places without a shuffle of ids: the rank of a piece among those of its length
gives its sequence and offset. Ranks are counted in buckets, so a length that holds most pieces is spread.

Defined results: a null or empty text is the end id alone. Repeated rows are packed each. Ids may be null
or repeat. Other columns are ignored. Very long texts give many full sequences. No rows give no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docquarry.llm.common import binary_values, column, steps, store
from docquarry.llm.tokens import crc32, encoder, forget

CAPACITY = 2048
END_ID = 1
# Pieces of one length that are numbered in one task.
BUCKET_PIECES = 250_000

PIECES = "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long"


class Part(NamedTuple):
    """``used`` pieces of a length in each of ``times`` sequences, at ``offset``, from the ``first``-th piece on."""

    length: int
    first: int
    used: int
    times: int
    sequence: int
    offset: int


# --- the plan ---


def best_fill(counts: dict[int, int], room: int) -> tuple[list[int], dict[int, int]]:
    """The reachable sums as a bitset per step, longest lengths first, until the room itself is reached.

    Returns the bitsets (the first one before any length) and, by length, how many pieces each step offers.
    """
    full = (1 << (room + 1)) - 1
    sums, offered = [1], {}
    for length in sorted((n for n in counts if n <= room and counts[n]), reverse=True):
        reach, left, block = sums[-1], min(counts[length], room // length), 1
        offered[length] = left
        while left:  # blocks of 1, 2, 4, ... pieces offer every number of them
            take = min(block, left)
            reach |= (reach << (take * length)) & full
            left -= take
            block *= 2
        sums.append(reach)
        if reach >> room & 1:
            break
    return sums, offered


def read_back(sums: list[int], offered: dict[int, int], total: int) -> dict[int, int]:
    """A multiset of lengths with that total, from the last bitset to the first."""
    chosen: dict[int, int] = {}
    lengths = list(offered)[: len(sums) - 1]
    for step in range(len(lengths), 0, -1):
        length, used = lengths[step - 1], 0
        while not sums[step - 1] >> (total - used * length) & 1:
            used += 1
        if used:
            chosen[length] = used
            total -= used * length
    return chosen


def choose(counts: dict[int, int], seed: int, capacity: int) -> dict[int, int]:
    """The multiset with the seed that fills the sequence closest to capacity."""
    rest = dict(counts)
    rest[seed] -= 1
    sums, offered = best_fill(rest, capacity - seed)
    chosen = read_back(sums, offered, sums[-1].bit_length() - 1)
    chosen[seed] = chosen.get(seed, 0) + 1
    return chosen


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Part]:
    """Every piece of every length in one sequence; the counts are used up."""
    left = {n: c for n, c in counts.items() if c}
    taken = dict.fromkeys(left, 0)
    parts, sequence = [], 0
    while left:
        chosen = choose(left, max(left), capacity)
        times = min(left[n] // used for n, used in chosen.items())
        offset = 0
        for length in sorted(chosen, reverse=True):
            used = chosen[length]
            parts.append(Part(length, taken[length], used, times, sequence, offset))
            offset += used * length
            taken[length] += used * times
            left[length] -= used * times
            if not left[length]:
                del left[length]
        sequence += times
    return parts


def places(parts: list[Part], lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the pieces with these lengths and ranks."""
    ordered = sorted(parts)
    table = np.array(ordered, np.int64).reshape(-1, len(Part._fields))
    found = np.empty((2, len(lengths)), np.int64)
    for length in np.unique(lengths).tolist():
        rows = table[table[:, 0] == length]
        at = np.flatnonzero(lengths == length)
        _, first, used, _, sequence, offset = rows[np.searchsorted(rows[:, 1], ranks[at], "right") - 1].T
        place = ranks[at] - first
        found[0, at] = sequence + place // used
        found[1, at] = offset + place % used * length
    return found[0], found[1]


# --- the corpus ---


def cut_pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, text: str = "text", doc: str = "doc_id"
) -> DataFrame:
    """Pieces of at most ``capacity`` ids: (doc_id, start, length, ids_crc32, doc_tokens)."""
    rows = docs.select(F.col(doc).alias("doc_id"), F.col(text).cast("string").alias("text"))
    types = [pa.int64()] * 4

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            ids, sizes = encoder(path, False).encode(binary_values(column(batch, "text")))
            # The end id after each document's ids.
            ends = np.cumsum(sizes + 1)
            whole = np.full(int(ends[-1]), end_id, "<u4")
            inner = np.ones(len(whole), bool)
            inner[ends - 1] = False
            whole[inner] = ids
            at, out = [], []
            for row, (begin, end) in enumerate(zip((ends - sizes - 1).tolist(), ends.tolist())):
                for start in range(begin, end, capacity):
                    stop = min(start + capacity, end)
                    at.append(row)
                    out.append((start - begin, stop - start, crc32(whole[start:stop]), end - begin))
            columns = [pa.array(c, t) for c, t in zip(zip(*out), types)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.record_batch([column(batch, "doc_id").take(pa.array(at)), *columns], names)
        forget()

    return rows.mapInArrow(cut, PIECES.format(id=rows.schema["doc_id"].dataType.simpleString()))


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """Pieces of all documents with ``sequence_id`` and ``offset``."""
    spark = docs.sparkSession
    # Stored, so that the number of a piece is the same in each later read.
    pieces = cut_pieces(docs, path, capacity, end_id, text, doc).withColumn("number", F.monotonically_increasing_id())
    pieces = store(pieces, "pieces")
    by_length = pieces.groupBy("length").count()
    counts = {r["length"]: r["count"] for r in by_length.collect()}  # at most ``capacity`` rows
    parts = plan(counts, capacity)

    most = max(counts.values(), default=1)
    buckets = max(-(-most // BUCKET_PIECES), min(most, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("number"), F.lit(buckets)))
    sizes = pieces.groupBy("length", "bucket").count()
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    numbered = pieces.withColumn("rank", F.row_number().over(Window.partitionBy("length", "bucket").orderBy("number")))
    ranked = numbered.join(sizes, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("rank") - 1)
    ranked = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank")
    known = spark.sparkContext.broadcast(parts)  # parts of at most a few thousand multisets

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = places(known.value, column(batch, "length").to_numpy(), column(batch, "rank").to_numpy())
            yield pa.record_batch(
                [*batch.columns[:-1], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:-1], "sequence_id", "offset"]
            )

    schema = PIECES.format(id=pieces.schema["doc_id"].dataType.simpleString())
    return ranked.mapInArrow(placed, f"{schema}, sequence_id long, offset long")
