"""Helpers shared by the operators: table access, stored stages, Arrow batches of texts."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.session import shared_folder, store

# Bytes of text that one step of a Python task holds as arrays.
STEP_BYTES = 1 << 20


def reachable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, however the driver was started.

    Clusters without a shared installation get the package by ``--py-files`` as usual.
    """
    root = str(Path(__file__).resolve().parents[2])
    held = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in held.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, held]))


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return rows.select(*columns) if columns else rows


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder, for files that are no tables."""
    return f"{shared_folder(spark)}/docquarry/{name}_{uuid.uuid4().hex[:12]}"


def held_out(doc_id: str = "doc_id") -> Column:
    """A fifth of the ids, by the crc32 of the id as text; such rows never teach a model."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def learnable(labels: DataFrame, label: str, doc: str = "doc_id") -> DataFrame:
    """(doc_id, label) of the rows that a model may learn from: 0 or 1, with an id, not held out."""
    marks = labels.select(F.col(doc).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    return marks.where("doc_id is not null and label in (0, 1)").where(~held_out())


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, most: int, most_bytes: int, text: str = "text", doc: str = "doc_id"
) -> tuple[list[int], list[bytes], list[int]]:
    """Ids, texts and labels of at most ``most`` rows of each class, the first by a hash of the id.

    Rows with null texts or texts over ``most_bytes`` are left out, so the sample has a fixed bound.
    """
    marks, order = learnable(labels, label, doc), F.xxhash64("doc_id")
    first = [marks.where(f"label = {c}").orderBy(order, "doc_id").limit(most) for c in (0, 1)]
    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    rows = rows.where(F.octet_length("text") <= most_bytes)
    found = rows.join(F.broadcast(first[0].unionByName(first[1])), "doc_id").toArrow()
    ordered = sorted(zip(*(found[c].to_pylist() for c in ("doc_id", "text", "label"))))
    return tuple(map(list, zip(*ordered))) if ordered else ([], [], [])


def steps(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``most`` bytes of text, or one row when a single text is larger."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(column(batch, text)).fill_null(0).to_pylist()
        begin = held = 0
        for row, size in enumerate(sizes):
            if row > begin and held + size > most:
                yield batch.slice(begin, row - begin)
                begin, held = row, 0
            held += size
        yield batch.slice(begin)


def release() -> None:
    """Give back memory that this worker has freed; tasks call it at their end, as workers may wait long for another."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps its own counsel
        pass


def filtered(docs: DataFrame, text: str, stays) -> DataFrame:
    """The rows, with all their columns, whose texts pass: ``stays`` takes a list of texts and returns a mask."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text):
            yield batch.filter(pa.array(stays(binary_values(column(batch, text))), pa.bool_()))
        release()

    return docs.mapInArrow(kept, docs.schema)


def bit_map(keys: DataFrame, key: str, bits: int) -> np.ndarray:
    """A bit map of 64-bit keys by their lowest bits, ``bits`` bits however many keys there are, made in blocks of 4 kB.

    Rows that may be dropped because they match no key can be tested against it; keys that meet keep some more.
    """
    place = F.pmod(F.col(key), F.lit(bits)) + 1  # Spark counts bits from 1
    blocks = keys.select(place.alias("place")).groupBy(F.expr("bitmap_bucket_number(place)").alias("block"))
    held = blocks.agg(F.expr("bitmap_construct_agg(bitmap_bit_position(place))").alias("bits")).toArrow()
    out = np.zeros((-(-bits // 32768), 4096), np.uint8)
    for block, part in zip(held["block"].to_pylist(), held["bits"]):
        out[block - 1] = np.frombuffer(part.as_buffer(), np.uint8)
    return out.ravel()


def in_map(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the keys may be among those of the map."""
    place = (keys & np.uint64(8 * len(bitmap) - 1)).astype(np.int64)
    return (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0


def binary_values(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of each text, without decoding them."""
    return column.cast(pa.binary()).to_pylist() if pa.types.is_string(column.type) else column.to_pylist()


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


__all__ = [
    "STEP_BYTES", "binary_values", "bit_map", "column", "filtered", "held_out", "in_map", "labelled_sample", "learnable", "reachable", "release", "shared_path", "steps", "store",
    "table",
]
