"""Benchmark decontamination: which documents hold a test item, however long the document.

An item is found if at least ``SHARE`` of its distinct word shingles are in the document. Shingles have five
words, or as many as the item has if that is fewer.

Search. Items are partitioned by size (shingle count). All items of a partition keep a bottom-k MinHash
sketch, their k smallest shingle hashes. A document that holds the share of an item lacks at most
``size - ceil(share * size)`` of its shingles, so with one more than that (at the partition's upper size) the
sketch surely meets the document: containment search by bands of single minima, without false negatives
even where the document is a thousand times the item. Every word position of a document is probed once
against all sketches. A met item is then verified by counting its shingles in the document exactly.

Items go to the tasks in blocks of at most ``BLOCK_BYTES`` of text, each block with its own pass over the
documents, so a pass has a proven bound and no document is shuffled. The results of a block are stored before
the next one is read, so the driver and the tasks hold one block at a time.

Defined results: null and empty documents hold nothing; null and empty items, and items without words, are
in no document. Repeated documents and items are matched each. Null ids stay null. Other columns, also of
clashing names, are ignored by ``matches`` and kept by ``without_items``. Empty tables give no matches.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.llm.common import binary_values, column, filtered, steps, store
from docquarry.llm.shingles import distinct, rolled, words

WORDS = 5
SHARE = 0.8
BLOCK_BYTES = 16 << 20
_PROBE = np.uint64(48)


class Items(NamedTuple):
    """``sets``: per item its shingles; per width, sketch hashes (ascending) with their items, and a bit table."""

    ids: list
    sets: list[np.ndarray]
    needed: list[int]
    sketches: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def least_shared(size: int, share: float) -> int:
    """The smallest count that is at least the share of the size, without rounding errors."""
    return math.ceil(round(share * size, 9))


def build(ids: list, texts: list[bytes | None], width: int = WORDS, share: float = SHARE) -> Items:
    hashes, firsts = words(texts)
    kept, sets, needed, entries = [], [], [], {}
    for item, begin, end in zip(ids, firsts[:-1].tolist(), firsts[1:].tolist()):
        if begin == end:
            continue
        own = min(width, end - begin)
        shingles = distinct(rolled(hashes[begin:end], own))
        # Partition by size: powers of two; its largest size sets the length of the sketch.
        upper = (1 << len(shingles).bit_length()) - 1
        k = upper - least_shared(upper, share) + 1
        entries.setdefault(own, []).append((shingles[:k], np.full(min(k, len(shingles)), len(kept))))
        kept.append(item)
        sets.append(shingles)
        needed.append(least_shared(len(shingles), share))
    sketches = {}
    for own, parts in entries.items():
        minima, items = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(minima, kind="stable")
        table = np.zeros(1 << (64 - int(_PROBE)), bool)
        table[(minima >> _PROBE).astype(np.int64)] = True
        sketches[own] = (minima[order], items[order], table)
    return Items(kept, sets, needed, sketches)


def search(items: Items, texts: list[bytes | None]) -> Iterator[tuple[int, int, int]]:
    """(text, item, shared shingles) of every item found."""
    hashes, firsts = words(texts)
    for width, (minima, owners, table) in items.sketches.items():
        shingles = rolled(hashes, width)
        places = np.flatnonzero(table[(shingles >> _PROBE).astype(np.int64)])
        begin = np.searchsorted(minima, shingles[places], "left")
        met = np.searchsorted(minima, shingles[places], "right") - begin
        places, begin, met = places[met > 0], begin[met > 0], met[met > 0]
        text = np.searchsorted(firsts, places, "right") - 1
        inside = places + width <= firsts[text + 1]  # not across the end of a text
        text, begin, met = text[inside], begin[inside], met[inside]
        ends = np.cumsum(met)
        total = int(ends[-1]) if len(ends) else 0
        item = owners[np.repeat(begin - (ends - met), met) + np.arange(total)]
        pairs = np.unique(np.stack([np.repeat(text, met), item], 1), axis=0)
        held_text, held = -1, None
        for t, i in pairs.tolist():
            if t != held_text:
                held_text, held = t, distinct(shingles[firsts[t]: firsts[t + 1] - width + 1])
            own = items.sets[i]
            at = np.searchsorted(held, own)
            shared = int((held[np.minimum(at, len(held) - 1)] == own).sum())
            if shared >= items.needed[i]:
                yield t, i, shared


def _blocks(benchmark: DataFrame, item: str, text: str, width: int, share: float) -> Iterator[tuple[Items, bool]]:
    """The items in blocks of bounded size, by hash, one at a time, and whether it is the last one."""
    rows = benchmark.select(F.col(item).alias("item_id"), F.col(text).cast("string").cast("binary").alias("text"))
    rows = rows.where("text is not null")  # such items are in no document
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-2 * size // BLOCK_BYTES) or 1
    for block in range(n):
        part = rows.where(F.pmod(F.xxhash64("text"), F.lit(n)) == block).toArrow()
        order = sorted(zip(part["item_id"].to_pylist(), part["text"].to_pylist()), key=lambda r: (r[0] is None, r[:1] if r[0] is not None else (), r[1]))
        yield build([r[0] for r in order], [r[1] for r in order], width, share), block == n - 1


def matches(
    docs: DataFrame, benchmark: DataFrame, width: int = WORDS, share: float = SHARE, text: str = "text", doc: str = "doc_id",
    item: str = "item_id",
) -> DataFrame:
    """(doc_id, item_id, item_shingles, shared, containment) of every item in a document."""
    rows = docs.select(F.col(doc).alias("doc_id"), F.col(text).cast("string").alias("text"))
    id_types = rows.schema["doc_id"].dataType.simpleString(), benchmark.schema[item].dataType.simpleString()
    schema = f"doc_id {id_types[0]}, item_id {id_types[1]}, item_shingles long, shared long, containment double"
    found = None
    for items, last in _blocks(benchmark, item, text, width, share):
        known = docs.sparkSession.sparkContext.broadcast(items)

        def matched(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            items = known.value
            for batch in steps(batches):
                hits = list(search(items, binary_values(column(batch, "text"))))
                if hits:
                    at, item_at, shared = zip(*hits)
                    sizes = [len(items.sets[i]) for i in item_at]
                    columns = [
                        column(batch, "doc_id").take(pa.array(at)), pa.array([items.ids[i] for i in item_at]),
                        pa.array(sizes, pa.int64()), pa.array(shared, pa.int64()),
                        pa.array([s / n for s, n in zip(shared, sizes)], pa.float64()),
                    ]
                    yield pa.record_batch(columns, ["doc_id", "item_id", "item_shingles", "shared", "containment"])

        part = rows.mapInArrow(matched, schema)
        if not last:
            part = store(part, "matches")
            known.destroy()
        found = part if found is None else found.unionByName(part)
    return found


def without_items(docs: DataFrame, benchmark: DataFrame, width: int = WORDS, share: float = SHARE, text: str = "text", item: str = "item_id") -> DataFrame:
    """The documents, with all their columns, that hold no item."""
    for items, last in _blocks(benchmark, item, text, width, share):
        known = docs.sparkSession.sparkContext.broadcast(items)

        def stays(texts: list[bytes | None], known=known) -> np.ndarray:
            mask = np.ones(len(texts), bool)
            mask[[t for t, _, _ in search(known.value, texts)]] = False
            return mask

        docs = filtered(docs, text, stays)
        if not last:
            docs = store(docs, "without_items")
            known.destroy()
    return docs
