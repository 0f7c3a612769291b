"""Re-Pair grammar compression of token ids, and files of such shards.

A shard is a run of documents. Round by round the pairs of neighbouring symbols are counted, the frequent
ones become rules, and their occurrences are replaced from the left without overlap; then the shorter
sequence is counted again, until no pair is frequent or all symbols are taken. Symbols fit in 16 bits: ids below ``first_rule``, rules above. A shard stores its
rules, the number of ids each rule expands to, and the shortened sequence. Sums of expansion lengths find
the symbols of any range of ids, so a document is decoded without the rest.

Files are written with Spark's text writer, one shard each; a shard states its own size, so its bytes may hold
line breaks. Ranges of ids have folders named by their order, and the files of a range are numbered, so in the
order of their paths the files hold ascending ids. They are read with the ``binaryFile`` source, from any store
that Spark reaches.

Defined results: a null or empty text is the end id alone. Documents with null ids come first; equal ids
stay in an order fixed by their ids' hash. Repeated rows are stored each. A text over ``SHARD_IDS`` is a
shard of its own. Other columns are ignored. An empty table gives no shards, and reads back as no rows.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docquarry.llm.common import binary_values, column, steps, store
from docquarry.llm.tokens import STEP, crc32, encoder, forget

END_ID = 2
SHARD_IDS = 1 << 20
FIRST_RULE = 49_408
SYMBOLS = 1 << 16
# A round takes half of the free symbols, so that later rounds can build on its rules; so few are taken at once.
LAST_SYMBOLS = 256
# A pair must occur so often to be worth a rule: a rule takes 8 bytes, an occurrence saves 2.
LEAST = 6
_SLOTS = 16
MAGIC = b"DQRP"
# part, ids before the shard in its part, documents, ids, first rule, rules, symbols, bytes of the whole shard
HEAD = struct.Struct("<4sqqqqqqqq")


class Grammar(NamedTuple):
    first_rule: int
    rules: np.ndarray  # (n, 2): the symbols of each rule, earlier symbols only
    lengths: np.ndarray  # ids that each rule expands to
    sequence: np.ndarray


# --- the grammar ---


def frequent_pairs(keys: np.ndarray, most: int, least: int) -> np.ndarray:
    """The most frequent pairs that occur ``least`` times or more, each in a slot of its own by hash."""
    ordered = np.sort(keys)
    edges = np.flatnonzero(ordered[1:] != ordered[:-1]) + 1
    begin = np.concatenate([[0], edges])
    counts = np.diff(np.concatenate([begin, [len(ordered)]]))
    often = counts >= least
    pairs, counts = ordered[begin[often]], counts[often]
    pairs = pairs[np.argsort(-counts, kind="stable")][: 2 * most]
    _, kept = np.unique(_slot(pairs), return_index=True)  # of two pairs in a slot the more frequent stays
    return pairs[np.sort(kept)][:most]


def _slot(keys: np.ndarray) -> np.ndarray:
    return (keys * np.uint32(2654435761)) >> np.uint32(32 - _SLOTS)


def compress(ids: np.ndarray, first_rule: int = FIRST_RULE, least: int = LEAST) -> Grammar:
    """Rules and the shortened sequence. Ids must be below ``first_rule``, that below 65,536."""
    if len(ids) and int(ids.max()) >= first_rule:
        raise ValueError(f"id {int(ids.max())} is not below {first_rule}")
    sequence = ids.astype(np.uint32)
    rules: list[np.ndarray] = []
    next_symbol = first_rule
    while len(sequence) > 1 and next_symbol < SYMBOLS:
        free = SYMBOLS - next_symbol
        room = free if free <= LAST_SYMBOLS else free // 2
        keys = (sequence[:-1] << np.uint32(16)) | sequence[1:]
        pairs = frequent_pairs(keys, room, least)
        if not len(pairs):
            break
        # One look-up per place: the slot's pair and the symbol that stands for it.
        slots = _slot(pairs)
        pair_of = np.zeros(1 << _SLOTS, np.uint32)
        symbol_of = np.zeros(1 << _SLOTS, np.uint32)  # 0: the slot is empty
        pair_of[slots] = pairs
        symbol_of[slots] = next_symbol + np.arange(len(pairs), dtype=np.uint32)
        slot = _slot(keys)
        hit = (pair_of[slot] == keys) & (symbol_of[slot] > 0)
        # Of hits in a row every second one, from the left, is replaced.
        places = np.flatnonzero(hit)
        if not len(places):
            break
        run_start = np.concatenate([[True], places[1:] != places[:-1] + 1])
        first_of_run = np.maximum.accumulate(np.where(run_start, np.arange(len(places)), 0))
        places = places[(np.arange(len(places)) - first_of_run) % 2 == 0]
        # Pairs whose places all went to overlapping ones make no rule.
        made = (symbol_of[slot[places]] - next_symbol).astype(np.int64)
        used = np.bincount(made, minlength=len(pairs)) > 0
        sequence[places] = (next_symbol + np.cumsum(used) - 1)[made]
        pairs = pairs[used]
        stays = np.ones(len(sequence), bool)
        stays[places + 1] = False
        sequence = sequence[stays]
        rules.append(np.stack([pairs >> np.uint32(16), pairs & np.uint32(0xFFFF)], 1))
        next_symbol += len(pairs)
    table = np.concatenate(rules) if rules else np.empty((0, 2), np.uint32)
    return Grammar(first_rule, table, _expansion_lengths(table, first_rule), sequence.astype(np.uint16))


def _expansion_lengths(rules: np.ndarray, first_rule: int) -> np.ndarray:
    sizes = [1] * first_rule
    for left, right in rules.tolist():
        sizes.append(sizes[left] + sizes[right])
    return np.array(sizes[first_rule:], np.uint32)


def expand(grammar: Grammar, symbols: np.ndarray) -> np.ndarray:
    """The ids that these symbols stand for."""
    symbols = symbols.astype(np.uint32)
    while len(big := np.flatnonzero(symbols >= grammar.first_rule)):
        sizes = np.ones(len(symbols), np.int64)
        sizes[big] = 2
        pairs = grammar.rules[symbols[big] - grammar.first_rule]
        symbols = np.repeat(symbols, sizes)
        at = big + np.arange(len(big))
        symbols[at], symbols[at + 1] = pairs[:, 0], pairs[:, 1]
    return symbols


def decode_range(grammar: Grammar, start: int, length: int) -> np.ndarray:
    """``length`` ids from ``start`` on; only the symbols that cover them are expanded."""
    sizes = np.ones(len(grammar.sequence), np.int64)
    big = grammar.sequence >= grammar.first_rule
    sizes[big] = grammar.lengths[grammar.sequence[big].astype(np.int64) - grammar.first_rule]
    ends = np.cumsum(sizes)
    low = int(np.searchsorted(ends, start, "right"))
    high = int(np.searchsorted(ends, start + length, "left")) + 1
    skipped = int(ends[low - 1]) if low else 0
    return expand(grammar, grammar.sequence[low:high])[start - skipped: start - skipped + length]


# --- shards as bytes ---


class Shard(NamedTuple):
    part: int
    before: int
    doc_ids: list[int | None]
    sizes: np.ndarray
    grammar: Grammar


def pack_shard(shard: Shard) -> bytes:
    doc_ids, grammar = shard.doc_ids, shard.grammar
    body = b"".join([
        bytes(d is not None for d in doc_ids),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        shard.sizes.astype("<u4").tobytes(),
        grammar.rules.astype("<u2").tobytes(),
        grammar.lengths.astype("<u4").tobytes(),
        grammar.sequence.astype("<u2").tobytes(),
    ])
    head = HEAD.pack(
        MAGIC, shard.part, shard.before, len(doc_ids), int(shard.sizes.sum()), grammar.first_rule, len(grammar.rules),
        len(grammar.sequence), HEAD.size + len(body),
    )
    return head + body


def unpack_shards(content: bytes) -> Iterator[Shard]:
    """The shards of a file; raises ValueError where it is damaged."""
    at = 0
    while at < len(content):
        if len(content) - at < HEAD.size:
            raise ValueError("shard head is cut short")
        magic, part, before, n_docs, n_ids, first_rule, n_rules, n_symbols, size = HEAD.unpack_from(content, at)
        if magic != MAGIC or at + size > len(content):
            raise ValueError("shard is damaged or cut short")
        place = at + HEAD.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal place
            values = np.frombuffer(content, kind, n, place)
            place += values.nbytes
            return values

        known, doc_ids, sizes = take("u1", n_docs), take("<i8", n_docs), take("<u4", n_docs)
        rules, lengths, sequence = take("<u2", 2 * n_rules), take("<u4", n_rules), take("<u2", n_symbols)
        if int(sizes.sum()) != n_ids:
            raise ValueError("shard lengths disagree")
        ids = [d if k else None for d, k in zip(doc_ids.tolist(), known.tolist())]
        yield Shard(part, before, ids, sizes, Grammar(first_rule, rules.reshape(-1, 2), lengths, sequence))
        at += size + 1  # the line break of the text writer


def shard_heads(content: bytes) -> Iterator[tuple[int, int]]:
    """The part and the number of ids of each shard of a file, from the heads alone."""
    at = 0
    while at < len(content):
        _, part, _, _, n_ids, _, _, _, size = HEAD.unpack_from(content, at)
        yield part, n_ids
        at += size + 1  # the line break of the text writer


# --- files ---


def write_shards(
    docs: DataFrame, folder: str, path: str, text: str = "text", doc: str = "doc_id", end_id: int = END_ID,
    shard_ids: int = SHARD_IDS, first_rule: int = FIRST_RULE,
) -> None:
    """Encode every text with the tokenizer file, append the end id, and write shards in ascending order of ``doc``.

    Ranges of ids are cut at quantiles of the id column alone, so texts are encoded once and shuffled once, as ids.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    n_ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / n_ranges for i in range(1, n_ranges)]
    (bounds,) = rows.agg(F.percentile_approx("doc_id", shares, 20 * n_ranges)).first()
    edges = np.unique(np.array(bounds or [], np.int64))
    width = len(str(len(edges) + 1))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, most=STEP):
            ids, sizes = encoder(path, True).encode(binary_values(column(batch, "text")))
            ends = np.cumsum(sizes)
            small = ids.astype("<u2")
            parts = [small[b:e].tobytes() for b, e in zip((ends - sizes).tolist(), ends.tolist())]
            doc_ids = column(batch, "doc_id")
            part = 1 + np.searchsorted(edges, doc_ids.fill_null(0).to_numpy(), "left")
            part[doc_ids.is_null().to_numpy(zero_copy_only=False)] = 0
            yield pa.record_batch([pa.array(part.astype(np.int64)), doc_ids, pa.array(parts, pa.binary())], ["part", "doc_id", "ids"])
        forget()

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, held, doc_ids, parts = None, 0, 0, [], []

        def closed() -> pa.RecordBatch:
            sizes = np.array([len(p) // 2 + 1 for p in parts], np.int64)
            ids = np.full(int(sizes.sum()), end_id, np.uint16)
            keep = np.ones(len(ids), bool)
            keep[np.cumsum(sizes) - 1] = False
            ids[keep] = np.frombuffer(b"".join(parts), "<u2")
            block = pack_shard(Shard(part, before, doc_ids, sizes, compress(ids, first_rule)))
            return pa.record_batch([pa.array([f"{part:0{width}d}"]), pa.array([block], pa.binary())], ["part", "shard"])

        for batch in batches:
            for row_part, doc_id, ids in zip(*(c.to_pylist() for c in batch.columns)):
                size = len(ids) // 2 + 1
                if parts and (row_part != part or held + size > shard_ids):
                    yield closed()
                    before = before + held if row_part == part else 0
                    held, doc_ids, parts = 0, [], []
                elif row_part != part:
                    before = 0
                part = row_part
                held += size
                doc_ids.append(doc_id)
                parts.append(ids)
        if parts:
            yield closed()

    (
        rows.mapInArrow(encoded, "part long, doc_id long, ids binary")
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "part")
        .sortWithinPartitions("part", F.asc_nulls_first("doc_id"), F.xxhash64("ids"), "ids")
        .mapInArrow(shards, "part string, shard binary")
        .select("part", F.col("shard").cast("string").alias("value"))
        .write.partitionBy("part")
        .option("lineSep", "\n")
        .option("compression", "none")
        .option("maxRecordsPerFile", 1)
        .text(folder)
    )


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document; ``start`` counts the ids of all documents before it."""
    files = spark.read.format("binaryFile").load(folder).select("content")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for shard in unpack_shards(content.as_py()):
                    ids = expand(shard.grammar, shard.grammar.sequence).astype("<u4")
                    ends = np.cumsum(shard.sizes.astype(np.int64))
                    if len(ids) != ends[-1]:
                        raise ValueError("shard expands to another length")
                    begin = ends - shard.sizes
                    data = pa.Array.from_buffers(
                        pa.large_binary(), len(ends),
                        [None, pa.py_buffer(np.concatenate([[0], ends * 4]).astype(np.int64)), pa.py_buffer(ids)],
                    ).cast(pa.binary())
                    yield pa.record_batch(
                        [pa.array(np.full(len(ends), shard.part, np.int64)), pa.array(shard.doc_ids, pa.int64()),
                         pa.array(shard.before + begin), pa.array(shard.sizes.astype(np.int64)), data],
                        ["part", "doc_id", "start", "n_tokens", "ids"],
                    )

    rows = files.mapInArrow(decoded, "part long, doc_id long, start long, n_tokens long, ids binary")

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                found = shard_heads(memoryview(content.as_buffer()))
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found)], ["part", "n"])

    # One row per range of ids: a few times the number of shuffle partitions, however large the corpus.
    sums = store(files.mapInArrow(totals, "part long, n long").groupBy("part").agg(F.sum("n").alias("n")), "range_totals")
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = sums.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    return rows.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids"
    )


def crc32_of_ids(rows: DataFrame) -> DataFrame:
    """Replace ``ids`` (little-endian unsigned 32-bit) by their unsigned crc32."""
    return rows.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


__all__ = [
    "Grammar", "compress", "crc32", "crc32_of_ids", "decode_range", "expand", "read_documents", "unpack_shards",
    "write_shards",
]
