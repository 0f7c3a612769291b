"""Alignment of the tokens of two tokenizers over the same bytes.

A document is tokenized whole by both. Byte offsets where a token of each ends are shared ends; they cut the
tokens into groups, and within a group every token of one is linked with every token of the other. Shared ends
before tokens that begin with a space in both are anchors: they cut a document into windows of token ids, mostly
words. A window's groups and links depend on its ids alone, so each distinct window of a step, known by its two
tuples of ids, is aligned once and remembered. A document is then a row of numbers of windows. All windows of a
step are found, compared and aligned as arrays.

Neither tokenizer merges across the start of a run of spaces (a test holds this against whole texts), so both
remember the ids of pieces (see ``tokens``). What a task remembers is bounded and dropped with the task.

A document holds its distinct id pairs with their places. Spark counts the documents of each pair, marks the
pairs that are most frequent for their first id, and adds the marks up by document. Marks go to every task where
they have at most ``MARKS`` rows; beyond that both sides are shuffled by pair and a salt. Sums leave a task as
one row a document.

Defined results: null and empty texts, and texts whose tokens of either side join to other bytes than a space
and the text, have no tokens: zeros and an empty digest. Names of special tokens in a text are plain text. Every
row counts as a document, repeated ones too. Ids may be null or repeat. Other columns are ignored. An empty
table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.llm.common import binary_values, column, steps, store
from docquarry.llm.tokens import PRINTED, PieceEncoder, Remembering
from docquarry.session import join_hot

# What a task remembers of windows, and of pieces of each side.
WINDOWS = 120_000
WINDOW_BYTES = 12 << 20
PIECES = 120_000
# Bytes of text that are aligned at once.
STEP = 2 << 20
MARKS = 1_000_000
# A pair of ids as one number.
ID_BITS = 20
# Links of one group that are listed one by one; of larger groups the distinct ids are multiplied.
GROUP_LINKS = 1 << 16
_BETWEEN = np.uint32(2**32 - 1)

_BYTE = re.compile(r"<0x([0-9A-F]{2})>")
_SPACE = "▁"


# --- the two tokenizers ---


def byte_level_parts(encoder: PieceEncoder) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary."""
    byte_of = {chr(PRINTED.get(b, b)): b for b in range(256)}
    parts = [b""] * encoder.tokenizer.get_vocab_size()
    for entry, i in encoder.tokenizer.get_vocab().items():
        parts[i] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
    return parts


class SentenceEncoder(Remembering):
    """A model of pieces with byte fallback, which itself puts a space before a text."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        super().__init__()

    def parts(self) -> list[bytes]:
        """The bytes of each id."""
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        return [
            bytes.fromhex(_BYTE.fullmatch(name)[1]) if self.model.is_byte(i) else name.replace(_SPACE, " ").encode()
            for i, name in enumerate(names)
        ]

    def cut(self, texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
        """Runs of spaces, each with what follows; texts begin with a space."""
        raw = np.frombuffer(b"".join(texts), np.uint8)
        starts = np.cumsum([0, *map(len, texts)])
        space = raw == 32
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins = np.append(begins, False)
        begins[starts[:-1]] = True
        begins[len(raw):] = False
        at = np.flatnonzero(begins)
        offsets = np.append(at, len(raw)).astype(np.int64)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
        return pieces, np.diff(np.searchsorted(at, starts))

    def learn(self, fresh: list[bytes]) -> None:
        found = self.model.encode([p[1:].decode() for p in fresh], num_threads=1)
        # The model leaves an empty text empty, without the space before it.
        alone = [self.model.piece_to_id(_SPACE)]
        self.append(fresh, [ids if len(piece) > 1 else alone for piece, ids in zip(fresh, found)])


# --- windows ---


class Tokens(NamedTuple):
    """Tokens of both sides over the same bytes: ids, byte ends, and whether the other side ends there too."""

    a: np.ndarray
    b: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    a_shared: np.ndarray
    b_shared: np.ndarray


def _after(flags: np.ndarray) -> np.ndarray:
    """For each token how many flagged tokens are before it."""
    return np.cumsum(flags) - flags


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each run of these sizes."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


class Aligner:
    """Aligns texts, remembering windows by their ids."""

    def __init__(self, byte_path: str, piece_path: str) -> None:
        self.a_side, self.b_side = PieceEncoder(byte_path, False, plain=True), SentenceEncoder(piece_path)
        self.a_side.most = self.b_side.most = PIECES
        sides = byte_level_parts(self.a_side), self.b_side.parts()
        if max(map(len, sides)) > 1 << ID_BITS:
            raise ValueError(f"ids need more than {ID_BITS} bits")
        self.sizes = [np.array([len(p) for p in parts], np.int64) for parts in sides]
        self.spaced = [np.array([p[:1] == b" " for p in parts]) for parts in sides]
        # The bytes of each id, and each id in decimal digits, as one array with its ends.
        self.parts = [(np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)])) for parts in sides]
        digits = [str(i).encode() for i in range(max(map(len, sides)))]
        self.digits = np.frombuffer(b"".join(digits), np.uint8)
        self.digit_ends = np.cumsum([0, *map(len, digits)])
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.shown: list[bytes] = []
        self.held = 0
        # Groups, links, and whether the bytes of both sides agree; where the pairs of each window end.
        self.facts = np.zeros((1 << 12, 3), np.int64)
        self.ends = np.zeros((1 << 12) + 1, np.int64)
        self.pairs = np.zeros((2, 1 << 14), np.int64)

    def tokens(self, a: np.ndarray, b: np.ndarray) -> Tokens:
        a_ends, b_ends = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        place = np.searchsorted(b_ends, a_ends)
        a_shared = b_ends[np.minimum(place, len(b_ends) - 1)] == a_ends
        b_shared = np.zeros(len(b), bool)
        b_shared[place[a_shared]] = True
        return Tokens(a, b, a_ends, b_ends, a_shared, b_shared)

    def windows(self, t: Tokens, doc_ends: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The ids of each window as bytes, and how many tokens of each side it has."""
        # Anchors: shared ends before tokens with a leading space on both sides, and ends of documents.
        a_at, b_at = np.flatnonzero(t.a_shared), np.flatnonzero(t.b_shared)
        spaced = [np.append(spaced[ids], True) for spaced, ids in zip(self.spaced, (t.a, t.b))]
        anchor = spaced[0][a_at + 1] & spaced[1][b_at + 1]
        anchor[np.searchsorted(t.a_ends[a_at], doc_ends)] = True
        n_a, n_b = (np.diff(at[anchor], prepend=-1) for at in (a_at, b_at))
        sizes = n_a + n_b + 1
        ends = np.cumsum(sizes)
        data = np.full(int(ends[-1]), _BETWEEN, np.uint32)
        data[np.repeat(ends - sizes, n_a) + _within(n_a)] = t.a
        data[np.repeat(ends - n_b, n_b) + _within(n_b)] = t.b
        offsets = np.concatenate([[0], ends * 4]).astype(np.int64)
        keys = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        return keys, n_a, n_b

    def _bytes(self, side: int, ids: np.ndarray) -> np.ndarray:
        raw, ends = self.parts[side]
        sizes = self.sizes[side][ids]
        return raw[np.repeat(ends[ids], sizes) + _within(sizes)]

    def _learn(self, fresh: list[bytes]) -> None:
        """Align windows that are not known yet, all at once."""
        data = np.frombuffer(b"".join(fresh), np.uint32)
        sizes = np.array([len(k) // 4 for k in fresh])
        window = np.repeat(np.arange(len(fresh)), sizes)
        between = data == _BETWEEN
        past = np.cumsum(between) > window  # the tokens of the second side
        is_a, is_b = ~past, past & ~between
        t = self.tokens(data[is_a].astype(np.int64), data[is_b].astype(np.int64))
        window_a, window_b = window[is_a], window[is_b]
        group_a, group_b = _after(t.a_shared), _after(t.b_shared)
        n_groups = int(t.a_shared.sum())
        group_sizes_a, group_sizes_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
        window_of_group = window_a[t.a_shared]
        links = group_sizes_a * group_sizes_b
        facts = np.stack([
            np.bincount(window_of_group, minlength=len(fresh)),
            np.bincount(window_of_group, links, len(fresh)).astype(np.int64),
            np.ones(len(fresh), np.int64),
        ], 1)
        differ = self._bytes(0, t.a) != self._bytes(1, t.b)
        if differ.any():
            ends = np.cumsum(np.bincount(window_a, self.sizes[0][t.a], len(fresh)))
            facts[np.searchsorted(ends, np.flatnonzero(differ), "right"), 2] = 0

        # Digests: the tokens of a group, first side first, each in digits and followed by the mark it needs.
        before_b = np.cumsum(group_sizes_b) - group_sizes_b
        upto_a = np.cumsum(group_sizes_a)
        order = np.empty(len(t.a) + len(t.b), np.int64)
        marks = np.full(len(order), ord(","), np.uint8)
        at_a, at_b = np.arange(len(t.a)) + before_b[group_a], np.arange(len(t.b)) + upto_a[group_b]
        order[at_a], order[at_b] = t.a, t.b
        marks[at_a[t.a_shared]], marks[at_b[t.b_shared]] = ord("|"), ord(";")
        lengths = np.diff(self.digit_ends)[order]
        ends = np.cumsum(lengths + 1)
        shown = np.empty(int(ends[-1]), np.uint8)
        shown[np.repeat(ends - lengths - 1, lengths) + _within(lengths)] = self.digits[np.repeat(self.digit_ends[order], lengths) + _within(lengths)]
        shown[ends - 1] = marks
        whole = shown.tobytes()
        last = np.cumsum(np.bincount(window_a, minlength=len(fresh)) + np.bincount(window_b, minlength=len(fresh)))
        stops = ends[last - 1].tolist()
        texts = [whole[begin: end - 1] for begin, end in zip([0, *stops[:-1]], stops)]

        # Pairs of each window with their places.
        first_b = before_b
        small = links <= GROUP_LINKS
        own = small[group_a]
        times = group_sizes_b[group_a[own]]
        partner = t.b[np.repeat(first_b[group_a[own]], times) + _within(times)]
        keys = [np.repeat(t.a[own], times) << ID_BITS | partner]
        of = [np.repeat(window_a[own], times)]
        places = [np.ones(len(partner), np.int64)]
        for group in np.flatnonzero(~small).tolist():
            (x, n_x), (y, n_y) = (np.unique(ids, return_counts=True) for ids in (t.a[group_a == group], t.b[group_b == group]))
            keys.append((x[:, None] << ID_BITS | y).ravel())
            of.append(np.full(len(x) * len(y), window_of_group[group]))
            places.append((n_x[:, None] * n_y).ravel())
        of, keys, places = np.concatenate(of), np.concatenate(keys), np.concatenate(places)
        order = np.lexsort((keys, of))
        of, keys, places = of[order], keys[order], places[order]
        begin = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (keys[1:] != keys[:-1])))
        of, keys, places = of[begin], keys[begin], np.add.reduceat(places, begin)
        self._append(fresh, facts, texts, np.searchsorted(of, np.arange(len(fresh)), "right"), np.stack([keys, places]))

    def _append(self, fresh: list[bytes], facts: np.ndarray, texts: list[bytes], ends: np.ndarray, pairs: np.ndarray) -> None:
        first, count = len(self.shown), len(self.shown) + len(fresh)
        held = int(self.ends[first])
        while count > len(self.facts):
            self.facts = np.concatenate([self.facts, np.zeros_like(self.facts)])
            self.ends = np.concatenate([self.ends, np.zeros(len(self.facts) + 1 - len(self.ends), np.int64)])
        while held + pairs.shape[1] > self.pairs.shape[1]:
            self.pairs = np.concatenate([self.pairs, np.zeros_like(self.pairs)], axis=1)
        self.facts[first:count] = facts
        self.ends[first + 1: count + 1] = held + ends
        self.pairs[:, held: held + pairs.shape[1]] = pairs
        self.shown += texts
        self.held += sum(map(len, fresh)) + sum(map(len, texts))
        self.known.update(zip(fresh, range(first, count)))

    def align(self, texts: list[bytes | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Per text: tokens of both sides, groups, links; the digest; where its pairs end; all pairs and their places."""
        if len(self.shown) > WINDOWS or self.held > WINDOW_BYTES:
            self.forget()
        facts, digests = np.zeros((len(texts), 4), np.int64), [""] * len(texts)
        whole = [b" " + t if t else b"" for t in texts]
        (a, a_counts), (b, b_counts) = self.a_side.encode(whole), self.b_side.encode_bytes(whole)
        a, b = a.astype(np.int64), b.astype(np.int64)
        rows = np.arange(len(texts))
        row_a, row_b = np.repeat(rows, a_counts), np.repeat(rows, b_counts)
        lengths = np.array([len(t) for t in whole])
        fits = (lengths > 0)
        for row_of, ids, sizes in ((row_a, a, self.sizes[0]), (row_b, b, self.sizes[1])):
            fits &= np.bincount(row_of, sizes[ids], len(texts)) == lengths
        a, b = a[fits[row_a]], b[fits[row_b]]
        chosen = np.flatnonzero(fits)
        nothing = np.zeros(len(texts), np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        if not len(chosen):
            return facts, digests, *nothing
        t = self.tokens(a, b)
        doc_ends = np.cumsum(lengths[chosen])
        keys, n_a, n_b = self.windows(t, doc_ends)
        encoded = keys.dictionary_encode()
        distinct = encoded.dictionary.to_pylist()
        codes = np.fromiter(map(self.known.get, distinct, repeat(-1)), np.int64, len(distinct))
        missing = np.flatnonzero(codes < 0).tolist()
        if missing:
            self._learn([distinct[i] for i in missing])
            codes[missing] = [self.known[distinct[i]] for i in missing]
        codes = codes[encoded.indices.to_numpy()]
        # The windows of each document.
        stops = np.searchsorted(t.a_ends[np.cumsum(n_a) - 1], doc_ends, "right")
        starts = np.concatenate([[0], stops[:-1]])
        found = np.add.reduceat(self.facts[codes], starts, axis=0)
        agrees = found[:, 2] == stops - starts
        counts = np.stack([np.add.reduceat(n_a, starts), np.add.reduceat(n_b, starts), found[:, 0], found[:, 1]], 1)
        facts[chosen] = np.where(agrees[:, None], counts, 0)
        listed = codes.tolist()
        for row, begin, end, fine in zip(chosen.tolist(), starts.tolist(), stops.tolist(), agrees.tolist()):
            if fine:
                digests[row] = sha256(b";".join(map(self.shown.__getitem__, listed[begin:end]))).hexdigest()
        # Each window of a document once, then each pair once, with its places added up.
        row = np.repeat(chosen, stops - starts)
        keep = np.repeat(agrees, stops - starts)
        held, many = np.unique(row[keep] * len(self.shown) + codes[keep], return_counts=True)
        code = held % len(self.shown)
        sizes = self.ends[code + 1] - self.ends[code]
        at = np.repeat(self.ends[code], sizes) + _within(sizes)
        pair = np.repeat(held // len(self.shown), sizes) << 2 * ID_BITS | self.pairs[0, at]
        pairs, place = np.unique(pair, return_inverse=True)
        times = np.bincount(place, self.pairs[1, at] * np.repeat(many, sizes), len(pairs)).astype(np.int64)
        ends = np.searchsorted(pairs >> 2 * ID_BITS, rows, "right")
        return facts, digests, ends, pairs & ((1 << 2 * ID_BITS) - 1), times


# --- the corpus ---


def aligned_rows(docs: DataFrame, byte_path: str, piece_path: str, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of every row."""
    rows = docs.select(F.col(doc).alias("doc_id"), F.col(text).cast("string").alias("text"))
    names = ["n_a", "n_b", "n_groups", "n_links"]

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for batch in steps(batches, most=STEP):
            aligner = aligner or Aligner(byte_path, piece_path)
            facts, digests, ends, pairs, times = aligner.align(binary_values(column(batch, "text")))
            offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
            yield pa.record_batch(
                [column(batch, "doc_id"), *map(pa.array, facts.T.copy()), pa.array(digests, pa.string()),
                 pa.ListArray.from_arrays(offsets, pa.array(pairs)), pa.ListArray.from_arrays(offsets, pa.array(times))],
                ["doc_id", *names, "groups_sha256", "pairs", "times"],
            )

    counts = ", ".join(f"{name} long" for name in names)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(aligned, f"doc_id {kind}, {counts}, groups_sha256 string, pairs array<long>, times array<long>")


def pair_marks(rows: DataFrame) -> DataFrame:
    """(pair, documents, is_best): the documents of each pair, and whether no pair of its first id has more."""
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("documents"))
    counts = store(counts.withColumn("first", F.shiftright("pair", ID_BITS)), "pair_counts")
    best = counts.groupBy("first").agg(F.max("documents").alias("most"))
    return counts.join(best, "first").select("pair", "documents", (F.col("documents") == F.col("most")).alias("is_best"))


def align(
    docs: DataFrame, byte_path: str, piece_path: str, text: str = "text", doc: str = "doc_id", most_marks: int = MARKS
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    rows = aligned_rows(docs, byte_path, piece_path, text, doc).withColumn("row", F.monotonically_increasing_id())
    rows = store(rows, "aligned")
    marks = store(pair_marks(rows), "pair_marks")
    links = rows.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    found = join_hot(links, marks, "pair", "row", most_marks).groupBy("row").agg(
        F.sum(F.when(F.col("is_best"), F.col("times"))).alias("n_best"), F.sum(F.col("times") * F.col("documents")).alias("count_sum")
    )
    return rows.drop("pairs", "times").join(found, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256",
    )
