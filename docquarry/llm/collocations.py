"""Phrase collocations from counts of longest windows alone.

Every word starts one window of ``LONGEST`` lead columns: itself and the words after it in its piece, padded
with empty words. Only these windows are counted. A phrase of k words is a prefix of as many windows as it has
occurrences, so one ROLLUP over the columns sums the windows to all shorter phrases, and its empty prefix to
the number of words.

Most windows are rare from their second word on, and a phrase is frequent only if all phrases in it are. So
before that, passes over the texts count hashes of words and of pairs of neighbouring words, then of runs of
three where both pairs in it are frequent, and windows are padded from the first rare run on, rare words
included. Padded windows are few, as they collapse where they are made. The hashes of frequent runs are kept in
bit maps of a fixed size (``FILTER_BITS``): hashes that meet only keep windows longer, so counts are exact at any
size of the corpus, and larger maps only save shuffling.

The passes ship a hash and a count for the distinct runs of a task's step, and padded windows. Both are added
up before and after the shuffle, so words and pairs that a third of all places share reach the shuffle once a
task. ROLLUP gets each window of the corpus once. All further tables hold frequent phrases only.

Defined results: a null text is empty; empty texts and pieces without words have no phrases. A null language
is ``und``. Repeated rows count each. Ties in score and count go by the phrase's UTF-8 bytes. Other columns are
ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.llm.common import binary_values, bit_map, column, in_map, release, steps, store
from docquarry.llm.shingles import mix

LONGEST = 4
LEAST = 30
# Percent of a phrase's places that a longer one must hold to replace it.
COVERED = 80
MOST = 2000
SCALE = 2_000_000
FILTER_BITS = 1 << 27
# Bits of a run's hash that are shipped and counted; runs that meet there may only keep windows longer.
RUN_BITS = 32
# Bytes of text whose windows collapse before they leave Python.
STEP = 2 << 20

_END, _SPACE, _LETTER = 0, 1, 2
_KIND = np.full(256, _LETTER, np.uint8)
_KIND[list(b" \t")] = _SPACE
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = _END
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"): ord("Z") + 1] += 32
_TURN = np.uint64(0xD6E8FEB86659FD93)


def word_codes(texts: list[bytes | None]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words, the code of every word, whether the next word is in its piece, and each word's text."""
    raw = np.frombuffer(b"\n".join([*(t or b"" for t in texts), b""]), np.uint8)
    kind = _KIND[raw]
    inside = kind == _LETTER
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    begin, end = edges[0::2], edges[1::2]
    offsets = np.concatenate([[0], np.cumsum(end - begin)])
    words = pa.Array.from_buffers(
        pa.large_binary(), len(begin), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(_LOWER[raw[inside]])]
    ).dictionary_encode()
    piece = np.searchsorted(np.flatnonzero(kind == _END), begin)
    joined = np.append(piece[1:] == piece[:-1], False)[: len(begin)]
    starts = np.cumsum([0, *(len(t or b"") + 1 for t in texts)])
    return words.dictionary, words.indices.to_numpy().astype(np.int64), joined, np.searchsorted(starts, begin, "right") - 1


def _hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each distinct word."""
    offsets = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, words.offset * 8)
    raw = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0]: offsets[-1]].astype(np.uint64) + np.uint64(1)
    offsets = offsets - offsets[0]
    found, sizes = np.zeros(len(words), np.uint64), np.diff(offsets)
    live, place = np.arange(len(words)), 0
    while len(live := live[sizes[live] > place]):
        found[live] = mix(found[live] * _TURN + raw[offsets[live] + place])
        place += 1
    return found


class Step(NamedTuple):
    """The words of one step of a task, in order."""

    words: pa.Array  # distinct
    codes: np.ndarray
    joined: np.ndarray  # whether the next word is in the same piece
    languages: list[str]
    language: np.ndarray  # the number of each word's language


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[Step]:
    for batch in steps(batches, most=STEP):
        words, codes, joined, of = word_codes(binary_values(column(batch, "text")))
        if len(codes):
            languages = column(batch, "lang").dictionary_encode()
            number = languages.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            yield Step(words, codes, joined, languages.dictionary.to_pylist(), number[of])


def runs(step: Step, maps: dict[int, np.ndarray], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For 1 word, then 2 and so on up to ``most``: where runs begin that are in their map, and their hashes. Shorter
    runs in them are all known; a size without a map counts as known."""
    of_word, of_language = _hashes(step.words), _hashes(pa.array([n.encode() for n in step.languages], pa.large_binary()))
    at = np.arange(len(step.codes))
    hashes = of_language[step.language]
    for size in range(1, most + 1):
        hashes = mix(hashes * _TURN + of_word[step.codes[at + size - 1]])
        if size in maps:
            known = in_map(maps[size], hashes)
            at, hashes = at[known], hashes[known]
        yield at, hashes
        begins = np.zeros(len(step.codes) + 1, bool)
        begins[at] = True
        both = step.joined[at] & begins[at + 1]
        at, hashes = at[both], hashes[both]


def _rows(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text")
    ).where(F.octet_length("text") > 0)


def frequent_runs(
    docs: DataFrame, sizes: tuple[int, ...], maps: dict[int, np.ndarray], least: int = LEAST, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """(run, n): the lowest bits of hashes of the runs of these sizes, by language, that occur ``least`` times or more."""
    shared = docs.sparkSession.sparkContext.broadcast(maps)  # ``FILTER_BITS`` / 8 bytes each

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in _steps(batches):
            for size, (_, hashes) in enumerate(runs(step, shared.value, max(sizes)), 1):
                if size in sizes:
                    hashes, counts = np.unique((hashes & np.uint64((1 << RUN_BITS) - 1)).view(np.int64), return_counts=True)
                    yield pa.record_batch([pa.array(hashes), pa.array(counts)], ["run", "n"])
        release()

    found = _rows(docs, text, lang).mapInArrow(counted, "run long, n long")
    return found.groupBy("run").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def padded_windows(docs: DataFrame, maps: dict[int, np.ndarray], text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, w1 .. w4, n): how often a window begins at a word, cut before the first run that is not in the maps.

    Each window is one row. They are shuffled as one text, whose words are joined by spaces, as words hold none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(maps)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in _steps(batches):
            n, n_words = len(step.codes), len(step.words)
            reach = np.zeros(n, np.int64)
            for size, (at, _) in enumerate(runs(step, shared.value, LONGEST), 1):
                reach[at] = size
            # Codes of the lead columns, one beyond the last word for padding.
            padded = np.append(step.codes, np.full(LONGEST, n_words))
            lead = [step.language, *(np.where(reach > i, padded[i: i + n], n_words) for i in range(LONGEST))]
            # Equal windows of the step become one row, by exact keys of two columns at a time.
            key = lead[0]
            for codes in lead[1:]:
                _, first, key = np.unique(key * (n_words + 1) + codes, return_index=True, return_inverse=True)
            choices = pa.concat_arrays([step.words.cast(pa.large_string()), pa.array([""], pa.large_string())])
            columns = [pa.array(step.languages, pa.string()).take(pa.array(lead[0][first]))]
            joined = pc.binary_join_element_wise(*(choices.take(pa.array(codes[first])) for codes in lead[1:]), pa.scalar(" ", pa.large_string()))
            yield pa.record_batch([*columns, joined.cast(pa.string()), pa.array(np.bincount(key))], ["lang", "words", "n"])
        release()

    found = _rows(docs, text, lang).mapInArrow(windows, "lang string, words string, n long")
    found = found.groupBy("lang", "words").agg(F.sum("n").alias("n"))
    words = F.split("words", " ", -1)
    return found.select("lang", *(words[i].alias(f"w{i + 1}") for i in range(LONGEST)), "n")


def phrase_counts(docs: DataFrame, least: int = LEAST, bits: int = FILTER_BITS, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, words, size, f): phrases of 1 to 4 words that occur ``least`` times; size 0 holds the number of all words."""
    if bits & (bits - 1) or not 1 << 15 <= bits <= 1 << RUN_BITS:
        raise ValueError(f"bits is a power of two from 2**15 to 2**{RUN_BITS}")
    maps: dict[int, np.ndarray] = {}
    for sizes in ((1, 2), *((k,) for k in range(3, LONGEST))):
        known = bit_map(frequent_runs(docs, sizes, maps, least, text, lang), "run", bits)
        maps = maps | dict.fromkeys(sizes, known)
    windows = padded_windows(docs, maps, text, lang)
    # The lowest bits of grouping_id tell which of the last columns are summed over.
    sizes = " ".join(f"when {(1 << (LONGEST - k)) - 1} then {k}" for k in range(LONGEST + 1))
    rolled = docs.sparkSession.sql(
        f"""select lang, w1, w2, w3, w4, case grouping_id() {sizes} end as size, sum(n) as f
        from {{windows}} group by lang, rollup(w1, w2, w3, w4)""",
        windows=windows,
    )
    # The empty prefix counts every word; a padded column ends a phrase, so longer prefixes of it are none.
    shown = [F.when(F.col("size") >= k, F.col(f"w{k}")) for k in range(1, LONGEST + 1)]
    words = F.array_compact(F.array(*shown))
    rows = rolled.select("lang", words.alias("words"), "size", "f").where(~F.array_contains("words", ""))
    return rows.where((F.col("size") == 0) | (F.col("f") >= least))


def _exact(value) -> F.Column:
    return F.col(value).cast("decimal(20,0)")


def collocations(
    docs: DataFrame, least: int = LEAST, most: int = MOST, bits: int = FILTER_BITS, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``most`` best phrases of each language."""
    counts = store(phrase_counts(docs, least, bits, text, lang), "phrase_counts")
    totals = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    known = counts.where("size > 0").select("lang", F.array_join("words", " ").alias("part"), F.col("f").alias("part_f"))
    found = counts.where("size > 1").select("lang", "words", "size", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"))

    def part(start, length):
        return F.array_join(F.slice("words", start, length), " ")

    # Each cut once; parts occur at least as often as the whole, so the joins find them.
    cuts = found.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumn("left", part(F.lit(1), F.col("cut"))).withColumn("right", part(F.col("cut") + 1, F.col("size") - F.col("cut")))
    cuts = cuts.join(known.withColumnsRenamed({"part": "left", "part_f": "l"}), ["lang", "left"])
    cuts = cuts.join(known.withColumnsRenamed({"part": "right", "part_f": "r"}), ["lang", "right"])
    score = F.expr(f"(cast({SCALE} as decimal(7,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    cuts = cuts.withColumn("score", score)
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))

    # The most frequent longer candidate around each phrase.
    places = "flatten(transform(sequence(2, size - 1), k -> transform(sequence(1, size - k + 1), i -> struct(i as i, k as k))))"
    place = F.explode(F.expr(places))
    inner = found.where("size > 2").select("lang", "words", F.col("a").alias("longer"), place.alias("at"))
    inner = inner.select("lang", part(F.col("at")["i"], F.col("at")["k"]).alias("phrase"), "longer")
    around = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(around, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.lit(100) * _exact("longer") < F.lit(COVERED) * _exact("a"))
    )

    kept = kept.select("lang", "phrase", "a", "best.l", "best.r", "best.score").join(totals, "lang")
    ranked = kept.withColumn("rank", F.expr("row_number() over (partition by lang order by score desc, a desc, phrase)"))
    return ranked.where(F.col("rank") <= most).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
