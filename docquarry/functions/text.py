"""Text normalisation as column expressions.

Texts are split, and words tested and cut, in Arrow: a rule about words is applied to the distinct words of a
batch, not to each occurrence. Patterns are those of RE2.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from docquarry.config import DEFAULTS, Settings

# The functions below that run in tasks travel with the job: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Patterns of the token rules.
CONTRACTION = r"(n['’]t|['’](s|ll|re|ve|d|m))([^\p{L}\p{N}]|$)"
SEPARATOR = r"[^\p{L}\p{N}]+"
LETTERS = r"^\p{L}+$"
PLURAL_IES = "([^ae])ies$"
PLURAL_S = "([^us])s$"
GRAM_SEPARATOR = r"[^\p{L}\p{N}_]+"


def cap_text(text: Column, cap: int | None) -> Column:
    return text if cap is None else F.substring(text, 1, cap)


def rows_of(lists: pa.Array) -> np.ndarray:
    """The row of each element of the flattened lists."""
    return np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))


def listed(rows: np.ndarray, values: pa.Array, like: pa.Array) -> pa.ListArray:
    """The values as one list for each row, null where ``like`` is null. ``rows``, the row of each value, ascend."""
    ends = pa.array(np.searchsorted(rows, np.arange(len(like) + 1)).astype(np.int32))
    return pa.ListArray.from_arrays(ends, values, mask=like.is_null() if like.null_count else None)


def by_word(lists: pa.Array, test: Callable[[pa.Array], pa.Array], change: Callable[[pa.Array], pa.Array] | None = None) -> pa.Array:
    """The words that pass the test, changed; both are asked for distinct words only."""
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy()
    kept = test(coded.dictionary).to_numpy(zero_copy_only=False)[codes]
    found = change(coded.dictionary) if change else coded.dictionary
    return listed(rows_of(lists)[kept], found.take(pa.array(codes[kept])), lists)


def split_words(texts: pa.Array) -> pa.Array:
    return pc.split_pattern_regex(pc.replace_substring_regex(texts, CONTRACTION, " "), SEPARATOR)


def singulars(words: pa.Array) -> pa.Array:
    """``singular`` of an array of words."""
    return pc.replace_substring_regex(pc.replace_substring_regex(words, PLURAL_IES, r"\1y"), PLURAL_S, r"\1")


def words(text: Column) -> Column:
    """Lowercase words; English contractions lose their ending first."""

    @F.arrow_udf("array<string>")
    def split(texts: pa.Array) -> pa.Array:
        return split_words(texts)

    return split(F.lower(text))


def singular(word: Column) -> Column:
    """Harman's S-stemmer. Its rule for -es drops the same letter as the one for -s."""
    stripped = F.regexp_replace(F.regexp_replace(word, PLURAL_IES, "$1y"), PLURAL_S, "$1")
    return F.when(word.endswith("s"), stripped).otherwise(word)


def kept_words(text: Column, settings: Settings = DEFAULTS, letters_only: bool = True, stemmed: bool = False) -> Column:
    """Surface forms, or with ``stemmed`` singulars, that pass the length, stop-word and (for documents) letter tests."""
    least, stop_words = settings.min_token_length, pa.array(settings.stop_words, pa.string())

    def passes(word: pa.Array) -> pa.Array:
        test = pc.and_(pc.greater_equal(pc.utf8_length(word), least), pc.invert(pc.is_in(word, value_set=stop_words)))
        return pc.and_(test, pc.match_substring_regex(word, LETTERS)) if letters_only else test

    @F.arrow_udf("array<string>")
    def kept(texts: pa.Array) -> pa.Array:
        return by_word(split_words(texts), passes, singulars if stemmed else None)

    return kept(F.lower(cap_text(text, settings.text_cap)))


def document_tokens(text: Column, settings: Settings = DEFAULTS) -> Column:
    return kept_words(text, settings, stemmed=True)


def query_tokens(text: Column, settings: Settings = DEFAULTS) -> Column:
    """Like document tokens, but words with digits stay."""
    return kept_words(text, settings, letters_only=False, stemmed=True)


def gram_words(text: Column) -> Column:
    """Lowercase runs of at least two word characters, the unit of the n-grams."""

    @F.arrow_udf("array<string>")
    def runs(texts: pa.Array) -> pa.Array:
        return by_word(pc.split_pattern_regex(texts, GRAM_SEPARATOR), lambda word: pc.greater_equal(pc.utf8_length(word), 2))

    return runs(F.lower(text))


def ngrams(tokens: Column, longest: int) -> Column:
    """All n-grams of 1 to ``longest`` words, joined by a space."""

    @F.arrow_udf("array<string>")
    def grams(lists: pa.Array) -> pa.Array:
        flat, rows = lists.flatten(), rows_of(lists)
        parts, places, joined = [flat], [rows], flat
        for step in range(1, longest):
            joined = pc.binary_join_element_wise(joined[:-1], flat[step:], pa.scalar(" ", flat.type))
            whole = np.flatnonzero(rows[:-step] == rows[step:])
            parts.append(joined.take(pa.array(whole)))
            places.append(rows[whole])
        row = np.concatenate(places)
        order = np.argsort(row, kind="stable")
        return listed(row[order], pa.concat_arrays(parts).take(pa.array(order)), lists)

    return grams(tokens)


def term_counts(terms: Column) -> Column:
    """``array<struct<term, tf>>``: the distinct elements of an array of strings and how often each occurs."""

    @F.arrow_udf("array<struct<term: string, tf: int>>")
    def counted(lists: pa.Array) -> pa.Array:
        coded = lists.flatten().dictionary_encode(null_encoding="encode")
        size = max(len(coded.dictionary), 1)
        held, tf = np.unique(rows_of(lists) * size + coded.indices.to_numpy(), return_counts=True)
        rows, codes = np.divmod(held, size)
        pairs = [coded.dictionary.take(pa.array(codes)), pa.array(tf.astype(np.int32))]
        return listed(rows, pa.StructArray.from_arrays(pairs, ["term", "tf"]), lists)

    return counted(terms)
