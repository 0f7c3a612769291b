"""Collocations against a plain count of all phrases."""

import re
from collections import Counter

import numpy as np
import pytest
from helpers import DOCS, LOWER

from docquarry.llm import collocations


def brute(rows, least, most=2000):
    counts, words_of = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            words_of[lang] += len(words)
            counts.update((lang, tuple(words[i: i + k])) for k in range(1, 5) for i in range(len(words) - k + 1))
    often = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    longest = Counter()
    for (lang, words), a in often.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                longest[lang, words[i: i + k]] = max(longest[lang, words[i: i + k]], a)
    found = []
    for (lang, words), a in often.items():
        if 100 * longest[lang, words] >= 80 * a:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        found.append((lang, -score, -a, " ".join(words).encode(), left, right))
    out, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(found):
        rank[lang] += 1
        if rank[lang] <= most:
            out.append((lang, rank[lang], phrase.decode(), -a, left, right, words_of[lang], -score))
    return out


def rows_of(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def texts(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0) for i, (t, lang) in enumerate(rows)], DOCS)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    words = ["of", "the", "The", "new", "york", "city", "é", "naïve", "x" * 40, "a b", "zebra"]
    chances = np.array([8, 8, 4, 5, 5, 3, 2, 1, 1, 1, 1]) / 39
    marks = [" ", "  ", "\t", ". ", ",", " ! ", "\n", "\r\n", "; ", "\x0b"]
    found = []
    for i in range(300):
        parts = []
        for word in rng.choice(words, int(rng.integers(0, 60)), p=chances):
            parts += [word, rng.choice(marks, p=[0.6, 0.05, 0.05, 0.05, 0.05, 0.05, 0.05, 0.04, 0.04, 0.02])]
        found.append(("".join(parts), ["en", "fr", None, "und"][i % 4]))
    return found + [("new york city " * 50, "en"), ("ha " * 3000, "en"), (None, "en"), ("", None), (" .;\t", "fr"), ("solo", "xx")]


@pytest.mark.parametrize("bits", [1 << 15, 1 << 22])
@pytest.mark.parametrize("least", [3, 30])
def test_all_counts_are_exact(spark, rows, least, bits):
    found = rows_of(collocations.collocations(texts(spark, rows).repartition(5), least, bits=bits))
    assert found == brute(rows, least)
    assert len(found) > 20


def test_a_full_bit_map_loses_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(collocations, "bit_map", lambda found, key, bits: np.full(bits // 8, 255, np.uint8))
    assert rows_of(collocations.collocations(texts(spark, rows), 3, bits=1 << 15)) == brute(rows, 3)


def test_first_rows_of_each_language(spark, rows):
    assert rows_of(collocations.collocations(texts(spark, rows), 3, most=4, bits=1 << 15)) == brute(rows, 3, 4)


def test_odd_tables(spark):
    assert rows_of(collocations.collocations(texts(spark, []), bits=1 << 15)) == []
    assert rows_of(collocations.collocations(texts(spark, [(None, None), ("", "en")]), bits=1 << 15)) == []
    odd = texts(spark, [("a b " * 40, "en")]).selectExpr("text", "lang", "1 as w1", "2 as n", "3 as words", "4 as phrase")
    assert rows_of(collocations.collocations(odd, bits=1 << 15)) == brute([("a b " * 40, "en")], 30)


def test_scores_beyond_64_bits(spark):
    big = 10**15
    table = spark.createDataFrame(
        [("en", [], 0, big), ("en", ["a"], 1, big), ("en", ["b"], 1, big), ("en", ["a", "b"], 2, big - 1)],
        "lang string, words array<string>, size int, f long",
    )
    original, collocations.phrase_counts = collocations.phrase_counts, lambda *a, **k: table
    try:
        assert rows_of(collocations.collocations(texts(spark, []))) == [("en", 1, "a b", big - 1, big, big, big, 999_999)]
    finally:
        collocations.phrase_counts = original


def test_windows_meet_before_rollup_copies_them(spark, rows, capfd):
    collocations.phrase_counts(texts(spark, rows), least=3).explain()
    plan = capfd.readouterr().out
    below = plan[plan.index("Expand"):]
    assert "hashpartitioning(lang" in below, plan


def test_runs_that_share_a_hash_change_no_count(spark, rows, monkeypatch):
    monkeypatch.setattr(collocations, "RUN_BITS", 16)
    runs = collocations.frequent_runs(texts(spark, rows), (1, 2), {}, least=3)
    assert runs.where("run < 0 or run >= 65536").isEmpty()
    assert rows_of(collocations.collocations(texts(spark, rows), least=3, bits=1 << 15)) == sorted(brute(rows, 3))
