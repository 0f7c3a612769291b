"""Words, terms, n-grams and lemmas are handled within their row: nothing is grouped, joined or shuffled for them."""

from pyspark.sql import functions as F

from docquarry.functions.text import document_tokens, gram_words, kept_words, ngrams, term_counts
from docquarry.operators.corpus import build_corpus, with_lemma_table
from docquarry.operators.index import postings
from docquarry.operators.tfidf import document_gram_counts, gram_counts, with_grams

COSTLY = ("Aggregate", "Exchange", "Join")


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().sparkPlan().toString()


def test_words_are_split_once_in_arrow(spark):
    rows = [("It's the Cities' 12 buses, ÉCOLES d’été 日本 a1!",), ("",), (None,), (" \n..",), ("don't\nboys'll",)]
    frame = spark.createDataFrame(rows, "text string").coalesce(1)
    found = frame.select(document_tokens(F.col("text")).alias("t"), kept_words(F.col("text")).alias("k"))
    assert "rlike" not in plan_of(found).lower()
    assert [r.t for r in found.collect()] == [["city", "buse", "école", "été", "日本"], [], None, [], ["boy"]]
    assert [r.k for r in found.collect()][0] == ["cities", "buses", "écoles", "été", "日本"]


def test_postings_need_no_grouping(spark):
    rows = [("a", ["x", "y", "x"]), ("b", []), ("c", None), (None, ["y"]), ("d", ["z", "x"])]
    found = postings(spark.createDataFrame(rows, "doc_id string, tokens array<string>"))
    assert not any(name in plan_of(found) for name in COSTLY)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [("a", "x", 2, 3), ("a", "y", 1, 3), (None, "y", 1, 1), ("d", "z", 1, 2), ("d", "x", 1, 2)], key=str
    )


def test_grams_of_a_document_need_no_grouping(spark):
    rows = [("1", ["ab", "cd", "ab", "cd"]), ("2", []), ("3", None), ("4", ["cd", "x"])]
    grams = with_grams(spark.createDataFrame(rows, "doc_id string, tokens array<string>"))
    found = document_gram_counts(grams)
    assert not any(name in plan_of(found) for name in COSTLY)
    assert sorted(map(tuple, found.collect())) == [
        ("1", "ab", 2), ("1", "ab cd", 2), ("1", "cd", 2), ("1", "cd ab", 1), ("4", "cd", 1)
    ]
    assert {r.gram: (r.n, r.df) for r in gram_counts(grams).collect()}["cd"] == (3, 2)


def test_long_grams_stay_in_their_row(spark):
    frame = spark.createDataFrame([("aa bb cc",), ("dd",), (None,), ("ee ff",)], "text string").coalesce(1)
    got = [r.g for r in frame.select(ngrams(gram_words(F.col("text")), 3).alias("g")).collect()]
    assert got == [["aa", "bb", "cc", "aa bb", "bb cc", "aa bb cc"], ["dd"], None, ["ee", "ff", "ee ff"]]
    counts = frame.select(term_counts(F.split("text", " ")).alias("c")).collect()
    assert [None if r.c is None else len(r.c) for r in counts] == [3, 1, None, 2]


def test_lemmas_are_looked_up_without_a_shuffle(spark):
    docs = spark.createDataFrame([(1, "went houses went axes"), (2, "the"), (3, None)], "id int, act_raw_text string")
    lemmas = spark.createDataFrame(
        [("went", "go"), ("axes", "axis"), ("axes", "ax"), ("houses", None), (None, "none")], "surface string, lemma string"
    )
    found = with_lemma_table(docs, lemmas, "id")
    assert not any(name in plan_of(found) for name in COSTLY)
    assert {r.id: r.tokens for r in found.collect()} == {1: ["go", "house", "go", "ax", "axis"], 2: [], 3: []}
    empty = with_lemma_table(docs, lemmas.limit(0), "id")
    assert {r.id: r.tokens for r in empty.collect()}[1] == ["went", "house", "went", "axe"]


def test_lemmas_of_a_larger_table_are_joined(spark):
    from docquarry.config import Settings

    acts = spark.createDataFrame(
        [("a", 1, "went houses", ["t"]), ("b", 2, "running axes", ["t"])], "CELEX string, row_no long, act_raw_text string, EUROVOC array<string>"
    )
    lemmas = spark.createDataFrame([("went", "go"), ("running", "run")], "surface string, lemma string")
    joined, looked = (
        {r.doc_id: r.tokens for r in build_corpus(acts, "row_no", Settings(broadcast_rows=rows), lemmas).collect()} for rows in (1, 10)
    )
    assert joined == looked == {"a": ["go", "house"], "b": ["run", "axe"]}
