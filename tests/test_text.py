import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from docquarry.config import STOP_WORDS, Settings
from docquarry.functions.text import document_tokens, gram_words, ngrams, query_tokens
from docquarry.operators.corpus import with_lemma_table, with_tokens

# Published token lists of five queries.
TRACED = {
    "import of apples and fresh fruit from third countries": "import apple fresh fruit country",
    "veterinary controls and health certificates for bovine animals and pigmeat":
        "veterinary control health certificate bovine animal pigmeat",
    "financial aid and economic sanctions against china": "financial aid economic sanction china",
    "what are the specific rules and regulations regarding the labelling of sea fish within the ec":
        "specific rule regulation labelling sea fish ec",
    "automatic public tendering for cereals": "automatic public tendering cereal",
}


def tokens_of(spark, text, make):
    return spark.createDataFrame([(text,)], "text string").select(make(F.col("text")).alias("t")).first().t


@pytest.mark.parametrize("query", TRACED)
def test_traced_queries(spark, query):
    assert tokens_of(spark, query, query_tokens) == TRACED[query].split()


def test_words_with_digits_stay_in_queries_only(spark):
    text = "MP3 rules of 2024, a B x1"
    assert tokens_of(spark, text, document_tokens) == ["rule"]
    assert tokens_of(spark, text, query_tokens) == ["mp3", "rule", "2024", "x1"]


def test_contractions_and_plurals(spark):
    text = "Don't the member's parties' buses, glass; it’ll IES"
    assert tokens_of(spark, text, document_tokens) == ["member", "party", "buse", "glass", "ie"]


def test_empty_text(spark):
    assert tokens_of(spark, "", document_tokens) == []
    assert tokens_of(spark, "...", query_tokens) == []


def test_repeats_keep_order(spark):
    assert tokens_of(spark, "beta alpha beta", document_tokens) == ["beta", "alpha", "beta"]


def test_whole_text_unless_capped(spark):
    text = "word " * 30_000 + "last"
    assert tokens_of(spark, text, document_tokens)[-1] == "last"
    capped = Settings(text_cap=100_000)
    assert len(tokens_of(spark, text, lambda c: document_tokens(c, capped))) == 20_000


def test_stop_words_are_the_plain_ones_of_spark(spark):
    plain = [word for word in StopWordsRemover.loadDefaultStopWords("english") if word.isalpha()]
    assert sorted(STOP_WORDS) == sorted([*plain, "third", "regarding", "within"])


def test_ngrams(spark):
    frame = spark.createDataFrame([("x ab b_1 c2 éé",)], "text string")
    got = frame.select(ngrams(gram_words(F.col("text")), 2).alias("g")).first().g
    assert got == ["ab", "b_1", "c2", "éé", "ab b_1", "b_1 c2", "c2 éé"]
    assert frame.select(ngrams(F.array(F.lit("ab")), 3).alias("g")).first().g == ["ab"]
    assert frame.select(ngrams(F.array().cast("array<string>"), 2).alias("g")).first().g == []


def test_lemma_table(spark):
    docs = spark.createDataFrame([(1, "went to better houses"), (2, "the")], "id int, act_raw_text string")
    lemmas = spark.createDataFrame([("went", "go"), ("better", "good")], "surface string, lemma string")
    got = {r.id: r.tokens for r in with_lemma_table(docs, lemmas, "id").collect()}
    assert got == {1: ["go", "good", "house"], 2: []}


def test_missing_text_column(spark):
    with pytest.raises(ValueError):
        with_tokens(spark.range(1))
