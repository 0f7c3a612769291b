"""Input tables of the registered queries, derived from the given tables.

Every document keeps its whole text. Edge cases are added as further rows or tags, chosen by what
the data holds, and take no document away.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.functions.text import words

# Row orders of added rows start here, after every document.
SECOND = 1_000_000_000
THIRD = 2_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _act_id(prefix: str, number: str):
    return F.concat(F.lit(prefix), F.lpad(F.col(number).cast("string"), 8, "0"))


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")


def raw_acts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as an act, and one act without a text per benchmark item."""
    tags = F.concat_ws(
        "; ",
        F.upper("lang"),
        F.concat(F.lit("Source "), F.substring("source", 4, 100)),
        F.when(F.col("quality") == 1, "High Quality").when(F.col("quality") == 0, "Low Quality"),
        F.when(F.col("toxic") == 1, "Toxic"),
        F.lit(""),
    )
    acts = labelled_documents(spark, sf_dir).select(
        F.col("doc_id").alias("row_no"),
        F.upper("lang").alias("Act_type"),
        F.when(F.col("quality").isNull(), "NA").otherwise(F.col("source")).alias("Act_name"),
        _act_id("D", "doc_id").alias("CELEX"),
        F.col("text").alias("act_raw_text"),
        F.when(F.col("n_chars") >= 200, tags).alias("EUROVOC"),
    )
    size = F.length("text")
    stubs = table(spark, sf_dir, "benchmark").select(
        (F.col("item_id") + THIRD).alias("row_no"),
        F.lit("NOTICE").alias("Act_type"),
        F.lit("NULL").alias("Act_name"),
        _act_id("B", "item_id").alias("CELEX"),
        F.when(size < 150, "NA").when(size < 250, "n/a").when(size < 350, "").alias("act_raw_text"),
        F.lit("EN").alias("EUROVOC"),
    )
    return acts.unionByName(stubs)


def lemma_table(acts: DataFrame) -> DataFrame:
    """``(surface, lemma)``: the words of the acts that end in -ing, without it."""
    found = acts.select(F.explode_outer(words(F.col("act_raw_text"))).alias("surface")).distinct()
    found = found.where(F.col("surface").endswith("ing") & (F.length("surface") > 5))
    return found.withColumn("lemma", F.expr("substring(surface, 1, length(surface) - 3)"))


def raw_acts_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The acts, then second copies of the toxic documents with other text."""
    acts = raw_acts(spark, sf_dir)
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("row_no"))
    again = acts.join(toxic, "row_no", "left_semi")
    return acts.unionByName(
        again.withColumns({
            "row_no": F.col("row_no") + SECOND,
            "act_raw_text": F.concat(F.lit("second copy "), F.col("act_raw_text")),
        })
    )


def wide_acts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acts with number columns, some of them with missing values."""
    numbers = labelled_documents(spark, sf_dir).select(
        F.col("doc_id").alias("row_no"), "n_chars", "quality", "toxic"
    )
    return raw_acts(spark, sf_dir).join(numbers, "row_no", "left")


def id_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """External to act ids with missing ids and repeated rows; ``row_no`` is the file order."""
    docs = table(spark, sf_dir, "documents")
    first = docs.select(
        F.col("doc_id").alias("row_no"),
        F.col("doc_id").cast("string").alias("DocID"),
        F.when(F.col("n_chars") < 400, "null")
        .when(F.col("n_chars") < 500, "")
        .otherwise(_act_id("D", "doc_id"))
        .alias("CelexID"),
    )
    marks = table(spark, sf_dir, "labels")
    second = marks.where("quality = 0").select(
        (F.col("doc_id") + SECOND).alias("row_no"),
        F.col("doc_id").cast("string").alias("DocID"),
        _act_id("D", "doc_id").alias("CelexID"),
    )
    third = marks.where("toxic = 1").select(
        (F.col("doc_id") + THIRD).alias("row_no"),
        F.col("doc_id").cast("string").alias("DocID"),
        F.lit("NULL").alias("CelexID"),
    )
    return first.unionByName(second).unionByName(third)


def judgment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines ``label id relevance``; ``line_no`` is the file order.

    Lines of short documents lack a field, some pairs are judged twice, and every toxic document
    is also judged for a label outside the vocabulary.
    """
    tags = F.filter(F.transform(F.split(F.lower("EUROVOC"), ";"), lambda t: F.trim(t)), lambda t: t != "")
    tagged = (
        raw_acts(spark, sf_dir)
        .where(F.col("EUROVOC").isNotNull() & (F.col("row_no") < SECOND))
        .select("row_no", F.posexplode(tags).alias("pos", "tag"))
        .join(
            labelled_documents(spark, sf_dir).select(
                F.col("doc_id").alias("row_no"), "n_chars", "quality", "toxic"
            ),
            "row_no",
        )
    )
    label = F.replace(F.col("tag"), F.lit(" "), F.lit("_"))
    number = F.col("row_no").cast("string")
    relevance = (
        F.when(F.col("n_chars") < 300, "")
        .when(F.col("quality") == 1, " 2")
        .when(F.col("quality") == 0, " 0")
        .otherwise(" 1")
    )
    order = F.col("row_no") * 100 + F.col("pos")
    first = tagged.select(order.alias("line_no"), F.concat(label, F.lit(" "), number, relevance).alias("line"))
    toxic = tagged.where("toxic = 1")
    second = toxic.select(
        (order + SECOND * 100).alias("line_no"),
        F.concat(F.lit("  "), label, F.lit("\t"), number, F.lit("  3")).alias("line"),
    )
    third = toxic.where("pos = 0").select(
        (order + THIRD * 100).alias("line_no"),
        F.concat(F.lit("unknown_label "), number, F.lit(" 1")).alias("line"),
    )
    return first.unionByName(second).unionByName(third)


def query_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages as free queries, every tag as a label query, and edge cases."""
    passages = table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("P"), F.lpad(F.col("item_id").cast("string"), 8, "0")).alias("qid"),
        F.col("text").alias("raw_query"),
        F.lit(None).cast("string").alias("target_label"),
    )
    tags = F.filter(F.transform(F.split(F.lower("EUROVOC"), ";"), lambda t: F.trim(t)), lambda t: t != "")
    names = (
        raw_acts(spark, sf_dir)
        .where(F.col("EUROVOC").isNotNull())
        .select(F.explode(tags).alias("tag"))
        .distinct()
        .select(
            F.concat(F.lit("L "), F.col("tag")).alias("qid"),
            F.col("tag").alias("raw_query"),
            F.replace(F.col("tag"), F.lit(" "), F.lit("_")).alias("target_label"),
        )
    )
    edges = spark.createDataFrame(
        [
            ("E1", "", None),
            ("E2", "the of and", None),
            ("E3", "zzzz qqqq 2024", None),
            ("E4", "Toxic things, things and EN", "unknown_label"),
        ],
        "qid string, raw_query string, target_label string",
    )
    return passages.unionByName(names).unionByName(edges)
