"""Label statistics, the label vocabulary, targets and the train/test split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docquarry.config import DEFAULTS, Settings
from docquarry.operators.profile import order_statistics


def label_freq(corpus: DataFrame) -> DataFrame:
    """How often each tag occurs; a tag repeated within a document counts again."""
    return (
        corpus.select(F.explode("tags").alias("label"))
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_labels(corpus: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """``(label, n, rank)`` of the most frequent labels, rank from 1; ties by name.

    The limit is applied per task first, so the one task that numbers the rows sees few of them.
    """
    kept = label_freq(corpus).orderBy(F.col("n").desc(), "label").limit(settings.top_labels)
    by_count = Window.orderBy(F.col("n").desc(), F.col("label"))
    return kept.withColumn("rank", F.row_number().over(by_count))


def label_names(vocabulary: DataFrame) -> list[str]:
    """The vocabulary in rank order; its size is bounded by the ``top_labels`` setting."""
    return [row.label for row in vocabulary.orderBy("rank").collect()]


def with_kept_tags(corpus: DataFrame, names: list[str]) -> DataFrame:
    """Keep only vocabulary tags (duplicates stay) and documents that have one."""
    kept = F.filter("tags", lambda tag: tag.isin(*names) if names else F.lit(False))
    return corpus.withColumn("kept_tags", kept).where(F.size("kept_tags") > 0)


def binarized(kept: DataFrame, names: list[str]) -> DataFrame:
    """Distinct label positions per document, in vocabulary order."""
    order = F.array(*[F.lit(name) for name in names])
    places = F.array_sort(F.transform(F.array_distinct("kept_tags"), lambda t: (F.array_position(order, t) - 1).cast("int")))
    return kept.withColumn("targets", places)


def split_bucket(key: Column, seed: int) -> Column:
    """A stable number from 0 to 99 per row, from the id and the seed."""
    digest = F.md5(F.concat(key, F.lit(f"|{seed}")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100).cast("int")


def with_split(df: DataFrame, key: str = "doc_id", settings: Settings = DEFAULTS) -> DataFrame:
    """Add ``is_test``; the same id falls on the same side in every run and partitioning."""
    return df.withColumn(
        "is_test", split_bucket(F.col(key), settings.split_seed) < settings.test_percent
    )


def random_split(df: DataFrame, settings: Settings = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """Seeded random split; membership depends on the partitioning of ``df``."""
    share = settings.test_percent / 100.0
    train, test = df.randomSplit([1.0 - share, share], seed=settings.split_seed)
    return train, test


def with_exact_split(df: DataFrame, key: str = "doc_id", settings: Settings = DEFAULTS) -> DataFrame:
    """Add ``is_test``: exactly the share of rows whose seeded hashes are smallest, rounded up; ties by the key.

    The smallest hash that stays out is found by selection, not by a global sort, so membership is the same
    for any partitioning and no task holds more than the rows of one hash. ``key`` is unique per row.
    """
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{settings.split_seed}")))
    place = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")  # 52 bits, exact as a double
    rows = df.withColumn("place", place)
    total = df.count()
    wanted = -(-total * settings.test_percent // 100)
    if not wanted or wanted == total:
        return df.withColumn("is_test", F.lit(bool(wanted)))
    tall = rows.select(F.lit("place").alias("column_name"), F.col("place").alias("value"))
    edge, before = order_statistics(tall, [("place", wanted - 1)])["place", wanted - 1]
    at_edge = rows.where(F.col("place") == edge).select(key)
    inside = at_edge.orderBy(key).limit(wanted - before).withColumn("inside", F.lit(True))
    marked = rows.join(F.broadcast(inside), key, "left")  # the rows of one hash value
    return marked.withColumn("is_test", (F.col("place") < edge) | F.coalesce("inside", F.lit(False))).drop("place", "inside")


def label_index_stats(vocabulary: DataFrame, label_index: DataFrame) -> DataFrame:
    """Mean documents per label and the number of labels with at least one document."""
    counts = label_index.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    per_label = vocabulary.select("label").join(counts, "label", "left").select(
        F.coalesce("n", F.lit(0)).alias("n")
    )
    return per_label.agg(
        F.count(F.lit(1)).alias("labels"),
        F.avg("n").alias("avg_docs"),
        F.coalesce(F.sum((F.col("n") > 0).cast("long")), F.lit(0)).alias("nonempty_labels"),
    )
