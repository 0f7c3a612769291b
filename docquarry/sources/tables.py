"""Saved artifacts as Parquet tables: corpus, index, model and tag index.

An artifact's path holds versions. A write fills a folder of its own, and a manifest that names it is
committed last, so readers see the last whole version and never half of one, also after a write that was
killed. A write that ends drops the versions before the one it replaces, which readers may still hold, and
what killed writes left behind.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.operators.index import Index
from docquarry.operators.search import Tagger, TagIndex
from docquarry.operators.svm import LinearModel
from docquarry.operators.tfidf import TfidfModel
from docquarry.session import bucket_count
from docquarry.sources.files import or_none

# Whole versions that a write leaves, its own included.
KEPT_VERSIONS = 2


class _Folder:
    """Files of any store that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        self.path = path

    def names(self, folder: str) -> list[str]:
        place = self._path(f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(place)) if self._fs.exists(place) else []

    def has(self, name: str) -> bool:
        return self._fs.exists(self._path(f"{self.path}/{name}"))

    def drop(self, name: str) -> None:
        self._fs.delete(self._path(f"{self.path}/{name}"), True)


def versions(spark: SparkSession, path: str) -> list[str]:
    """The whole versions of an artifact, oldest first."""
    folder = _Folder(spark, path)
    # Spark's writers put this file last.
    return [name for name in folder.names("manifests") if folder.has(f"manifests/{name}/_SUCCESS")]


def save_version(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Fill a new version's folder by ``write``, commit its manifest, and drop what is no longer needed."""
    folder = _Folder(spark, path)
    number = 1 + max((_number(held) for held in folder.names("versions")), default=0)
    name = f"{number:09d}_{uuid.uuid4().hex[:12]}"
    write(f"{path}/versions/{name}")
    spark.range(1).select(F.lit(name).alias("version")).write.parquet(f"{path}/manifests/{name}")
    kept = versions(spark, path)[-KEPT_VERSIONS:]
    for part in ("manifests", "versions"):
        for old in folder.names(part):
            # Equal and later numbers belong to writers that are still at work.
            if old not in kept and _number(old) < number:
                folder.drop(f"{part}/{old}")
    return name


def _number(version: str) -> int:
    return int(version.split("_")[0])


def current_version(spark: SparkSession, path: str) -> str:
    """The folder of the last whole version; a path without one raises as a missing table does."""
    whole = versions(spark, path)
    if not whole:
        spark.read.parquet(f"{path}/manifests/none")
    return f"{path}/versions/{whole[-1]}"


def save_corpus(df: DataFrame, path: str) -> None:
    """Write a processed corpus; arrays stay arrays."""
    save_version(df.sparkSession, path, df.write.parquet)


def load_corpus(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(current_version(spark, path))


def _save_by_document(df: DataFrame, path: str, sort_by: str) -> int:
    spark, name = df.sparkSession, _table_name()
    buckets = bucket_count(spark)
    (
        df.repartition(buckets, "doc_id")
        .write.format("parquet")
        .option("path", path)
        .bucketBy(buckets, "doc_id")
        .sortBy(sort_by)
        .saveAsTable(name)
    )
    spark.sql(f"drop table {name}")  # the files stay, as they lie at a path of their own
    return buckets


def _load_by_document(spark: SparkSession, path: str, buckets: int, sort_by: str) -> DataFrame:
    """Declare saved files as a bucketed table again, so grouping by document needs no shuffle."""
    schema = spark.read.parquet(path).schema
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    name = _table_name()
    spark.sql(
        f"create table {name} ({columns}) using parquet clustered by (doc_id) "
        f"sorted by ({sort_by}) into {buckets} buckets location '{path}'"
    )
    return spark.table(name)


def _table_name() -> str:
    return f"docquarry_saved_{uuid.uuid4().hex[:12]}"


def save_index(index: Index, path: str) -> None:
    spark = index.postings.sparkSession

    def write(folder: str) -> None:
        buckets = _save_by_document(index.postings, f"{folder}/postings", "term")
        index.doc_freq.write.parquet(f"{folder}/doc_freq")
        spark.createDataFrame(
            [(index.total_documents, index.avgdl, buckets)], "total_documents long, avgdl double, buckets int"
        ).write.parquet(f"{folder}/stats")

    save_version(spark, path, write)


def load_index(spark: SparkSession, path: str) -> Index:
    folder = current_version(spark, path)
    stats = spark.read.parquet(f"{folder}/stats").first()
    return Index(
        _load_by_document(spark, f"{folder}/postings", stats.buckets, "term"),
        spark.read.parquet(f"{folder}/doc_freq"),
        stats.total_documents,
        stats.avgdl,
    )


def save_tagger(tagger: Tagger, path: str) -> None:
    spark = tagger.tfidf.table.sparkSession

    def write(folder: str) -> None:
        tagger.tfidf.table.write.parquet(f"{folder}/vocabulary")
        tagger.model.to_table(spark).write.parquet(f"{folder}/models")

    save_version(spark, path, write)


def load_tagger(spark: SparkSession, path: str) -> Tagger:
    folder = current_version(spark, path)
    vocabulary = spark.read.parquet(f"{folder}/vocabulary")
    model = LinearModel.from_table(spark.read.parquet(f"{folder}/models"))
    return Tagger(TfidfModel(vocabulary, vocabulary.count()), model)


def save_tag_index(tag_index: TagIndex, path: str) -> None:
    spark = tag_index.doc_labels.sparkSession

    def write(folder: str) -> None:
        buckets = _save_by_document(tag_index.doc_labels, f"{folder}/doc_labels", "doc_id")
        tag_index.combos.write.parquet(f"{folder}/combos")
        tag_index.heads.write.parquet(f"{folder}/heads")
        spark.range(1).select(F.lit(buckets).alias("buckets")).write.parquet(f"{folder}/layout")

    save_version(spark, path, write)


def empty_tag_index(spark: SparkSession) -> TagIndex:
    """The tag index of a missing corpus: every label has no documents."""
    return TagIndex(
        spark.createDataFrame([], "doc_id string, labels array<string>"),
        spark.createDataFrame([], "labels array<string>, n long"),
        spark.createDataFrame([], "label string, doc_id string, place int"),
    )


def load_tag_index(spark: SparkSession, path: str, missing_ok: bool = False) -> TagIndex:
    """A saved tag index; with ``missing_ok`` a missing one is logged and gives an empty index."""
    if missing_ok and or_none(lambda: spark.read.parquet(f"{current_version(spark, path)}/layout")) is None:
        return empty_tag_index(spark)
    folder = current_version(spark, path)
    buckets = spark.read.parquet(f"{folder}/layout").first().buckets
    return TagIndex(
        _load_by_document(spark, f"{folder}/doc_labels", buckets, "doc_id"),
        spark.read.parquet(f"{folder}/combos"),
        spark.read.parquet(f"{folder}/heads"),
    )
