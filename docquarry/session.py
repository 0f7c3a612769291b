"""Session set-up, the shared folder, and tables written there to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Ways a common key is split in a salted join.
SALTS = 64

_local_folders: dict[str, str] = {}


def build_session(app_name: str = "docquarry", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans expect; a cluster's own settings win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    Only a local session may run without the setting; it then gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    chosen = context.getCheckpointDir()
    if chosen:
        return chosen.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="docquarry-")
    return _local_folders[app]


def bucket_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def store(
    df: DataFrame,
    name: str,
    bucket_by: str | None = None,
    sort_by: tuple[str, ...] = (),
    distributed: bool = False,
) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage, survives lost executors and gives Catalyst the true size. With
    ``bucket_by`` the rows are hash-distributed on that column, and later grouping or joining on
    it needs no shuffle. ``distributed`` says that the plan already ends hash-distributed on that
    column, so the write adds no shuffle either.
    """
    spark = df.sparkSession
    unique = f"{name}_{uuid.uuid4().hex[:12]}"
    path = f"{shared_folder(spark)}/docquarry/{unique}"
    if bucket_by is None:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    buckets = bucket_count(spark)
    rows = df if distributed else df.repartition(buckets, bucket_by)
    writer = rows.write.format("parquet").option("path", path).bucketBy(buckets, bucket_by)
    if sort_by:
        writer = writer.sortBy(*sort_by)
    writer.saveAsTable(f"docquarry_{unique}")
    return spark.table(f"docquarry_{unique}")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash rows over all cores when a scan has fewer tasks than the cluster has cores.

    Large inputs have many splits and pass through unchanged. Only file sizes are asked for; no job runs.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = int(spark._jvm.org.apache.spark.sql.internal.SQLConf.get().filesMaxPartitionBytes())
    if input_bytes(df, cores * split) >= cores * split:
        return df
    return df.repartition(cores, key)


def input_bytes(df: DataFrame, enough: int) -> int:
    """Bytes of the files that the plan reads, counted until there are ``enough``."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsparkSession.sessionState().newHadoopConf()
    total = 0
    for name in df.inputFiles():
        path = jvm.org.apache.hadoop.fs.Path(name)
        total += path.getFileSystem(conf).getFileStatus(path).getLen()
        if total >= enough:
            break
    return total


def fits(df: DataFrame, max_rows: int) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def join_hot(large: DataFrame, small: DataFrame, key: str, spread_on: str, max_rows: int) -> DataFrame:
    """Inner join on a key that may hold a large part of all rows.

    A small side of at most ``max_rows`` rows goes to every task and the large side stays where it
    is. Beyond that, both sides are shuffled on the key and a salt taken from ``spread_on``, so the
    rows of one common key spread over ``SALTS`` tasks.
    """
    if fits(small, max_rows):
        return large.join(F.broadcast(small), key)
    salted = large.withColumn("salt", F.pmod(F.xxhash64(spread_on), F.lit(SALTS)))
    copies = small.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(copies, [key, "salt"]).drop("salt")
