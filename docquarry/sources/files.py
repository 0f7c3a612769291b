"""CSV and text readers. Rows carry their place in the file where a later row may win."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.config import ACT_COLUMNS, FORCED_TEXT_COLUMNS
from docquarry.operators.clean import blank_to_null, require_columns

log = logging.getLogger(__name__)


def file_order() -> Column:
    """Sortable place of a row: file, block within the file, row within the task.

    Only valid in the first select on a scan. No global numbering, so no single task. Digits in
    paths compare as numbers, so ``2.csv`` comes before ``10.csv``.
    """
    runs = F.regexp_extract_all(F.col("_metadata.file_path"), F.lit(r"\d+|\D+"), F.lit(0))
    return F.struct(
        F.transform(runs, lambda run: F.when(run.rlike(r"^\d+$"), F.lpad(run, 24, "0")).otherwise(run)).alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def _csv(spark: SparkSession):
    """Quoted fields may hold line breaks and doubled quotes.

    Such files cannot be split, so a large corpus should come as many files.
    """
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"')


def read_acts(spark: SparkSession, path: str, columns: Sequence[str] = ACT_COLUMNS) -> DataFrame:
    """Chosen columns of an act CSV as strings, missing-value spellings as NULL, plus ``row_order``.

    Only these columns are parsed. A missing file or column raises.
    """
    scan = _csv(spark).csv(path)
    require_columns(scan, columns)
    return blank_to_null(scan.select(*columns, file_order().alias("row_order")), columns)


def read_wide_acts(
    spark: SparkSession, path: str, text_columns: Sequence[str] = FORCED_TEXT_COLUMNS
) -> DataFrame:
    """All columns; the named ones as written, the types of the others inferred from the data.

    Missing-value spellings are cleared before types are chosen, as a number column may hold them.
    """
    strings = _csv(spark).csv(path)
    cleared = blank_to_null(strings, strings.columns)
    fixed = [name for name in text_columns if name in strings.columns]
    kinds = inferred_types(cleared.drop(*fixed))
    return cleared.select(
        *[F.col(f"`{name}`").cast(kinds.get(name, T.StringType())).alias(name) for name in strings.columns]
    )


def inferred_types(strings: DataFrame) -> dict[str, T.DataType]:
    """Long, double, boolean or string per column, from one pass of counts."""
    tests = {
        "long": (T.LongType(), r"^\s*[+-]?\d{1,18}\s*$"),
        "double": (T.DoubleType(), r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)\s*$"),
        "boolean": (T.BooleanType(), r"^(True|False|TRUE|FALSE|true|false)$"),
    }
    counts = strings.agg(
        *[F.count(f"`{name}`").alias(f"{name}|all") for name in strings.columns],
        *[
            F.count(F.when(F.col(f"`{name}`").rlike(pattern), True)).alias(f"{name}|{kind}")
            for name in strings.columns
            for kind, (_, pattern) in tests.items()
        ],
    ).first()
    kinds: dict[str, T.DataType] = {}
    for name in strings.columns:
        fitting = [data for kind, (data, _) in tests.items() if counts[f"{name}|{kind}"] == counts[f"{name}|all"]]
        kinds[name] = fitting[0] if counts[f"{name}|all"] and fitting else T.StringType()
    return kinds


def read_head(spark: SparkSession, path: str, n: int = 5) -> DataFrame:
    """The first rows of a CSV, all columns as strings."""
    strings = _csv(spark).csv(path)
    return blank_to_null(strings.limit(n), strings.columns)


def or_none(read: Callable[[], DataFrame]) -> DataFrame | None:
    """For inspection jobs: a missing source is logged and gives None instead of an error."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.error("source is missing: %s", error)
        return None


def read_id_map(spark: SparkSession, path: str, source: str = "DocID", target: str = "CelexID") -> DataFrame:
    """The two id columns of a CSV and ``row_order``."""
    scan = _csv(spark).csv(path)
    require_columns(scan, [source, target])
    return scan.select(source, target, file_order().alias("row_order"))


def read_judgment_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines and ``row_order``."""
    return spark.read.text(path).select(F.col("value").alias("line"), file_order().alias("row_order"))
