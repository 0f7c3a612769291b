"""Cleaning of raw act tables and parsing of their tags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquarry.config import ACT_COLUMNS, ID_COLUMN, MISSING_SPELLINGS, TAG_COLUMN, TEXT_COLUMN


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the table has {df.columns}")


def blank_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Turn the spellings of a missing value into NULL."""
    return df.withColumns({
        name: F.when(~F.col(name).isin(*MISSING_SPELLINGS), F.col(name)) for name in columns
    })


def parse_tags(tags: Column) -> Column:
    """Split on ``;``, trim, drop empty tags; order and duplicates stay."""
    trimmed = F.transform(F.split(tags, ";"), lambda tag: F.regexp_replace(tag, r"(?U)^\s+|\s+$", ""))
    return F.when(tags == "nan", F.array().cast("array<string>")).otherwise(
        F.filter(trimmed, lambda tag: tag != "")
    )


def clean_acts(
    df: DataFrame,
    columns: Sequence[str] = ACT_COLUMNS,
    text_column: str = TEXT_COLUMN,
    tag_column: str = TAG_COLUMN,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Rows with a text; kept columns lowercased with '' for missing; tags as an array.

    ``carry`` names columns that pass through untouched, such as a row order.
    """
    require_columns(df, [*columns, text_column])
    kept = df.select(*carry, *columns).where(F.col(text_column).isNotNull())
    lowered = kept.withColumns({
        name: F.lower(F.coalesce(F.col(name).cast("string"), F.lit(""))) for name in columns
    })
    if tag_column not in columns:
        return lowered
    return lowered.withColumn(tag_column, parse_tags(F.col(tag_column)))


def dropped_counts(df: DataFrame, text_column: str = TEXT_COLUMN) -> DataFrame:
    """How many rows a clean keeps and drops, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count(text_column).alias("rows_kept"),
        (F.count(F.lit(1)) - F.count(text_column)).alias("rows_dropped"),
    )


def missing_id_counts(acts: DataFrame, id_column: str = ID_COLUMN) -> DataFrame:
    """Of cleaned acts: all rows, rows without an id, and how many of these a corpus of unique ids would lose."""
    without = F.coalesce(F.sum((F.col(id_column) == "").cast("long")), F.lit(0))
    return acts.agg(
        F.count(F.lit(1)).alias("rows"), without.alias("without_id"), F.greatest(without - 1, F.lit(0)).alias("rows_lost")
    )


def with_own_ids(acts: DataFrame, order: str, id_column: str = ID_COLUMN) -> DataFrame:
    """Cleaned acts where rows without an id get one of their own, ``row `` and their order, so all are kept apart."""
    own = F.concat(F.lit("row "), F.col(order).cast("string"))
    return acts.withColumn(id_column, F.when(F.col(id_column) == "", own).otherwise(F.col(id_column)))


def text_preview(text: Column, length: int = 150) -> Column:
    """The first characters, with three dots only when the text goes on."""
    return F.when(F.length(text) > length, F.concat(F.substring(text, 1, length), F.lit("..."))).otherwise(text)


def preview_rows(df: DataFrame, id_column: str = "CELEX", text_column: str = TEXT_COLUMN,
                 tag_column: str = TAG_COLUMN, carry: Sequence[str] = (), length: int = 150) -> DataFrame:
    """Id, text preview and tags of each row; an absent column shows as ``N/A``."""

    def shown(name: str) -> Column:
        return F.col(name).cast("string") if name in df.columns else F.lit("N/A")

    return df.select(
        *carry,
        shown(id_column).alias("id"),
        text_preview(shown(text_column), length).alias("preview"),
        shown(tag_column).alias("tags"),
    )
