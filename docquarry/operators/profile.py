"""Data inspection: counts, types, number summaries and first rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}

# Values that cut a bracket in each round of a selection.
CUTS = 63


def column_types(df: DataFrame) -> DataFrame:
    """Position, name and type of every column."""
    rows = [(place, field.name, field.dataType.simpleString()) for place, field in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, type string")


def null_profile(df: DataFrame) -> DataFrame:
    """Rows, non-null cells and type per column, from one pass."""
    counted = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(name).alias(name) for name in df.columns])
    tall = counted.unpivot(["rows"], df.columns, "column_name", "non_null")
    types = F.create_map(*[F.lit(part) for pair in df.dtypes for part in pair])
    return tall.withColumn("type", F.element_at(types, F.col("column_name")))


def number_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema if isinstance(field.dataType, T.NumericType)]


def order_statistics(tall: DataFrame, wanted: list[tuple[str, int]], cuts: int = CUTS) -> dict[tuple[str, int], tuple[float, int]]:
    """For each ``(column_name, rank)``, rank from 0: the value of that rank, and how many values are smaller.

    ``tall`` has ``column_name`` and ``value`` (double, not NULL). In each round approximate percentiles of
    the values in a bracket cut it, counts between the cuts tell where the rank lies, and the bracket
    shrinks to that place, or is done if the rank lies on a cut. Cuts follow the counts, not the values, so
    a round leaves about one value in ``cuts`` however skewed they are. Nothing is sorted and a task holds
    counts only.
    """
    spark = tall.sparkSession
    schema = "column_name string, rank long, low double, high double"
    # Between which values, both excluded, a rank is looked for (NULL: no end), and how many values are below.
    open_: dict[tuple[str, int], tuple] = {key: (None, None, 0) for key in set(wanted)}
    found: dict[tuple[str, int], tuple[float, int]] = {}
    while open_:
        rows = [(column, rank, low, high) for (column, rank), (low, high, _) in open_.items()]
        brackets = F.broadcast(spark.createDataFrame(rows, schema))  # one row per rank that is still open
        inside = tall.join(brackets, "column_name").where(
            (F.col("low").isNull() | (F.col("value") > F.col("low"))) & (F.col("high").isNull() | (F.col("value") < F.col("high")))
        )
        shares = [(i + 1) / (cuts + 1) for i in range(cuts)]
        points = inside.groupBy("column_name", "rank").agg(F.percentile_approx("value", shares, 10 * cuts).alias("points"))
        points = [(r["column_name"], r["rank"], sorted(set(r["points"]))) for r in points.collect()]
        known = F.broadcast(spark.createDataFrame(points, "column_name string, rank long, points array<double>"))
        below = F.size(F.filter("points", lambda p: p < F.col("value")))
        up_to = F.size(F.filter("points", lambda p: p <= F.col("value")))
        counts = inside.join(known, ["column_name", "rank"]).groupBy("column_name", "rank", below.alias("below"), up_to.alias("up_to"))
        places: dict[tuple[str, int], list] = {}
        for r in counts.agg(F.count(F.lit(1)).alias("n")).collect():  # at most two rows per cut
            places.setdefault((r["column_name"], r["rank"]), []).append((r["below"], r["up_to"], r["n"]))
        still = {}
        for column, rank, cut_at in points:
            low, high, before = open_[column, rank]
            for below_n, up_to_n, n in sorted(places[column, rank]):
                if before + n > rank:
                    break
                before += n
            if up_to_n > below_n:
                found[column, rank] = (cut_at[below_n], before)
            else:
                left = cut_at[below_n - 1] if below_n else low
                still[column, rank] = (left, cut_at[below_n] if below_n < len(cut_at) else high, before)
        open_ = still
    return found


def describe_numbers(df: DataFrame) -> DataFrame:
    """Count, mean, deviation, extremes and exact interpolated quartiles of number columns."""
    names = number_columns(df)
    tall = df.select(*[F.col(name).cast("double").alias(name) for name in names]).unpivot(
        [], names, "column_name", "value"
    ).where(F.col("value").isNotNull())
    summary = tall.groupBy("column_name").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    ).collect()  # one row per column
    places = {(row["column_name"], name): p * (row["count"] - 1) for row in summary for name, p in QUARTILES.items()}
    wanted = [(column, rank) for (column, _), place in places.items() for rank in (math.floor(place), math.ceil(place))]
    found = order_statistics(tall, wanted) if wanted else {}
    rows = []
    for row in summary:
        quartiles = []
        for name in QUARTILES:
            place = places[row["column_name"], name]
            floor, ceil = (found[row["column_name"], rank][0] for rank in (math.floor(place), math.ceil(place)))
            quartiles.append(floor + (ceil - floor) * (place - math.floor(place)))
        rows.append((*row, *quartiles))
    schema = "column_name string, count long, mean double, std double, min double, max double"
    return df.sparkSession.createDataFrame(rows, schema + "".join(f", {name} double" for name in QUARTILES))


def first_rows(df: DataFrame, order: str, n: int = 5) -> DataFrame:
    return df.orderBy(order).limit(n)
