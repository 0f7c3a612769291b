"""Scoring formulas as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bm25_idf(total_documents: int, df: Column) -> Column:
    return F.log((F.lit(float(total_documents)) - df + 0.5) / (df + 0.5) + 1.0)


def bm25_saturation(tf: Column, length: Column, avgdl: float, k1: float, b: float) -> Column:
    # With an average of 0 there is no posting to score, so the length ratio is left out.
    ratio = length / F.lit(avgdl) if avgdl else F.lit(1.0)
    return tf * (k1 + 1.0) / (tf + k1 * (1.0 - b + b * ratio))


def smooth_idf(documents: int, df: Column) -> Column:
    return F.log((1.0 + documents) / (1.0 + df)) + 1.0
