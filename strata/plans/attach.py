"""Attach a one-row DataFrame (an aggregate, a window, a config row) to every row.

The one-row side has a proven size bound (a global aggregate has exactly one
row), so it is broadcast and joined on a constant key; no pairs are formed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    left = df.withColumn("_one", F.lit(1))
    right = one_row.withColumn("_one", F.lit(1))
    return left.join(F.broadcast(right), on="_one", how="left").drop("_one")
