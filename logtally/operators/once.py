"""Keep an expensive expression from being evaluated more than once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Add a column that filters are not pushed through.

    A filter on an ordinary computed column moves below the projection and takes a copy of the
    expression with it. It stops at an explode, here of a single element.
    """
    return df.select("*", F.explode(F.array(column)).alias(name))
