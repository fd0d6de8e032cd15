"""A few fixed rows as part of a plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def literal_rows(spark: SparkSession, columns: str, rows: Sequence[tuple[int | str, ...]]) -> DataFrame:
    """Rows of integers and plain text (no quotes or backslashes) as an inline table.

    ``createDataFrame`` would spread the handful of rows over a task per core of the cluster.
    """
    tuples = ("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {', '.join(tuples)} AS rows({columns})")
