from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import logtally as lt

SCHEMA = "ts timestamp_ntz, source_file string, line_number bigint, level string"
START = datetime(2024, 3, 10, 1, 59, 58)


def made(spark, spread: int, hot: float, untimed: float, rows: int = 20_000):
    """Entries around a change of clocks: a share of them at one time, a share without one; odd names and nulls."""
    rng = random.Random(spread)
    files = ["a.log", "b.log", 'q"uote\\.log', "ü\U0001f600.log", "￮.log", "", None]

    def time():
        if rng.random() < untimed:
            return None
        return START if rng.random() < hot else START + timedelta(microseconds=rng.randrange(spread))

    given = [(time(), rng.choice(files[:1] * 5 + files), rng.choice([None, *range(1, 60), k]), str(k)) for k in range(rows)]
    return spark.createDataFrame(given, SCHEMA).repartition(5)


@pytest.mark.parametrize(
    "spread, hot, untimed, ranges", [(10**10, 0, 0, 12), (10**7, 0.4, 0.3, 16), (3, 0, 0.9, 9), (1, 1, 0, 20), (5, 0, 1, 7), (9, 0.1, 0.1, 1)]
)
def test_equals_the_sort(spark, spread, hot, untimed, ranges):
    entries = made(spark, spread, hot, untimed)
    out = lt.chronological_once(entries, ranges)
    key = ["ts", "source_file", "line_number"]
    assert [tuple(r[c] for c in key) for r in out.collect()] == [tuple(r[c] for c in key) for r in lt.chronological(entries).collect()]
    assert Counter(r.level for r in out.collect()) == Counter(r.level for r in entries.collect())
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("range")).count().collect()]
    most = entries.groupBy(*key).count().agg(F.max("count")).first()[0]
    assert max(sizes) <= 2.5 * 20_000 / ranges + 1.2 * most


def test_nothing_to_order(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert lt.chronological_once(empty).collect() == []
    assert lt.chronological_once(empty, 3).columns == empty.columns


def test_lines_are_parsed_once(spark, lines_of):
    """No pattern is matched above what is written; the exchange takes ranges that are known."""
    lines = lines_of(*(f"2024-06-01 08:15:{k % 60:02} INFO [t] l - m" for k in range(500)))
    plan = lt.chronological_once(lt.parse_logs(lines), 4)._jdf.queryExecution().executedPlan().toString()
    assert "regexp" not in plan and "rangepartitioning" not in plan
    assert "Scan parquet" in plan
