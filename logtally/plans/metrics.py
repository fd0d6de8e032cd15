"""All metrics of a set of entries at once.

A batch makes one pass and one exchange: every line gives one row for each thing it counts for, as
grouping sets do, and these are added up by metric and key in each task before anything moves. So
a task has as many groups as there are files, hours and names, not their product. A stream takes
lines apart in the same way, without the time range. Both give the same ``metric, key, count`` rows, with
``metric`` one of total, processed, malformed, level, pattern, keyword, hour, file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtally.functions.levels import LEVELS, is_error_level
from logtally.functions.literal import literal_rows
from logtally.functions.patterns import (
    DEFAULT_KEYWORDS,
    ERROR_RULES,
    Rule,
    error_patterns_of,
    exception_name,
    keywords_of,
    rule_matches,
)
from logtally.functions.text import contains_ignore_case
from logtally.functions.timestamps import hour_label, hour_number

TOTALS = ("total", "processed", "malformed")
COUNTED_COLUMNS = ("level", "source_file", "ts", "message", "raw", "malformed")
SUMMARY_SCHEMA = "metric string, key string, count bigint, earliest timestamp_ntz, latest timestamp_ntz"


def _marked(entries: DataFrame) -> DataFrame:
    """The columns that are counted by, and a row of weight 0 for each level, so that what must be there is."""
    own = entries.select(*COUNTED_COLUMNS, F.lit(1).alias("_weight"))
    none = [F.lit(None).cast(own.schema[c].dataType).alias(c) for c in ("source_file", "ts", "message", "raw")]
    levels = literal_rows(entries.sparkSession, "level", [(level,) for level in LEVELS])
    return own.union(levels.select("level", *none, F.lit(True), F.lit(0)))


def summarize(
    entries: DataFrame,
    rules: Sequence[Rule] = ERROR_RULES,
    keywords: Sequence[str] = DEFAULT_KEYWORDS,
) -> DataFrame:
    """``metric, key, count, earliest, latest``: additive counts, the time range in the row of the total.

    There is a row for each level and total even if nothing was counted; ``processed`` is that of the total.
    """
    message, lower, hour = F.col("message"), F.col("_lower"), F.col("key").cast("bigint")
    rows = _marked(entries).withColumn("_lower", F.lower("raw"))
    is_error = is_error_level(F.col("level"))
    slots = {
        "total": F.lit(""),
        "malformed": F.when(F.col("malformed"), F.lit("")),
        "level": F.col("level"),
        "file": F.col("source_file"),
        "hour": hour_number(F.col("ts")).cast("string"),
        "pattern": F.when(is_error, exception_name(message)),
    }
    slots |= {f"pattern:{i}": F.when(is_error & rule_matches(message, regex), F.lit(name)) for i, (name, regex) in enumerate(rules)}
    slots |= {f"keyword:{i}": F.when(contains_ignore_case(lower, kw), F.lit(kw)) for i, kw in enumerate(keywords)}
    flat = rows.select("_weight", "ts", *(key.alias(slot) for slot, key in slots.items()))
    parts = flat.unpivot(["_weight", "ts"], list(slots), "_slot", "key").filter(F.col("key").isNotNull())
    time = F.when(F.col("_slot") == "total", F.col("ts"))
    summary = parts.groupBy(F.substring_index("_slot", ":", 1).alias("metric"), "key").agg(
        F.sum("_weight").cast("bigint").alias("count"), F.min(time).alias("earliest"), F.max(time).alias("latest")
    )
    return summary.withColumn("key", F.when(F.col("metric") == "hour", hour_label(hour)).otherwise(F.col("key")))


def _zeros(spark: SparkSession) -> DataFrame:
    """The metrics that are there even if nothing was counted."""
    rows = [(name, "", 0) for name in TOTALS] + [("level", level, 0) for level in LEVELS]
    return literal_rows(spark, "metric, key, count", rows)


def add_up(*metrics: DataFrame) -> DataFrame:
    """Sum ``metric, key, count`` rows from several sources, for example a batch and a stream."""
    rows = _zeros(metrics[0].sparkSession)
    for part in metrics:
        rows = rows.unionByName(part.select("metric", "key", "count"))
    return rows.groupBy("metric", "key").agg(F.sum("count").alias("count"))


def metrics_of(summary: DataFrame) -> DataFrame:
    """The ``metric, key, count`` rows of a summary."""
    row = F.struct("metric", "key", "count")
    processed = F.struct(F.lit("processed").alias("metric"), "key", "count")
    return summary.select(F.inline(F.when(F.col("metric") == "total", F.array(row, processed)).otherwise(F.array(row))))


def overview_of(summary: DataFrame) -> DataFrame:
    """The overview row of a summary."""
    count = lambda metric: F.coalesce(F.sum(F.when(F.col("metric") == metric, F.col("count"))), F.lit(0))
    return summary.agg(
        count("total").alias("total"),
        count("total").alias("processed"),
        count("malformed").alias("malformed"),
        F.min("earliest").alias("earliest"),
        F.max("latest").alias("latest"),
    )


def all_metrics(
    entries: DataFrame,
    rules: Sequence[Rule] = ERROR_RULES,
    keywords: Sequence[str] = DEFAULT_KEYWORDS,
) -> DataFrame:
    """Every metric in one pass over the lines and one exchange."""
    return metrics_of(summarize(entries, rules, keywords))


def metric_rows(
    entries: DataFrame,
    rules: Sequence[Rule] = ERROR_RULES,
    keywords: Sequence[str] = DEFAULT_KEYWORDS,
) -> DataFrame:
    """One ``metric, key`` row for everything a line counts for; works on streams."""

    def one(name: str, key: Column) -> Column:
        return F.array(F.struct(F.lit(name).alias("metric"), key.alias("key")))

    def each(name: str, keys: Column) -> Column:
        return F.transform(keys, lambda key: F.struct(F.lit(name).alias("metric"), key.alias("key")))

    nothing = F.array().cast("array<struct<metric:string,key:string>>")
    patterns = each("pattern", error_patterns_of(F.col("message"), rules))
    rows = F.concat(
        one("total", F.lit("")),
        one("processed", F.lit("")),
        F.when(F.col("malformed"), one("malformed", F.lit(""))).otherwise(nothing),
        one("level", F.col("level")),
        one("file", F.col("source_file")),
        F.when(F.col("hour").isNotNull(), one("hour", F.col("hour"))).otherwise(nothing),
        F.when(is_error_level(F.col("level")), patterns).otherwise(nothing),
        each("keyword", keywords_of(F.col("_lower"), keywords)),
    )
    return entries.withColumn("_lower", F.lower("raw")).select(F.inline(rows))
