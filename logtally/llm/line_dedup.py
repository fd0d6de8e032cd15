"""Line deduplication by distinct-site spread.

A line that stands on many sites is boilerplate: license lines, navigation, shared passages. Each
line hash has a HyperLogLog sketch of the sites it occurs on; sketches merge in the aggregation. Lines
whose estimate lies near the threshold are counted exactly, so the result is that of exact counts. The
first occurrence of such a line in the corpus stays, all others go.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtally.llm.common import WORD, join_hot, join_on, stored
from logtally.session import ensure_checkpoint_dir

#: Sites from which on a line is boilerplate, and the words a line needs to be judged at all.
MIN_SITES, MIN_WORDS = 4, 3
#: Registers of a sketch (power of two), and how many standard errors count as near the threshold.
LOG_REGISTERS, NEAR_ERRORS = 12, 5
_BLANK = " \t\n\x0b\f\r"


def near_margin(sites: int, log_registers: int = LOG_REGISTERS) -> int:
    return 1 + math.ceil(NEAR_ERRORS * 1.04 / math.sqrt(1 << log_registers) * sites)


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def occurrences(df: DataFrame, id_col: str, text: str, site: str, min_words: int) -> DataFrame:
    """``(id, digest, pos, h1, h2, site)`` of every line that is judged, trimmed of ASCII white space."""
    rows = df.select(
        F.col(id_col).alias("id"),
        F.xxhash64(site, text).alias("digest"),
        F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"),
        F.posexplode(_lines(F.col(text))).alias("pos", "line"),
    )
    line = F.btrim("line", F.lit(_BLANK))
    enough = F.regexp_count("line", F.lit(WORD)) >= min_words
    return rows.filter(enough).select("id", "digest", "pos", F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2"), "site")


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, log_registers: int = LOG_REGISTERS) -> DataFrame:
    """``(h1, h2, first, n)`` of the lines on at least ``min_sites`` sites; ``first`` is what stays, ``n`` their number."""
    margin = near_margin(min_sites, log_registers)
    first = F.min(F.struct("id", "digest", "pos")).alias("first")
    sketch = F.hll_sketch_agg("site", log_registers).alias("sketch")
    spread = lines.groupBy("h1", "h2").agg(sketch, first, F.count("*").alias("n"))
    spread = spread.withColumn("sites", F.hll_sketch_estimate("sketch")).drop("sketch")
    spread = spread.filter(F.col("sites") >= max(2, min_sites - margin)).checkpoint()
    near = spread.filter(F.col("sites") <= min_sites + margin).select("h1", "h2", "first", "n")
    held = join_hot(lines, near.select("h1", "h2"), ["h1", "h2"], near, ["id", "digest", "pos"])
    exact = held.select("h1", "h2", "site").distinct()
    exact = exact.groupBy("h1", "h2").count().filter(F.col("count") >= min_sites).select("h1", "h2")
    sure = spread.filter(F.col("sites") > min_sites + margin).select("h1", "h2", "first", "n")
    return sure.unionByName(near.join(exact, ["h1", "h2"], "left_semi"))


def removed_lines(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = MIN_SITES, min_words: int = MIN_WORDS
) -> DataFrame:
    """``(id, digest, removed)``: the positions of the lines that go, for documents that lose some."""
    ensure_checkpoint_dir(df.sparkSession)
    lines = stored(occurrences(df, id_col, text, site, min_words), "lines")
    common = boilerplate(lines, min_sites).checkpoint()
    found = join_hot(lines, common.drop("n"), ["h1", "h2"], common, ["id", "digest", "pos"])
    gone = found.filter(~F.struct("id", "digest", "pos").eqNullSafe(F.col("first")))
    return gone.groupBy("id", "digest").agg(F.array_sort(F.collect_set("pos")).alias("removed"))


def line_dedup(
    df: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    site: str = "source",
    min_sites: int = MIN_SITES,
    min_words: int = MIN_WORDS,
    removed: str = "removed_lines",
) -> DataFrame:
    """``df`` with boilerplate lines taken out of ``text``; ``removed`` has their positions, from 0.

    Lines end at ``\\n`` and are compared without ASCII white space at their ends; those of under
    ``min_words`` words stay. A null site counts as the empty one. Null texts stay null. The first occurrence is
    the one of smallest id, then text hash, then position (null ids first). Rows that agree in id, site and
    text are treated alike. Documents are kept even if no line remains.
    """
    gone = removed_lines(df, id_col, text, site, min_sites, min_words)
    gone = gone.select(F.col("id").alias(id_col), F.col("digest").alias("_line_digest"), F.col("removed").alias("_line_removed"))
    keyed = df.drop(removed).withColumn("_line_digest", F.xxhash64(site, text))
    joined = join_on(keyed, gone, [id_col, "_line_digest"], "left")
    # The lines are bound once, then read by position.
    kept = F.transform(
        F.array(_lines(F.col(text))),
        lambda lines: F.array_join(
            F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_line_removed")), lambda i: F.get(lines, i)), "\n"
        ),
    )
    clean = F.when(F.col("_line_removed").isNull(), F.col(text)).otherwise(F.get(kept, F.lit(0)))
    none = F.array().cast("array<int>")
    out = joined.withColumn(text, clean).withColumn(removed, F.coalesce("_line_removed", none))
    return out.select(*[c for c in df.columns if c != removed], removed)
