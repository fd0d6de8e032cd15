"""The most frequent names out of very many, without sorting or shuffling all of them."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtally.functions.patterns import ERROR_RULES, Rule
from logtally.operators.counts import top_error_patterns
from logtally.operators.select import error_pattern_rows
from logtally.session import ensure_checkpoint_dir

log = logging.getLogger(__name__)

#: Names that a sketch keeps at most (some hundred bytes each).
TRACKED = 10_000
# A frequent-items sketch of 2^k slots, three quarters of which are used, is off by 3.5 / 2^k of all rows at most.
_SLOT_SHARE, _ERROR = 0.75, 3.5


def error_bound(rows: int, tracked: int = TRACKED) -> float:
    """How often a name may occur at most that the sketch does not return.

    It returns the names that certainly occur more often than its error; a name's count is known
    to within that error, so any other occurs at most twice as often.
    """
    slots = 1 << max(3, (int(tracked / _SLOT_SHARE + 1) - 1).bit_length())
    return 2 * _ERROR * rows / (slots // 2)  # for half the slots, to be on the safe side of rounding


def top_names(names: DataFrame, n: int = 10, tracked: int = TRACKED) -> DataFrame | None:
    """``pattern, count, rank`` of the ``n`` most frequent values of ``pattern``; None if that cannot be proven.

    Sketches of the tasks merge into one of bounded size, whose names are counted exactly. They are the top if
    the last of them occurs more often than any name that is left out can.
    """
    sketch = F.expr(f"approx_top_k(pattern, {tracked}, {tracked})")
    found = names.filter(F.col("pattern").isNotNull()).agg(F.count("*").alias("rows"), sketch.alias("top")).first()
    candidates = [row["item"] for row in found["top"] or []]
    if len(candidates) < n:
        return None
    spark = names.sparkSession
    listed = F.broadcast(spark.createDataFrame([(c,) for c in candidates], "pattern string"))  # at most ``tracked`` names
    counts = names.join(listed, "pattern").groupBy("pattern").count()
    best = top_error_patterns(counts, n).checkpoint()
    last = best.agg(F.min("count")).first()[0]
    return best if last > error_bound(found["rows"], tracked) else None


def heavy_error_patterns(entries: DataFrame, n: int = 10, rules: Sequence[Rule] = ERROR_RULES, tracked: int = TRACKED) -> DataFrame:
    """What ``top_error_patterns(error_patterns(entries), n)`` gives, for texts with very many exception names.

    Lines are parsed once; their names alone are kept for the second look. Where the counts lie too close together
    for a proof, or there are few names, all of them are counted and sorted.
    """
    ensure_checkpoint_dir(entries.sparkSession)
    names = error_pattern_rows(entries, rules).select("pattern").checkpoint()
    best = top_names(names, n, tracked)
    if best is not None:
        return best
    log.info("the %d most frequent names are not proven by a sketch of %d; all are counted", n, tracked)
    return top_error_patterns(names.groupBy("pattern").count(), n)
