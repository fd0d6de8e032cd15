"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule rejects a text by an expression of its own. On a bounded sample the share that a rule
rejects and the time it takes are measured, and the rules are ordered by rejection per cost. The cascade is
one conditional expression in that order: what an early rule rejects, later ones do not look at. The
verdict does not depend on the order, so neither does it on the measured times.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtally.llm.common import WORD
from logtally.operators.once import evaluate_once

#: Rows of the sample that costs and selectivities are estimated on, about.
SAMPLE_ROWS = 1000
#: Rows that a rule is timed on, about, and their words; the sample is repeated up to them.
TIMED_ROWS, TIMED_WORDS = 5000, 2_000_000
_BLANK = " \t\n\x0b\f\r"
_SYMBOLS = "[^#*$%&|<>]+"


@dataclass(frozen=True)
class Rule:
    """``rejects`` is an expression over the text, ``words`` and the measures."""

    name: str
    rejects: Column = field(repr=False)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column) -> Column:
    """How many words lie in 3-word windows that occur twice or more.

    Windows are compared by hash. Texts whose windows are all distinct end there; otherwise windows are
    sorted by hash to find those that have an equal neighbour, and the words under them are counted.
    """
    zero = F.lit(0).cast("bigint")

    def under(places: Column) -> Column:
        # A window at i covers three words, less those that the window before it has covered.
        start = F.struct(F.lit(-3).alias("last"), zero.alias("n"))
        return F.aggregate(
            places, start, lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")), lambda a: a["n"]
        )

    def repeated(sort: Column) -> Column:
        same = lambda k, j: F.get(sort, k)["h"] == F.get(sort, j)["h"]
        hits = F.filter(
            F.sequence(F.lit(0), F.size(sort) - 1), lambda k: F.coalesce(same(k, k - 1), F.lit(False)) | F.coalesce(same(k, k + 1), F.lit(False))
        )
        return under(F.sort_array(F.transform(hits, lambda k: F.get(sort, k)["i"])))

    def of(hashes: Column) -> Column:
        paired = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), zero).otherwise(_let(paired, repeated))

    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    )
    return F.when(F.size(words) < 4, zero).otherwise(_let(windows, of))


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``words`` and the base measures of each whole text; a null text counts as empty."""
    whole = F.coalesce(text, F.lit(""))
    found = evaluate_once(df, "words", F.regexp_extract_all(whole, F.lit(WORD), F.lit(0)))
    lines = F.filter(F.split(whole, "\n", -1), lambda line: F.btrim(line, F.lit(_BLANK)) != "")
    again = _let(lines, lambda kept: F.size(kept) - F.size(F.array_distinct(kept)))
    measures = F.struct(
        F.size("words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.char_length(F.regexp_replace(whole, _SYMBOLS, "")).cast("bigint").alias("n_symbols"),
        again.cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("words")).cast("bigint").alias("n_repeat_words"),
    )
    return evaluate_once(found, "_measures", measures).select(*found.columns, "_measures.*")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def default_rules(text: str = "text") -> tuple[Rule, ...]:
    """Rules that ordinary prose of any length passes.

    Distinct words grow with about the root of a text's length, so their rule asks for a tenth of the words or for
    twice that root, whichever is less.
    """
    n = F.col("n_words")
    lines = F.size(F.split(F.coalesce(text, F.lit("")), "\n", -1))
    letters = F.size(F.filter("words", lambda w: w.rlike(r"\p{L}")))
    distinct = F.size(F.array_distinct("words")).cast("bigint")
    longest = F.aggregate("words", F.lit(0), lambda m, w: F.greatest(m, F.char_length(w)))
    return (
        Rule("word_length", (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n)),
        Rule("symbols", 4 * F.col("n_symbols") > n),
        Rule("duplicate_lines", 2 * F.col("n_dup_lines") > lines),
        Rule("words_with_letters", 10 * letters < 6 * n),
        Rule("distinct_words", _let(distinct, lambda d: (10 * d < n) & (d * d < 4 * n))),
        Rule("longest_word", longest > 1000),
    )


def profile(sample: DataFrame, rules: Sequence[Rule], rows: int = TIMED_ROWS) -> list[tuple[Rule, float, float]]:
    """For each rule the share of a sample (with the measures) that it rejects and its seconds a row.

    A job takes time of its own, which on a small sample is more than any rule's. So the sample is repeated
    to about ``rows`` rows, or ``TIMED_WORDS`` words if texts are long, and the time of a rule that looks at nothing is taken off.
    """
    sample = sample.persist()
    try:
        size, words = sample.agg(F.count("*"), F.coalesce(F.sum("n_words"), F.lit(0))).first()
        times = max(1, min(-(-rows // max(size, 1)), TIMED_WORDS // max(words, 1)))
        again = sample.withColumn("_again", F.explode(F.sequence(F.lit(1), F.lit(times))))

        def timed(rejects: Column) -> tuple[int, float]:
            took, rejected = [], 0
            for _ in range(3):  # the first run also compiles the expression
                began = time.perf_counter()
                rejected = again.agg(F.count_if(F.coalesce(rejects, F.lit(False)))).first()[0]
                took.append(time.perf_counter() - began)
            return rejected, min(took)

        _, idle = timed(F.size("words") < 0)
        found = [(rule, *timed(rule.rejects)) for rule in rules]
        return [(rule, rejected / max(size * times, 1), max(took - idle, 0.0) / max(size * times, 1)) for rule, rejected, took in found]
    finally:
        sample.unpersist()


def ordered(profiled: Sequence[tuple[Rule, float, float]]) -> list[Rule]:
    """By rejection per cost, the highest first; ties by name."""
    return [rule for rule, _, _ in sorted(profiled, key=lambda p: (-p[1] / max(p[2], 1e-8), p[0].name))]


def cascade(rules: Sequence[Rule]) -> Column:
    """True if no rule rejects; evaluation stops at the first that does."""
    verdict = F.lit(True)
    for rule in reversed(rules):
        verdict = F.when(rule.rejects, F.lit(False)).otherwise(verdict)
    return verdict


def quality_filter(
    df: DataFrame, text: str = "text", id_col: str = "doc_id", rules: Sequence[Rule] | None = None, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """Add the measures, ``base_failed`` and ``kept``; columns of these names are replaced.

    ``kept`` is false where the base rules fail (under 50 words, or over half of them in repeated
    windows) or a rule rejects. Null and empty texts have no words and fail. Empty tables give empty results.
    """
    own = ("words", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    df = df.drop(*own)
    rules = default_rules(text) if rules is None else rules
    total = df.count()
    rate = min(1.0, sample_rows / max(total, 1))
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit("quality sample")), F.lit(1 << 30)) / (1 << 30)
    sample = measured(df.filter(draw < rate).limit(2 * sample_rows), text)
    order = ordered(profile(sample.filter(~base_failed()), rules))
    judged = measured(df, text).withColumn("base_failed", base_failed())
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(cascade(order))
    return judged.withColumn("kept", kept).drop("words")
