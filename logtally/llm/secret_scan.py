"""Secret scans by corpus-wide ownership frequency, in DataFrame functions only.

Candidates are the matches of three patterns (``KINDS``) and long tokens that mix cases and digits. Their
hashes are counted over the distinct repositories and owners that hold them: a value that many owners
have is a copied example, one that a single owner has in few repositories looks live. A token of the
second sort is reported beside the pattern matches, which are reported in any case.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtally.llm.common import join_hot, join_on, stored
from logtally.operators.once import evaluate_once
from logtally.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class Kind:
    """A pattern, the group that holds the value, and the length that the value needs at least."""

    name: str
    pattern: str
    group: int
    least: int


# The kinds of candidates. A minimum inside the pattern finds the same spans where a match is
# a whole run of its characters; "assign" needs its minimum afterwards, as a short match uses up its text.
KINDS = (
    Kind("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Kind("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    Kind("hex", r"[0-9a-f]{16,}", 0, 16),
)
#: Tokens that are reported if their owners are few.
OWNED = Kind("owned", r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[a-z0-9+/_-]*[A-Z])(?=[A-Z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{20,}", 0, 20)
#: Owners from which on a value counts as an example, and owners and repositories that a live one has at most.
EXAMPLE_OWNERS, LIVE_OWNERS, LIVE_REPOSITORIES = 3, 1, 3
#: Elements of a block of a running total.
RUN = 512


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, zero: Column, merge) -> Column:
    """For each element what ``merge`` makes of ``zero`` and all elements before it; ``merge`` is associative.

    Appending to an array copies it, so this goes by blocks of ``RUN`` elements: totals of the blocks first, then
    what comes before each block, then within. Time grows with the elements up to some millions of them.
    """

    def within(block: Column, start: Column) -> Column:
        # The last is what comes before the next block.
        return F.aggregate(
            block,
            F.array(start),
            lambda out, value: F.array_append(out, merge(F.element_at(out, -1), value)),
            lambda out: F.slice(out, F.lit(1), F.size(block)),
        )

    def blocked(blocks: Column) -> Column:
        starts = within(F.transform(blocks, lambda block: F.aggregate(block, zero, merge)), zero)
        return F.flatten(F.zip_with(blocks, starts, within))

    def cut(array: Column) -> Column:
        last = F.greatest(F.lit(0), F.floor((F.size(array) - 1) / RUN).cast("int"))
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(array, k * RUN + 1, F.lit(RUN)))

    return _let(_let(values, cut), blocked)


def spans_of(text: Column, kind: Kind, order: int) -> Column:
    """``array<struct<start, kind, end, value>>`` of a pattern's matches, in code points; value is a hash.

    The text between matches comes from a split at the same pattern; lengths of both give the places.
    """
    pattern, none = F.lit(kind.pattern), F.array().cast("array<struct<start:bigint,kind:int,end:bigint,value:bigint>>")

    def placed(found: Column) -> Column:
        between = F.split(text, kind.pattern, -1)
        values = F.regexp_extract_all(text, pattern, F.lit(kind.group)) if kind.group else found
        rows = F.zip_with(
            # One past the last match there is a last gap without one.
            F.slice(between, F.lit(1), F.size(found)),
            F.arrays_zip(found.alias("match"), values.alias("value")),
            lambda gap, m: F.struct(
                F.char_length(gap).cast("bigint").alias("gap"),
                F.char_length(m["match"]).cast("bigint").alias("length"),
                F.when(F.char_length(m["value"]) >= kind.least, F.xxhash64(m["value"])).alias("value"),
            ),
        )

        def spans(rows: Column) -> Column:
            taken = F.transform(rows, lambda r: r["gap"] + r["length"])
            starts = running(taken, F.lit(0).cast("bigint"), lambda a, n: a + n)

            def span(r: Column, at: Column) -> Column:
                start = at + r["gap"]
                return F.struct(start.alias("start"), F.lit(order).alias("kind"), (start + r["length"]).alias("end"), r["value"].alias("value"))

            return F.filter(F.zip_with(rows, starts, span), lambda s: s["value"].isNotNull())

        return _let(rows, spans)

    return _let(F.regexp_extract_all(text, pattern, F.lit(0)), lambda found: F.when(F.size(found) > 0, placed(found)).otherwise(none))


def apart(more: Column, base: Column) -> Column:
    """The spans of ``more`` that overlap none of ``base``; those of ``more`` do not overlap one another.

    A base span overlaps if it starts before the other's end and ends behind its start. So the starts of the
    one and the ends of the other are sorted together, and the furthest end of the base spans before each is kept.
    """
    zero, no_span = F.lit(0).cast("bigint"), F.lit(None).cast("struct<start:bigint,kind:int,end:bigint,value:bigint>")
    # At one place an end sorts before a start, as spans that only touch do not overlap.
    ends = F.transform(more, lambda m: F.struct(m["end"].alias("at"), F.lit(0).alias("order"), zero.alias("end"), m.alias("span")))
    starts = F.transform(base, lambda b: F.struct(b["start"].alias("at"), F.lit(1).alias("order"), b["end"].alias("end"), no_span.alias("span")))

    def kept(events: Column) -> Column:
        furthest = running(F.transform(events, lambda e: e["end"]), zero, lambda a, end: F.greatest(a, end))
        free = F.zip_with(events, furthest, lambda e, end: F.when(end <= e["span"]["start"], e["span"]))
        return F.filter(free, lambda m: m.isNotNull())

    joined = F.sort_array(F.concat(ends, starts))
    return F.when((F.size(more) == 0) | (F.size(base) == 0), more).otherwise(_let(joined, kept))


def candidates(df: DataFrame, id_col: str, text: str, owner: str, repository: Column) -> DataFrame:
    """``(id, row, owner, repository, base, more)`` of every row; ``row`` is a hash of the text."""
    texts = df.select(
        F.col(id_col).alias("id"),
        F.xxhash64(text).alias("row"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
        F.coalesce(repository, F.lit("")).alias("repository"),
        F.coalesce(text, F.lit("")).alias("text"),
    )
    text_col = F.col("text")
    base = F.sort_array(F.concat(*(spans_of(text_col, kind, k) for k, kind in enumerate(KINDS))))
    found = evaluate_once(texts, "base", base)
    found = evaluate_once(found, "more", spans_of(text_col, OWNED, len(KINDS)))
    # A token inside a pattern match is that match's.
    return found.select("id", "row", "owner", "repository", "base", apart(F.col("more"), F.col("base")).alias("more"))


def ownership(found: DataFrame) -> DataFrame:
    """``(value, owners, repositories, n)``: the distinct ones that hold each candidate value, and how often it occurs."""
    held = found.select("owner", "repository", F.explode(F.concat("base", "more")).alias("span"))
    held = held.groupBy(F.col("span.value").alias("value"), "owner", "repository").agg(F.count("*").alias("n"))
    counts = held.groupBy("value", "owner").agg(F.count("*").alias("repositories"), F.sum("n").alias("n"))
    return counts.groupBy("value").agg(
        F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.sum("n").alias("n")
    )


def secret_scan(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", owner: str = "source", repository: Column | str | None = None
) -> DataFrame:
    """``(id_col, base, spans)``, one row per document: arrays of ``struct<start, kind, end, value, owners, repositories, standing>``.

    ``base`` has the pattern matches, ``spans`` also the owned tokens, both by start, then kind (a place in
    ``KINDS``, or its length for an owned token). ``standing`` is ``example``, ``live`` or ``unclear``.
    Null texts are empty; null owners and repositories are one of their own; without ``repository`` each
    owner is one. Rows that agree in id and text have the same result each. Memory: the matches
    of one text; a value that many rows hold is reduced to its owners before it is counted.
    """
    ensure_checkpoint_dir(df.sparkSession)
    where = F.col(owner) if repository is None else (F.col(repository) if isinstance(repository, str) else repository)
    found = stored(candidates(df, id_col, text, owner, where.cast("string")), "candidates")
    spans = found.select("id", "row", F.explode(F.concat("base", "more")).alias("span")).distinct()
    spans = spans.withColumn("value", F.col("span.value"))
    few = (F.col("owners") <= LIVE_OWNERS) & (F.col("repositories") <= LIVE_REPOSITORIES)
    standing = F.when(F.col("owners") >= EXAMPLE_OWNERS, "example").when(few, "live").otherwise("unclear")
    owned = ownership(found).checkpoint()
    known = join_hot(spans, owned.drop("n"), ["value"], owned, ["id", "row", "span"]).withColumn("standing", standing)
    known = known.filter((F.col("span.kind") < len(KINDS)) | (F.col("standing") == "live"))
    full = F.struct("span.start", "span.kind", "span.end", "value", "owners", "repositories", "standing")
    lists = known.groupBy("id", "row").agg(F.array_sort(F.collect_list(full)).alias("spans"))
    none = F.array().cast(lists.schema["spans"].dataType)
    out = join_on(found.select("id", "row"), lists, ["id", "row"], "left").select(
        F.col("id").alias(id_col), F.coalesce("spans", none).alias("spans")
    )
    return out.withColumn("base", F.filter("spans", lambda s: s["kind"] < len(KINDS)))


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*(F.lit(k.name) for k in (*KINDS, OWNED)))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
