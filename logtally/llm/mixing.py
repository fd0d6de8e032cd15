"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

The documents of a source, shuffled by a hash, are a stream of words that is cut into blocks of equal
size. A schedule of slots takes the van der Corput points (base 2) through the sources' cumulative shares,
so every stretch of it has nearly the target weights. The k-th slot of a source takes its k-th block,
going round the stream until the source's target is reached; the last slot takes part of a block.
Slots beyond a target are left out; the few that a source lacks (the sequence's discrepancy, which
grows with the logarithm of the schedule) follow at the end. So each source takes its rounded target.

Nothing is ranked over a whole source: slots and documents are counted in chunks first, then within.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logtally.llm.common import WORD, join_hot, join_on, stored
from logtally.session import ensure_checkpoint_dir

#: Weights of the sources in code point order, repeating; the share of all words that the mix has.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
BLOCK_WORDS = 4096
#: Documents or slots that are ranked together in one window.
CHUNK = 16_384
_SEED = "mixing order"


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _ranked(df: DataFrame, column: str) -> DataFrame:
    """Add ``rank``, from 0, by a column of distinct values, null last, without one task for all rows."""
    sort = df.orderBy(F.col(column).asc_nulls_last()).withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    part, within = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = sort.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    with_part = sort.withColumn("_part", part)
    return with_part.join(starts, "_part").withColumn("rank", F.col("_start") + within).drop("_at", "_part", "_start")


def targets(sizes: DataFrame, share: float = SHARE, most: float = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``(source, n, source_size, target)`` from ``(source, size)`` rows, ``n`` being their number.

    ``share`` of all words is split by weight; a target stops at ``most`` times its source's size and the
    excess is split among the others, by weight, until none is above. Only sums reach the driver.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    which = F.col("rank") % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (which + 1).cast("int"))
    table = _ranked(per_source, "source").withColumn("weight", weight.cast("double")).drop("rank").checkpoint()
    cap = F.col("source_size") * F.lit(float(most))
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, rest = 0.0, share * total
    while True:
        full = F.col("weight") * F.lit(level) > cap
        open_weight, capped = table.agg(F.sum(F.when(~full, F.col("weight"))), F.sum(F.when(full, cap))).first()
        if not open_weight:
            break
        new = (rest - (capped or 0.0)) / open_weight
        if new <= level * (1 + 1e-12):
            break
        level = new
    return table.select("source", "n", "source_size", F.least(F.col("weight") * F.lit(level), cap).alias("target"))


def _streams(sized: DataFrame, documents: int) -> DataFrame:
    """Add ``start``: where a document with words begins in the shuffled stream of its source."""
    chunks = max(1, math.ceil(documents / CHUNK))
    # The text's digest takes part, as very many rows may have no id.
    mixed = F.xxhash64("doc_id", "digest", F.lit(_SEED))
    rows = sized.filter("size > 0").withColumn("_order", mixed).withColumn("_chunk", F.pmod(mixed, F.lit(chunks)))
    sums = rows.groupBy("source", "_chunk").agg(F.sum("size").alias("_words"))
    before = Window.partitionBy("source").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("source", "_chunk", F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_base"))
    joined = join_on(rows, starts, ["source", "_chunk"])
    # Rows that agree in all of these are alike, so their order does not matter.
    within = Window.partitionBy("source", "_chunk").orderBy("_order", "doc_id", "size", "digest")
    inner = F.coalesce(F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return joined.withColumn("start", F.col("_base") + inner).drop("_order", "_chunk", "_base")


def schedule(goals: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """``(slot, source, block, words)``: which block of which source each slot takes, and how much of it.

    ``goals`` has ``(source, source_size, target)``. Slots are in the order of the mix.
    """
    size = F.col("source_size")
    take = F.floor(F.col("target") + 0.5).cast("long")
    rest = (F.col("take") % size).cast("long")
    per_round = F.ceil(size / block).cast("long")
    needs = (
        goals.filter("source_size > 0")
        .withColumn("take", take)
        .withColumn("rounds", F.floor(F.col("take") / size).cast("long"))
        .withColumn("rest", rest)
        .withColumn("blocks", per_round)
        .withColumn("slots", F.col("rounds") * F.col("blocks") + F.ceil(F.col("rest") / block).cast("long"))
        .filter("slots > 0")
    )
    # The sources' intervals in cumulative slots, summed in chunks of ranks.
    ranked = _ranked(needs, "source").withColumn("_group", F.floor(F.col("rank") / CHUNK)).checkpoint()
    groups = ranked.groupBy("_group").agg(F.sum("slots").alias("_slots"))
    over = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)  # a row per CHUNK sources
    bases = groups.select("_group", F.coalesce(F.sum("_slots").over(over), F.lit(0)).alias("_base"))
    inner = Window.partitionBy("_group").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    shares = ranked.join(bases, "_group").withColumn("low", F.col("_base") + F.coalesce(F.sum("slots").over(inner), F.lit(0)))
    shares = shares.withColumn("high", F.col("low") + F.col("slots")).drop("_group", "_base", "rank").checkpoint()
    total = shares.agg(F.max("high")).first()[0] or 0
    bits = max(1, math.ceil(math.log2(total))) if total > 1 else 1
    # Points and intervals meet in cells of about 32 slots each.
    cell = 32
    point = F.conv(F.reverse(F.lpad(F.bin("slot"), bits, "0")), 2, 10).cast("double") / float(1 << bits)
    points = goals.sparkSession.range(total).withColumnRenamed("id", "slot").withColumn("at", point * float(total))
    points = points.withColumn("cell", F.floor(F.col("at") / cell).cast("long"))
    spans = shares.withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("low") / cell).cast("long"), F.floor((F.col("high") - 1) / cell).cast("long")))
    )
    drawn = points.join(spans, "cell").filter("at >= low AND at < high").drop("cell", "at", "low", "high")
    # The rank of each slot within its source: chunks of the schedule first, then inside a chunk.
    drawn = drawn.withColumn("_chunk", F.floor(F.col("slot") / CHUNK).cast("long"))
    counts = drawn.groupBy("source", "_chunk").agg(F.count("*").alias("_slots"))
    earlier = Window.partitionBy("source").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("source", "_chunk", F.coalesce(F.sum("_slots").over(earlier), F.lit(0)).alias("_base"))
    drawn = join_on(drawn, bases, ["source", "_chunk"])
    inside = F.row_number().over(Window.partitionBy("source", "_chunk").orderBy("slot")) - 1
    columns = ["slot", "source", "source_size", "rounds", "rest", "blocks", "slots"]
    drawn = drawn.withColumn("turn", F.col("_base") + inside).select(*columns, "turn")
    got = drawn.groupBy("source").agg(F.count("*").alias("got"))
    lacking = join_on(shares, got, ["source"], "left").withColumn("got", F.coalesce("got", F.lit(0)))
    closing = lacking.filter("got < slots").withColumn("turn", F.explode(F.sequence("got", F.col("slots") - 1)))
    closing = closing.withColumn("slot", F.lit(total) + F.col("turn"))
    every = drawn.filter("turn < slots").select(*columns, "turn").unionByName(closing.select(*columns, "turn"))
    which = (F.col("turn") % F.col("blocks")).cast("long")
    left = F.col("source_size") - F.col("block") * block
    partial = F.col("turn") >= F.col("rounds") * F.col("blocks")
    words = F.when(partial, F.least(F.lit(block), left, F.col("rest") - F.col("block") * block)).otherwise(F.least(F.lit(block), left))
    return every.withColumn("block", which).select("slot", "source", "block", words.cast("long").alias("words"))


def mixture(df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK_WORDS) -> DataFrame:
    """``(doc_id, digest, size, source, source_size, target, taken)``, one row per document.

    ``taken`` counts the words that the mix takes of it, repeats included, at most twice its size.
    ``digest`` is a hash of the text. Null and empty texts have size 0 and are not taken. A null
    source is a source of its own, last in order. Rows that agree in id, source and text are
    kept apart by their place in the stream. Reruns agree: order is by a hash of id and text.
    """
    ensure_checkpoint_dir(df.sparkSession)
    sized = df.select(
        F.col(id_col).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size"), F.xxhash64(text).alias("digest")
    )
    sized = stored(sized, "sizes")
    goals = targets(sized).checkpoint()
    slots = schedule(goals, block)
    blocks = slots.groupBy("source", "block").agg(F.collect_list("words").alias("cuts"))  # three rounds at most
    placed = stored(_streams(sized, sized.count()), "streams")
    end = F.col("start") + F.col("size")
    pieces = placed.withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("start") / block).cast("long"), F.floor((end - 1) / block).cast("long")))
    )
    met = join_on(pieces, blocks, ["source", "block"])
    low = F.greatest(F.col("start") - F.col("block") * block, F.lit(0))
    high = F.least(end - F.col("block") * block, F.lit(block))
    part = F.aggregate("cuts", F.lit(0).cast("long"), lambda s, cut: s + F.greatest(F.least(high, cut) - low, F.lit(0)))
    key = ["doc_id", "source", "size", "digest", "start"]
    taken = met.groupBy(*key).agg(F.sum(part).alias("taken"))
    kept = join_on(placed, taken.select("source", "start", "taken"), ["source", "start"], "left")
    kept = kept.select("doc_id", "source", "size", "digest", F.coalesce("taken", F.lit(0)).alias("taken"))
    none = sized.filter("size = 0").select("doc_id", "source", "size", "digest", F.lit(0).cast("long").alias("taken"))
    every = kept.unionByName(none)
    columns = ["doc_id", "digest", "size", "source", "source_size", "target", "taken"]
    return join_hot(every, goals.drop("n"), ["source"], goals, ["doc_id", "digest"]).select(*columns)


def mix(df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mixed documents, with the columns of ``df``: a row for each time a document is taken.

    Texts stay whole: the one document of a source in which its last round ends is taken once more if at least half of
    it was due, and else not, so a source is off its target by half a document at most. Documents
    that are not taken are left out. Of rows that agree in id, source and text the first stands for all.
    """
    plan = mixture(df, id_col, text, source).groupBy("doc_id", "source", "digest", F.col("size").alias("_mix_size"))
    plan = plan.agg(F.sum("taken").alias("_mix_taken"), F.count("*").alias("_mix_rows"))
    times = F.floor((2 * F.col("_mix_taken") + F.col("_mix_size")) / (2 * F.col("_mix_size"))).cast("int")
    plan = plan.filter("_mix_taken > 0").withColumn("_mix_times", times).filter("_mix_times > 0").drop("_mix_size", "_mix_taken")
    plan = stored(plan.withColumnsRenamed({"doc_id": id_col, "source": source, "digest": "_mix_digest"}), "mix-plan")
    key = [id_col, source, "_mix_digest"]
    keyed = df.withColumn("_mix_digest", F.xxhash64(text))
    once = join_on(keyed, plan.filter("_mix_rows = 1"), key)
    more = join_on(keyed, plan.filter("_mix_rows > 1"), key).dropDuplicates(key)
    every = once.unionByName(more).withColumn("_mix_turn", F.explode(F.sequence(F.lit(1), "_mix_times")))
    return every.select(*df.columns)
