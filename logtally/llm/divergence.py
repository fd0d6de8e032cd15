"""How far the sources of a language differ in their words, by in-mapper stripes.

Every partition folds whole documents into stripes: a term's document frequency and its count in each
source. Stripes that no longer fit are spilled as rows and begun anew; the shuffle brings those of a term
together, and they are merged by key. Each merged stripe then gives its share of every pair's
divergence and its own: stripes are dealt out in shards, each with the totals of its language's sources, and a
shard adds its shares up before anything leaves it. All arithmetic is in integers.

With ``n`` occurrences of kept terms in a group and ``v`` kept terms, a term that occurs ``c`` times has the rate
``1 + floor(RATE * (c + 1) / (n + v))``; rates ``p`` and ``q`` differ by ``floor((p - q)^2 / q)``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logtally.llm.common import join_hot, map_batches, slices, stored
from logtally.session import ensure_checkpoint_dir

#: Documents of a language that a term needs to be kept; ranks of a group's terms that are returned.
LEAST_DOCUMENTS, TOP_TERMS = 3, 200
#: What a rate of 1 is written as: this many, as a power of 1000.
THOUSANDS = 3
#: Stripes, and bytes of their terms, that a task holds before it spills them.
HELD_STRIPES, HELD_BYTES = 200_000, 32 << 20
#: Entries (a term's count in a source) of a shard, cells of a matrix, and pairs of sources that a task adds up.
SHARD_ENTRIES, BLOCK_CELLS, TASK_PAIRS = 400_000, 1 << 20, 1 << 20
_PIECE = 1 << 20
_STRIPES = "lang string, term string, df bigint, sources array<string>, counts array<bigint>"
_FOUND = "lang string, source string, part string, item string, value bigint"
# ASCII letters, lower-cased, and all bytes of other characters stay; the rest parts terms.
_LETTERS = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalpha() else 0x20 for b in range(256))


def term_counts(text: bytes | None) -> Counter[bytes]:
    """The terms of a whole text, as UTF-8, and how often each occurs."""
    data = (text or b"").translate(_LETTERS)
    counts: Counter[bytes] = Counter()
    start = 0
    while start < len(data):
        end = data.find(b" ", start + _PIECE)
        end = len(data) if end < 0 else end
        counts.update(data[start:end].split())
        start = end
    return counts


class Stripes:
    """The stripes of some documents: by language and term, document frequency and counts by source."""

    def __init__(self) -> None:
        self.by_lang: dict[str, dict[bytes, dict[str | None, int]]] = {}
        self.number = self.bytes = 0

    def fold(self, lang: str, source: str, text: bytes | None) -> None:
        own = self.by_lang.setdefault(lang, {})
        for term, count in term_counts(text).items():
            stripe = own.get(term)
            if stripe is None:
                own[term] = {None: 1, source: count}  # the frequency has no source
                self.number += 1
                self.bytes += len(term)
            else:
                stripe[None] += 1
                stripe[source] = stripe.get(source, 0) + count

    def full(self) -> bool:
        return self.number >= HELD_STRIPES or self.bytes >= HELD_BYTES

    def rows(self, at_once: int = 20_000) -> Iterator[pa.RecordBatch]:
        """All stripes as rows; afterwards there are none."""
        by_lang, self.by_lang, self.number, self.bytes = self.by_lang, {}, 0, 0
        for lang, own in by_lang.items():
            terms = list(own)
            for at in range(0, len(terms), at_once):
                part = terms[at : at + at_once]
                stripes = [own[t] for t in part]
                df = [s.pop(None) for s in stripes]
                columns = [[lang] * len(part), [t.decode() for t in part], df, [list(s) for s in stripes], [list(s.values()) for s in stripes]]
                kinds = [pa.string(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["lang", "term", "df", "sources", "counts"])


def stripes(df: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``(lang, term, df, sources, counts)``: the stripes of every partition, several of a term if it has spilled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Stripes()
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text").cast(pa.binary()).to_pylist()
                for row in zip(part.column("lang").to_pylist(), part.column("source").to_pylist(), texts, strict=True):
                    held.fold(*row)
                    if held.full():
                        yield from held.rows()
        yield from held.rows()

    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))]
    return map_batches(df.select(*named), run, _STRIPES)


def merged_stripes(parts: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """One stripe per language and term of at least ``least`` documents; one shuffle, by language and term."""
    dealt = parts.repartition("lang", "term")
    entries = dealt.select("lang", "term", "df", F.posexplode(F.arrays_zip("sources", "counts")).alias("pos", "entry"))
    once = F.when(F.col("pos") == 0, F.col("df")).otherwise(0)  # a stripe's frequency counts once
    sums = entries.groupBy("lang", "term", F.col("entry.sources").alias("source"))
    sums = sums.agg(F.sum("entry.counts").alias("count"), F.sum(once).alias("df"))
    whole = sums.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.collect_list(F.struct("source", "count")).alias("entries"))
    return whole.filter(F.col("df") >= least).select("lang", "term", "df", "entries.source", "entries.count")


def rates(counts: np.ndarray, totals: np.ndarray | int) -> np.ndarray:
    """``1 + floor(1000^THOUSANDS * (counts + 1) / totals)``, by long division, so that nothing overflows."""
    rest, found = counts + 1, np.zeros(np.broadcast_shapes(counts.shape, np.shape(totals)), np.int64)
    for _ in range(THOUSANDS):
        rest = rest * 1000
        found = found * 1000 + rest // totals
        rest = rest % totals
    return found + 1


def differences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def shard_divergences(terms: pa.Table, groups: pa.Table, top: int = TOP_TERMS) -> pa.Table:
    """The pairs' shares of a shard of merged stripes, and the terms of each group that may rank.

    ``groups`` has ``source, total, kept, mine`` for each source of the language: its occurrences of kept
    terms, the number of those, and whether its rows are asked for here.
    """
    groups = groups.sort_by("source")
    names = groups.column("source").combine_chunks()
    totals, kept = groups.column("total").to_numpy(), groups.column("kept")[0].as_py()
    mine = np.flatnonzero(groups.column("mine").to_numpy(zero_copy_only=False))
    binary = terms.column("term").cast(pa.binary())
    terms = terms.take(pc.sort_indices(binary))  # a term's place is its rank by UTF-8
    size = len(terms)
    lengths = pc.list_value_length(terms.column("source")).to_numpy() if size else np.zeros(0, np.int64)
    at = np.repeat(np.arange(size), lengths)
    who = pc.index_in(pc.list_flatten(terms.column("source")), value_set=names).to_numpy() if size else at
    count = pc.list_flatten(terms.column("count")).to_numpy() if size else at
    pairs = np.zeros((len(mine), len(names)), np.int64)
    step = max(1, BLOCK_CELLS // max(1, len(names)))
    bounds = np.searchsorted(at, np.arange(0, size + step, step))
    for k in range(len(bounds) - 1):
        low, high = bounds[k], bounds[k + 1]
        block = np.zeros((min(step, size - k * step), len(names)), np.int64)
        block[at[low:high] - k * step, who[low:high]] = count[low:high]
        p = rates(block, totals[None, :] + kept)
        for row, source in enumerate(mine):
            pairs[row] += differences(p[:, source : source + 1], p).sum(axis=0)
    own, other = np.divmod(np.arange(pairs.size), len(names))
    apart = mine[own] != other
    out = [(mine[own[apart]], "pair", names.take(pa.array(other[apart])), pairs.ravel()[apart])]
    if size:
        whole = np.bincount(at, count, size).astype(np.int64) if count.sum() < 1 << 53 else np.add.reduceat(count, np.r_[0, np.cumsum(lengths)[:-1]])
        p, q = rates(count, totals[who] + kept), rates(whole, int(totals.sum()) + kept)[at]
        hit = np.flatnonzero((count > 0) & (p > q) & np.isin(who, mine))
        f = differences(p[hit], q[hit])
        order = np.lexsort((at[hit], -f, who[hit]))
        sort = who[hit][order]
        rank = np.arange(len(sort)) - np.searchsorted(sort, sort)
        best = order[rank < top]
        out.append((who[hit][best], "term", terms.column("term").take(pa.array(at[hit][best])).combine_chunks(), f[best]))
    lang = groups.column("lang")[0].as_py()
    tables = [
        pa.table(
            {
                "lang": pa.array([lang] * len(value), pa.string()),
                "source": names.take(pa.array(who_)),
                "part": pa.array([part] * len(value), pa.string()),
                "item": item,
                "value": pa.array(value, pa.int64()),
            }
        )
        for who_, part, item, value in out
    ]
    return pa.concat_tables(tables)


def source_divergences(
    df: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS
) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` for every pair of language and source that occurs.

    Part ``pair`` has each other source of the language with the sum of differences over all kept terms (0 if none is
    kept), ``q`` being the other's rate. Part ``term`` has the ``top`` terms of the group whose rate is above the
    language's, by their difference from it. Ranks go by value, then item in UTF-8 order. Null texts, languages
    and sources count as empty ones; repeated rows count as often as they occur; other columns are
    ignored, whatever their names. An empty table gives an empty result, a language of one source no pairs.
    Counts may reach 9e15. Pairs grow with the square of a language's sources, as the result does.
    """
    ensure_checkpoint_dir(df.sparkSession)
    terms = stored(merged_stripes(stripes(df, lang, source, text), least), "merged-stripes")
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))]
    entries = terms.select("lang", F.explode(F.arrays_zip("source", "count")).alias("entry"))
    sums = entries.groupBy("lang", F.col("entry.source").alias("source")).agg(F.sum("entry.count").alias("total"), F.count("*").alias("entries"))
    groups = df.select(*named).distinct().join(sums, ["lang", "source"], "left").fillna(0, ["total", "entries"]).checkpoint()
    langs = groups.groupBy("lang").agg(F.sum("entries").alias("entries"), F.count("*").alias("sources"))
    langs = langs.join(terms.groupBy("lang").agg(F.count("*").alias("kept")), "lang", "left").fillna(0, ["kept"])
    # The shards of a language's terms, and the parts of its sources if they are very many.
    shards = F.greatest(F.ceil(F.col("entries") / SHARD_ENTRIES), F.lit(1)).cast("int")
    parts = F.greatest(F.ceil(F.col("sources") * F.col("sources") / TASK_PAIRS), F.lit(1)).cast("int")
    langs = langs.select("lang", "kept", shards.alias("shards"), parts.alias("parts")).checkpoint()
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    shard = F.pmod(F.xxhash64("term"), F.col("shards")).cast("int")
    dealt = join_hot(terms, langs, ["lang"], langs.withColumn("n", F.col("kept")), ["term"])
    dealt = dealt.withColumn("shard", shard).withColumn("part", every("parts")).select("lang", "shard", "part", "term", "source", "count")
    of = groups.join(langs, "lang").withColumn("shard", every("shards")).withColumn("part", every("parts"))
    mine = F.pmod(F.xxhash64("source"), F.col("parts")) == F.col("part")
    of = of.select("lang", "shard", "part", "source", "total", "kept", mine.alias("mine"))

    def found(left: pa.Table, right: pa.Table) -> pa.Table:
        return shard_divergences(left, right, top)

    keys = ["lang", "shard", "part"]
    shares = dealt.groupBy(*keys).cogroup(of.groupBy(*keys)).applyInArrow(found, _FOUND)
    summed = shares.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    ranked = summed.withColumn("rank", F.row_number().over(order))
    return ranked.filter((F.col("part") == "pair") | (F.col("rank") <= top))
