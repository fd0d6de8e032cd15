"""Substring deduplication by content-defined chunks.

A gear rolling hash over the bytes of a text cuts it where the hash of the last ``WINDOW`` bytes falls
below a bound, so cuts depend on nearby content only: an insertion shifts no cut but those beside it.
A chunk whose digest occurred earlier in the corpus is a repeat, and a run of consecutive repeats
of enough words is a repeated passage. The first occurrence of each chunk stays. A passage loses the parts of
chunks at its ends, so a run of fewer words is a seed: it is extended byte by byte along the first occurrences
of its outer chunks, and is a repeated passage if the bytes that agree have enough words.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtally.llm.common import join_hot, join_on, map_batches, slices, stored
from logtally.session import ensure_checkpoint_dir

#: Bytes that decide on a cut (a power of two), mean distance of cuts beyond the least, least and most bytes.
WINDOW, MEAN, LEAST, MOST = 16, 40, 16, 512
#: Words of a run of repeated chunks that is reported. A passage loses up to about two chunks at either end.
MIN_WORDS = 25
#: Words of a shorter run with the bytes beside it that agree, from which on it is reported.
EXACT_WORDS = 50
#: Bytes and words on either side of a run that are compared at most. A passage longer than that has a longer run.
_REACH, _REACH_WORDS = 4096, EXACT_WORDS
_SLICE = 1_000_000


def _gear() -> np.ndarray:
    """A random 32-bit number per byte value, by the splitmix64 rule."""
    state = (np.arange(1, 257, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    state = (state ^ (state >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    state = (state ^ (state >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (state >> np.uint64(32)).astype(np.uint32)


GEAR = _gear()


def rolling(data: np.ndarray) -> np.ndarray:
    """The gear hash of the ``WINDOW`` bytes that end at each place: each step doubles the bytes covered."""
    value = GEAR[data]
    span = 1
    while span < WINDOW:
        longer = value.copy()
        longer[span:] += value[:-span] << np.uint32(span) if span < len(value) else 0
        value, span = longer, span * 2
    return value


def cuts(data: np.ndarray) -> list[int]:
    """Where chunks end, the end of the data included."""
    n = len(data)
    if not n:
        return []
    low = rolling(data) < np.uint32((1 << 32) // MEAN)
    ends, last = [], 0
    for place in (np.flatnonzero(low) + 1).tolist():
        while place - last > MOST:
            last += MOST
            ends.append(last)
        if place - last >= LEAST and place < n:
            ends.append(place)
            last = place
    while n - last > MOST:
        last += MOST
        ends.append(last)
    ends.append(n)
    return ends


def chunk_table(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """``(id, row, seq, start, end, words, before, after, digest)``: the chunks of every text; places are in bytes of UTF-8.

    ``row`` is a hash of the text, ``words`` how many words begin in the chunk, ``before`` and ``after`` are
    hashes of the ``WINDOW`` bytes beside it, null where the text has fewer.
    """
    df = df.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("row"), F.col(text).alias("text"))
    kind = df.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                owner, seq, start, end, words, digest = [], [], [], [], [], []
                beside: list[list[int | None]] = [[], []]
                for k, value in enumerate(part.column("text").to_pylist()):
                    raw = (value or "").encode()
                    data = np.frombuffer(raw, np.uint8)
                    ends = cuts(data)
                    starts = [0, *ends[:-1]] if ends else []
                    blank = (data == 32) | ((data >= 9) & (data <= 13))
                    begins = ~blank & np.r_[True, blank[:-1]] if len(data) else blank
                    owner += [k] * len(ends)
                    seq += range(len(ends))
                    start += starts
                    end += ends
                    if ends:
                        words.append(np.add.reduceat(begins, starts, dtype=np.int32))
                        hashes = rolling(data).view(np.int32)
                        for found, last in zip(beside, (np.array(starts) - 1, np.array(ends) + WINDOW - 1), strict=True):
                            there = (last >= WINDOW - 1) & (last < len(data))
                            values = hashes[np.where(there, last, 0)].tolist()
                            found += [v if ok else None for v, ok in zip(values, there.tolist(), strict=True)]
                    digest += [xxhash.xxh3_64_intdigest(raw[a:b], b - a) for a, b in zip(starts, ends, strict=True)]
                at = pa.array(owner, pa.int64())
                columns = [part.column("id").take(at), part.column("row").take(at)]
                columns += [pa.array(v, pa.int32()) for v in (seq, start, end)]
                columns.append(pa.array(np.concatenate(words) if words else [], pa.int32()))
                columns += [pa.array(v, pa.int32()) for v in beside]
                columns.append(pa.array(np.array(digest, np.uint64).view(np.int64)))
                yield pa.RecordBatch.from_arrays(columns, ["id", "row", "seq", "start", "end", "words", "before", "after", "digest"])

    schema = f"id {kind}, row bigint, seq int, start int, end int, words int, before int, after int, digest bigint"
    return map_batches(df, run, schema)


_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _beside(raw: bytes, place: int, after: bool) -> bytes:
    """The bytes before a place, or those after it and the one before them, as far as they are compared."""
    found = raw[place - 1 : place + _REACH] if after else raw[max(0, place - _REACH) : place]
    begins = [m.start() for m in _WORD.finditer(found)]
    if after:
        return found[: begins[_REACH_WORDS + 1]] if len(begins) > _REACH_WORDS + 1 else found
    return found[max(0, begins[-_REACH_WORDS - 1]) :] if len(begins) > _REACH_WORDS + 1 else found


def _agreeing(one: bytes, other: bytes) -> int:
    """How many bytes at the beginning of both agree."""
    n = min(len(one), len(other))
    differ = np.flatnonzero(np.frombuffer(one, np.uint8, n) != np.frombuffer(other, np.uint8, n)) if n else []
    return int(differ[0]) if len(differ) else n


def _begun(data: bytes, before: bytes) -> int:
    """How many words begin in ``data``, which ``before`` precedes (empty where a text begins)."""
    return sum(m.start() > 0 or not before or _WORD.fullmatch(before[-1:]) is None for m in _WORD.finditer(data))


def extended(runs: DataFrame, texts: DataFrame, exact_words: int = EXACT_WORDS) -> DataFrame:
    """``(id, row, start, end, n_words, first_id)`` of the runs that have ``exact_words`` words with what agrees beside them.

    ``head`` and ``tail`` of a run are the first occurrences of its outer chunks; the bytes before it are
    compared with those before ``head``, the bytes after it with those after ``tail``.
    """
    run, target = ["id", "row", "start", "end"], ["text_id", "text_row", "place", "after"]
    told, wanted = ["n_words", "first_id"], ["place", "after", "n", "which", "start", "end", "n_words", "first_id"]
    ask = lambda which, doc, place, after: F.struct(
        F.lit(which).alias("which"),
        F.col(f"{doc}id").alias("text_id"),
        F.col(f"{doc}row").alias("text_row"),
        F.col(f"{doc}{place}").alias("place"),
        F.lit(after).alias("after"),
    )
    firsts = F.array(ask(1, "head.", "start", False), ask(3, "tail.", "end", True))
    asked = stored(runs.select(*run, *told, F.inline(firsts)), "asked-places")
    counts = asked.groupBy(*target).agg(F.count("*").alias("n")).checkpoint()
    # What is beside a run itself is read with its text; only the places of first occurrences are joined to those who ask.
    beside = F.array(ask(0, "", "start", False), ask(2, "", "end", True))
    own = runs.select("start", "end", *told, F.inline(beside)).unionByName(counts, allowMissingColumns=True)
    places = own.groupBy("text_id", "text_row").agg(F.collect_list(F.struct(*wanted)).alias("wanted"))
    met = join_on(texts.select(F.col("id").alias("text_id"), F.col("row").alias("text_row"), "text"), places, ["text_id", "text_row"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                raw, asks = one.column("text")[0].as_py().encode(), one.column("wanted").flatten()
                at = pa.array(np.zeros(len(asks), np.int64))
                columns = [one.column("text_id").take(at), one.column("text_row").take(at), *asks.flatten()]
                sides = zip(asks.field("place").to_pylist(), asks.field("after").to_pylist(), strict=True)
                columns.append(pa.array([_beside(raw, place, after) for place, after in sides], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, ["text_id", "text_row", *wanted, "bytes"])

    kind = texts.schema["id"].dataType.simpleString()
    numbers = f"n bigint, which int, start int, end int, n_words bigint, first_id {kind}"
    found = map_batches(met, read, f"text_id {kind}, text_row bigint, place int, after boolean, {numbers}, bytes binary")
    found = stored(found.dropDuplicates([*target, "which", "start", "end"]), "beside-runs")
    sides = join_hot(asked, found.filter("which IS NULL").select(*target, "n", "bytes"), target, counts, [*run, "which"], counted=True)
    own = found.filter("which IS NOT NULL").withColumnsRenamed({"text_id": "id", "text_row": "row"})
    columns = [*run, *told, "which", "bytes"]
    sides = sides.select(*columns).unionByName(own.select(*columns)).groupBy(*run, *told)
    sides = sides.agg(*(F.max(F.when(F.col("which") == k, F.col("bytes"))).alias(f"side{k}") for k in range(4)))

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, end, words = ([*batch.column(n).to_pylist()] for n in ("start", "end", "n_words"))
            four = (batch.column(f"side{k}").to_pylist() for k in range(4))
            for k, (before, head, after, tail) in enumerate(zip(*four, strict=True)):
                low, high = _agreeing(before[::-1], head[::-1]), _agreeing(after[1:], tail[1:])
                cut = len(before) - low
                words[k] += _begun(before[cut:], before[:cut] or (b"" if start[k] == low else b"a"))
                words[k] += _begun(after[1 : 1 + high], after[:1])
                start[k], end[k] = start[k] - low, end[k] + high
            own = {"start": pa.array(start, pa.int32()), "end": pa.array(end, pa.int32()), "n_words": pa.array(words, pa.int64())}
            names = [*run, "n_words", "first_id"]
            yield pa.RecordBatch.from_arrays([own[n] if n in own else batch.column(n) for n in names], names)

    schema = f"id {kind}, row bigint, start int, end int, n_words bigint, first_id {kind}"
    longer = map_batches(sides, extend, schema).filter(F.col("n_words") >= exact_words)
    # Several runs of one passage extend to the same bytes.
    return longer.groupBy(*run).agg(F.max("n_words").alias("n_words"), F.min("first_id").alias("first_id"))


def repeated_passages(df: DataFrame, id_col: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``(id_col, row, start, end, n_words, first_id)``: passages that stand earlier in the corpus.

    Order is by id (null first), then text hash, then place; the earliest occurrence of a chunk is not a
    repeat. ``first_id`` is the smallest id that has the first occurrence of one of the passage's chunks.
    ``start`` and ``end`` are bytes of UTF-8. Null and empty texts have no chunks. Rows that agree in
    id and text are one document. A run of fewer than ``min_words`` words is reported, with the bytes beside
    it that agree, if that makes ``EXACT_WORDS`` words (see :func:`extended`); such passages may overlap.
    """
    ensure_checkpoint_dir(df.sparkSession)
    chunks = stored(chunk_table(df, id_col, text), "chunks")
    more = chunks.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").checkpoint()
    place = ["id", "row", "seq"]
    shared = join_hot(chunks, more.select("digest"), ["digest"], more, place).withColumn("at", F.struct(*place, "start", "end", "before", "after"))
    shared = stored(shared, "shared-chunks")
    firsts = shared.groupBy("digest").agg(F.min("at").alias("first"))
    repeats = join_hot(shared, firsts, ["digest"], more, place).filter(~F.col("at").eqNullSafe(F.col("first")))
    repeats = repeats.select(*place, "start", "end", "words", "before", "after", F.col("first.id").alias("first_id"), "first")
    repeats = repeats.dropDuplicates(place)
    # Consecutive chunks share the difference of sequence number and rank within their document.
    rank = F.row_number().over(Window.partitionBy("id", "row").orderBy("seq"))
    runs = repeats.withColumn("run", F.col("seq") - rank).groupBy("id", "row", "run")
    found = runs.agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").alias("n_words"), F.min("first_id").alias("first_id"),
        F.min(F.struct("seq", "first", "before")).alias("head"), F.max(F.struct("seq", "first", "after")).alias("tail"),
    )
    # On one side at least, a seed must gain half of the words it lacks, and n words that are beside it have 2n - 1 bytes.
    lacks = EXACT_WORDS - min_words + 1
    gains = (F.col("head.before") == F.col("head.first.before")) | (F.col("tail.after") == F.col("tail.first.after"))
    seed = F.coalesce(gains, F.lit(False)) if 2 * math.ceil(lacks / 2) - 1 >= WINDOW else F.lit(True)
    found = stored(found.filter((F.col("n_words") >= min_words) | seed), "runs")
    found = found.withColumn("head", F.col("head.first")).withColumn("tail", F.col("tail.first"))
    texts = df.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("row"), F.col(text).alias("text"))
    seeds = extended(found.filter(F.col("n_words") < min_words), texts)
    found = found.filter(F.col("n_words") >= min_words).select(*seeds.columns).unionByName(seeds)
    return found.select(F.col("id").alias(id_col), "row", "start", "end", "n_words", "first_id")


def substring_dedup(df: DataFrame, id_col: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``df`` without its repeated passages; bytes of a character that a cut has parted go with the passage."""
    spans = repeated_passages(df, id_col, text, min_words)
    spans = spans.groupBy(id_col, F.col("row").alias("_row")).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("_spans"))
    found = join_on(df.withColumn("_row", F.xxhash64(text)), spans, [id_col, "_row"], "left")
    names, schema = df.columns, T.StructType(df.schema.fields)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for value, gone in zip(batch.column(text).to_pylist(), batch.column("_spans").to_pylist(), strict=True):
                if gone:
                    raw, kept, last = value.encode(), [], 0
                    for span in gone:
                        kept.append(raw[last : span["start"]])
                        last = max(last, span["end"])
                    value = b"".join([*kept, raw[last:]]).decode("utf-8", "ignore")
                texts.append(value)
            columns = [pa.array(texts, pa.string()) if n == text else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    return map_batches(found, cut, schema)
