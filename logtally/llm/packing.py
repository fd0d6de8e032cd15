"""Packing documents into sequences by lexical retrieval.

Every document becomes token ids with a separator behind them. Whole windows of a long document are sequences by
themselves; what remains of each document, under a window, is packed: sorted by its most telling tokens, so that
lexically near documents come to stand together, and cut into shards of a bounded number. A shard has an inverted
index over its remainders with BM25 weights, whose statistics are those of all documents. A seed's best
unused neighbours fill its window, first those that fit whole, then the best of the others is cut, and what is
left of it is the next seed. So all windows of a shard are full but the last, which is
broken up into powers of two: nothing is padded.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer

from logtally.llm.common import map_batches, slices, stored
from logtally.session import ensure_checkpoint_dir

WINDOW, SEPARATOR = 1024, 0
#: Remainders of a shard, and of a task, about.
SHARD_DOCS, TASK_DOCS = 4096, 16_384
#: Tokens of a seed that it is looked up by, the highest weights first, and neighbours that come back.
QUERY_TERMS, NEIGHBOURS = 32, 16
#: The constants of BM25.
K1, B = 1.2, 0.75
#: Characters that are encoded at once, and a run of white space from which on the exact library takes over.
_PIECE, _RUN = 1 << 20, 1 << 16
# Behind a visible character no token goes on with a space, so a text may be cut there.
_CUT = re.compile(r"(?<=[^\s\x00-\x20\x7f-\xa0])\x20")
_LONG_RUN = re.compile(rf"\s{{{_RUN}}}")
# A pattern whose look-ahead only matters in runs of white space, and how it does without one elsewhere.
_WORDS, _AHEAD, _PLAIN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+", r"|\s+(?!\S)|\s+", r"|\s+"
_WHITE = "\t\n\v\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
# A run before a visible character is left one character early. Characters that each such cut must have to be worth its call.
_IN_RUN, _RUN_CHARS = re.compile(f"(?<=[{_WHITE}])(?=[{_WHITE}][^{_WHITE}])"), 256
_WHOLE, _REST, _TOKEN = 0, 1, 2


def byte_characters() -> dict[str, int]:
    """The bytes by the characters that stand for them in a byte-level vocabulary: visible ones for themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


class Encoder:
    """Ids as ``tokenizers`` gives them for a byte-level BPE file, without special tokens added.

    Merging is done by tiktoken with the file's ranks, four times as fast and equal for every text (the tests
    hold that over all characters), but for special tokens in a text and very long runs of white space.
    Those go through the library itself.
    """

    def __init__(self, vocabulary: str, pattern: str) -> None:
        spec = json.loads(vocabulary)
        of = byte_characters()
        ranks = {bytes(of[c] for c in token): rank for token, rank in spec["model"]["vocab"].items()}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        # Without look-ahead the pattern is matched by an automaton, which takes a third less time.
        plain = pattern == _WORDS + _AHEAD
        self.plain = tiktoken.Encoding("plain", pat_str=_WORDS + _PLAIN, mergeable_ranks=ranks, special_tokens={}) if plain else None
        self.exact = Tokenizer.from_str(vocabulary)
        special = [re.escape(token["content"]) for token in spec["added_tokens"]]
        self.special = re.compile("|".join(special) if special else r"(?!)")
        self.size = self.exact.get_vocab_size()
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")

    def __call__(self, text: str | None) -> np.ndarray:
        """The ids of a whole text and the separator."""
        parts, text, start = [], text or "", 0
        while start < len(text):
            cut = _CUT.search(text, start + _PIECE) if len(text) - start > _PIECE else None
            end = cut.start() if cut else len(text)
            parts.append(self._ids(text[start:end]))
            start = end
        return np.concatenate([*parts, np.array([SEPARATOR], self.kind)])

    def _ids(self, text: str) -> np.ndarray:
        if self.special.search(text) or (len(text) >= _RUN and _LONG_RUN.search(text)):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, self.kind)
        parts = self._parts(text)
        encode = self.plain.encode_ordinary if parts else self.fast.encode_ordinary
        ids = encode(text) if len(parts) < 2 else [i for part in parts for i in encode(part)]
        return np.fromiter(ids, self.kind, len(ids))

    def _parts(self, text: str) -> list[str]:
        """Where the plain pattern does: the text, cut in its runs of white space. Nothing if these are many."""
        white = [c for c in _WHITE if c in text]
        runs = sum(text.count(a + b) for a in white for b in white)
        if self.plain is None or runs * _RUN_CHARS > len(text):
            return []
        return _IN_RUN.split(text) if runs else [text]


@functools.lru_cache(maxsize=1)
def encoder_of(vocabulary: str, pattern: str) -> Encoder:
    return Encoder(vocabulary, pattern)


def cut_documents(df: DataFrame, vocabulary: str, pattern: str, window: int = WINDOW) -> DataFrame:
    """The windows and the remainder of each document of ``(doc, text)``, and how many documents have each token.

    ``kind`` tells rows apart: a whole window with its ``sequence``; a remainder with a unique number ``row``; or
    a token (``start``) and its documents in the partition (``doc_tokens``).
    """
    shared = df.sparkSession.sparkContext.broadcast((vocabulary, pattern))
    doc = df.schema["doc"].dataType
    names = ["kind", "doc", "doc_tokens", "start", "row", "sequence", "ids"]
    numbers = [T.StructField(n, T.LongType()) for n in names[2:6]]
    schema = T.StructType([T.StructField("kind", T.ByteType()), T.StructField("doc", doc), *numbers, T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = encoder_of(*shared.value), TaskContext.get().partitionId() << 32
        holding, last, row, sequence = np.zeros(encoder.size, np.int64), np.zeros(encoder.size, np.int64), task, task
        for batch in batches:
            for part in slices(batch, "text", 4_000_000):
                out: list[tuple] = []
                for at, ids in enumerate(map(encoder, part.column("text").to_pylist())):
                    body, places = ids[:-1], np.arange(len(ids) - 1)
                    last[body] = places
                    holding[body[last[body] == places]] += 1  # each token at its last place
                    for start in range(0, len(ids), window):
                        piece = ids[start : start + window]
                        if len(piece) == window:
                            out.append((_WHOLE, at, len(ids), start, None, sequence << 1 | 1, piece.tobytes()))
                            sequence += 1
                        else:
                            out.append((_REST, at, len(ids), start, row, None, piece.tobytes()))
                            row += 1
                kind, at, *others = zip(*out, strict=True)
                columns = [pa.array(kind, pa.int8()), part.column("doc").take(pa.array(at))]
                columns += [pa.array(v, pa.int64()) for v in others[:4]]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(others[4], pa.binary())], names)
        some = np.flatnonzero(holding)
        none = [pa.nulls(len(some), pa.int64())] * 2
        column = pa.nulls(len(some), to_arrow_type(doc))
        numbers = [pa.array(holding[some]), pa.array(some), *none]
        yield pa.RecordBatch.from_arrays([pa.array([_TOKEN] * len(some), pa.int8()), column, *numbers, pa.nulls(len(some), pa.binary())], names)

    return map_batches(df.select("doc", "text"), run, schema)


def inverse_frequencies(holding: dict[int, int], documents: int, size: int) -> np.ndarray:
    """The weight of each token by the documents that have it."""
    df = np.zeros(size)
    df[list(holding)] = list(holding.values())
    return np.log1p((documents - df + 0.5) / (df + 0.5))


class Index:
    """An inverted index over the remainders of a shard, with their BM25 weights."""

    def __init__(self, texts: Sequence[np.ndarray], idf: np.ndarray, average: float) -> None:
        self.documents = len(texts)
        bodies = [t[:-1] if len(t) and t[-1] == SEPARATOR else t for t in texts]  # without the separator
        lengths = np.array([len(b) for b in bodies])
        doc = np.repeat(np.arange(len(bodies)), lengths)
        flat = np.concatenate(bodies).astype(np.int64) if len(bodies) else np.zeros(0, np.int64)
        pairs, tf = counted(doc * len(idf) + flat)
        doc, token = np.divmod(pairs, len(idf))
        weight = idf[token] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[doc] / average))
        self.token, self.weight = token, weight
        self.ends = np.searchsorted(doc, np.arange(len(bodies) + 1))
        order = np.argsort(token, kind="stable")
        self.holders, self.scores = doc[order], weight[order]
        self.bounds = np.searchsorted(token[order], np.arange(len(idf) + 1))

    def terms(self, document: int, number: int) -> np.ndarray:
        """The tokens of highest weight; ties go to the smaller id."""
        low, high = self.ends[document], self.ends[document + 1]
        return self.token[low + np.argsort(-self.weight[low:high], kind="stable")[:number]]

    def neighbours(self, document: int, used: np.ndarray, number: int = NEIGHBOURS, terms: int = QUERY_TERMS) -> np.ndarray:
        """The unused documents of highest score against a document's terms; ties go to the smaller number."""
        lists = [slice(self.bounds[t], self.bounds[t + 1]) for t in self.terms(document, terms)]
        if not lists:
            return np.zeros(0, np.int64)
        holders, scores = (np.concatenate([a[s] for s in lists]) for a in (self.holders, self.scores))
        score = np.bincount(holders, scores, self.documents)
        score[used] = 0
        some = np.flatnonzero(score > 0)
        if len(some) > number:
            found = score[some]
            some = some[found >= np.partition(found, -number)[-number]]
        return some[np.argsort(-score[some], kind="stable")[:number]]


Piece = tuple[int, int, int, int, int]  # document, place there, length, sequence, place there


def powers(total: int) -> list[int]:
    """The powers of two that a number is the sum of, largest first."""
    return [1 << k for k in reversed(range(total.bit_length())) if total >> k & 1]


def fill(lengths: Sequence[int], index: Index, window: int = WINDOW) -> list[Piece]:
    """Pack remainders, each under a window, into sequences; every token lies in one piece."""
    used = np.zeros(len(lengths), bool)
    taken = [0] * len(lengths)
    out: list[Piece] = []
    sequence, following, rest = 0, 0, -1

    def place(document: int, room: int) -> int:
        """Put what is left of a document, or what fits, into the sequence; the room that remains."""
        size = min(room, lengths[document] - taken[document])
        out.append((document, taken[document], size, sequence, window - room))
        taken[document] += size
        used[document] = True
        return room - size

    def next_unused() -> int:
        nonlocal following
        while following < len(lengths) and used[following]:
            following += 1
        return following if following < len(lengths) else -1

    while (seed := rest if rest >= 0 else next_unused()) >= 0:
        room, rest = place(seed, window), -1
        near = index.neighbours(seed, used).tolist()
        for document in near:
            if lengths[document] <= room:
                room = place(document, room)
        while room and (document := next((d for d in near if not used[d]), next_unused())) >= 0:
            room = place(document, room)
            if taken[document] < lengths[document]:
                rest = document
        if room:  # the last one
            last = [p for p in out if p[3] == sequence]
            return [*out[: -len(last)], *_broken(last, powers(window - room))]
        sequence += 1
    return out


def _broken(pieces: Sequence[Piece], sizes: Sequence[int]) -> Iterator[Piece]:
    """The pieces of one sequence, cut so as to fill several of the given sizes."""
    sizes = list(sizes)
    sequence, at = pieces[0][3], 0
    for document, start, length, *_ in pieces:
        while length:
            size = min(length, sizes[0] - at)
            yield document, start, size, sequence, at
            start, length, at = start + size, length - size, at + size
            if at == sizes[0]:
                del sizes[0]
                sequence, at = sequence + 1, 0


def counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values in order, and how often each stands there."""
    if len(values) and values.max() < 1 << 32:
        values = values.astype(np.uint32)  # sorts in half the time
    found, number = np.unique(values, return_counts=True)
    return found.astype(np.int64), number


def leading_tokens(texts: Sequence[np.ndarray], idf: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The two tokens of each text that weigh most, of those that stand in several documents; -1 if there is none."""
    leads = np.full((len(texts), 2), -1, np.int32)
    doc = np.repeat(np.arange(len(texts)), [len(t) - 1 for t in texts])
    flat = np.concatenate([t[:-1] for t in texts]).astype(np.int64)
    pairs, tf = counted(doc * len(idf) + flat)
    doc, token = np.divmod(pairs, len(idf))
    keep = common[token]
    doc, token, weight = doc[keep], token[keep], (tf * idf[token])[keep]
    if len(doc):
        begins = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        own = np.repeat(np.arange(len(begins)), np.diff(np.r_[begins, len(doc)]))
        for k in (0, 1):
            best = np.maximum.reduceat(weight, begins)
            there = np.flatnonzero((weight == best[own]) & (weight > -np.inf))
            there = there[np.r_[True, doc[there][1:] != doc[there][:-1]]] if len(there) else there  # the smallest token
            leads[doc[there], k] = token[there]
            weight[there] = -np.inf
    return leads


def pack(
    df: DataFrame,
    vocabulary_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    shard_docs: int = SHARD_DOCS,
    task_docs: int = TASK_DOCS,
) -> DataFrame:
    """``(id_col, start, length, ids, doc_tokens, sequence_id, offset)``, one row per piece.

    ``ids`` are the piece's ids as little-endian unsigned 32-bit numbers, ``start`` its place in the document's ids,
    ``offset`` its place in the sequence. Sequences have ``window`` ids or a power of two.
    The vocabulary file is read on the driver and broadcast, as are the tokens' weights (a number a token).
    Null and empty texts are the separator alone. Rows of equal or null id are documents of their own. Other
    columns are ignored; an empty table gives an empty result. Sequence numbers are unique, not gapless.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = file.read()
    encoder = encoder_of(vocabulary, pattern)
    size, kind = encoder.size, encoder.kind
    docs = df.select(F.col(id_col).alias("doc"), F.col(text).alias("text"))
    cut = stored(cut_documents(docs, vocabulary, pattern, window), "token-pieces")
    holding = {r["start"]: r["n"] for r in cut.filter(F.col("kind") == _TOKEN).groupBy("start").agg(F.sum("doc_tokens").alias("n")).collect()}
    rests = cut.filter(F.col("kind") == _REST)
    documents = cut.filter((F.col("kind") != _TOKEN) & (F.col("start") == 0)).count()
    number, body = rests.agg(F.count("*"), F.avg(F.octet_length("ids") / kind.itemsize - 1)).first()
    idf = inverse_frequencies(holding, documents, size)
    common = np.zeros(size, bool)
    common[[token for token, n in holding.items() if n > 1]] = True
    weights = spark.sparkContext.broadcast((idf, common, max(body or 0.0, 1.0)))

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, common, _ = weights.value
        for batch in batches:
            if batch.num_rows:
                leads = leading_tokens(_arrays(batch.column("ids"), kind), idf, common)
                columns = [*batch.columns, pa.array(leads[:, 0]), pa.array(leads[:, 1])]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "lead", "second"])

    own = ["doc", "doc_tokens", "start", "row", "ids"]
    fields = [cut.schema[n] for n in own]
    leads = [T.StructField(n, T.IntegerType()) for n in ("lead", "second")]
    keys = ["lead", "second", "row"]  # rows are unique, so a token that many share is split
    # Dealing rows to ranges reads them twice, so they are kept.
    sort = stored(map_batches(rests.select(*own), lead, T.StructType([*fields, *leads])), "leading-tokens")
    sort = sort.repartitionByRange(max(1, -(-number // task_docs)), *keys).sortWithinPartitions(*keys).select(*own)
    out = ["doc", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    schema = T.StructType([cut.schema[n] if n in ("doc", "ids") else T.StructField(n, T.LongType()) for n in out])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """The rows of a task in runs of a shard each."""
        held, rows = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, shard_docs - rows)
                held.append(part)
                rows += part.num_rows
                batch = batch.slice(part.num_rows)
                if rows == shard_docs:
                    yield pa.Table.from_batches(held)
                    held, rows = [], 0
        if rows:
            yield pa.Table.from_batches(held)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, _, average = weights.value
        sequence = TaskContext.get().partitionId() << 32
        for shard in shards(batches):
            texts = _arrays(shard.column("ids").combine_chunks(), kind)
            pieces = fill([len(t) for t in texts], Index(texts, idf, average), window)
            at, begin, length, number, offset = np.array(pieces, np.int64).T
            ids = [texts[a][b : b + n].astype("<u4").tobytes() for a, b, n, *_ in pieces]
            start = shard.column("start").to_numpy()[at] + begin
            doc = shard.column("doc").combine_chunks().take(pa.array(at))
            tokens = shard.column("doc_tokens").to_numpy()[at]
            columns = [doc, pa.array(start), pa.array(length), pa.array(ids, pa.binary()), pa.array(tokens)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array((sequence + number) << 1), pa.array(offset)], out)
            sequence += int(number.max()) + 1

    def widened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [t.astype("<u4").tobytes() for t in _arrays(batch.column("ids"), kind)]
            columns = {n: batch.column(n) for n in ("doc", "start", "doc_tokens", "sequence_id")}
            full = pa.array(np.full(len(ids), window, np.int64))
            columns |= {"ids": pa.array(ids, pa.binary()), "length": full, "offset": pa.array(np.zeros(len(ids), np.int64))}
            yield pa.RecordBatch.from_arrays([columns[n] for n in out], out)

    whole = cut.filter(F.col("kind") == _WHOLE).select("doc", "start", "doc_tokens", F.col("sequence").alias("sequence_id"), "ids")
    both = map_batches(whole, widened, schema).unionByName(map_batches(sort, packed, schema))
    return both.withColumnRenamed("doc", id_col) if id_col != "doc" else both


def _arrays(column: pa.Array, kind: np.dtype) -> list[np.ndarray]:
    return [np.frombuffer(value, kind) for value in column.to_pylist()]
