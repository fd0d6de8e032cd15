"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The symbols of many words lie in flat numpy arrays, words of equally many symbols side by side. A round
takes the words that have ``n`` symbols now, from the longest on: it finds the best pair of each (a segmented
minimum over pair ranks), merges the leftmost such pair of all of them at once, compacts the arrays, and
looks up the two pairs that changed in each. The words then have ``n - 1`` symbols and join those that
had so many from the start; words without a mergeable pair leave. That is the order of merges of the
library, which takes the best pair first and the leftmost of equal ones.

Words do not influence each other, as no piece of the vocabulary holds a space mark behind another
character, so a text is the sequence of its words, and each word is encoded once. Words of over
``LONG`` symbols (unbroken scripts, long runs of spaces) lie in one flat array whose symbols know their
neighbours. There a round takes the best rank that any pair has and merges all its pairs at once, the leftmost of
overlapping ones; it stops short where a merge makes a pair that is as good or better, which then comes first.
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtally.llm.common import map_batches, of_column, slices

SPACE = "▁"
_NONE = np.int32(np.iinfo(np.int32).max)
#: Symbols of a word that goes through rounds of words of equal length at most, and words that take part in them together.
LONG, STEP_WORDS = 64, 1 << 16
#: Words whose ids a worker remembers at most; beyond that it starts anew. Longer words are not kept.
CACHE_WORDS, CACHE_CHARS = 400_000, 48
_SLICE, _DECODED_ROWS = 2_000_000, 512
_SEGMENT = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")

codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class PairTable:
    """(left, right) -> merged symbol, as hash tables; a pair is in the first that had room.

    An entry holds the pair, a flag that some pair of this slot is in the next table, and the symbol.
    """

    BITS = 19
    FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)

    def __init__(self, pairs: dict[tuple[int, int], int], symbols: int) -> None:
        if symbols >= 1 << 20:
            raise ValueError("the vocabulary is too large for the tables")
        keys = np.array([a << 20 | b for a, b in pairs], np.int64)
        values = np.array(list(pairs.values()), np.int64)
        self.tables: list[tuple[np.uint64, np.ndarray]] = []
        for factor in map(np.uint64, self.FACTORS):
            table = np.full(1 << self.BITS, -2, np.int64) << 22
            slots = self._slots(keys, factor)
            _, first = np.unique(slots, return_index=True)
            table[slots[first]] = keys[first] << 22 | values[first]
            left = np.ones(len(keys), bool)
            left[first] = False
            table[slots[left]] |= 1 << 21
            keys, values = keys[left], values[left]
            self.tables.append((factor, table))
            if not len(keys):
                return
        raise ValueError("the vocabulary has too many pairs for the tables")

    def _slots(self, keys: np.ndarray, factor: np.uint64) -> np.ndarray:
        return ((keys.view(np.uint64) * factor) >> np.uint64(64 - self.BITS)).view(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged symbol of each pair, ``_NONE`` where there is none (negative symbols never merge)."""
        return self._find(left.astype(np.int64) << 20 | right, 0)

    def _find(self, keys: np.ndarray, k: int) -> np.ndarray:
        factor, table = self.tables[k]
        entry = table[self._slots(keys, factor)]
        hit = (entry >> 22) == keys
        out = np.where(hit, entry & ((1 << 21) - 1), _NONE).astype(np.int32)
        if k + 1 < len(self.tables):
            more = np.flatnonzero(~hit & ((entry >> 21 & 1) == 1))
            if len(more):
                out[more] = self._find(keys[more], k + 1)
        return out


class PieceModel:
    """A BPE model of the sentencepiece library, read from its file's bytes."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto.FromString(model)
        kind = proto.ModelProto.SentencePiece
        if spec.trainer_spec.model_type != proto.TrainerSpec.BPE:
            raise ValueError("only BPE models can be read")
        norm = spec.normalizer_spec
        plain = not norm.precompiled_charsmap and norm.escape_whitespaces and not norm.remove_extra_whitespaces
        if not plain or spec.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models that leave the text as it is can be read")
        types = [p.type for p in spec.pieces]
        if any(t in (kind.USER_DEFINED, kind.UNUSED) for t in types):
            raise ValueError("user-defined and unused pieces are not supported")
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        normal = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == kind.NORMAL}
        if any(SPACE in p.lstrip(SPACE) for p in normal):
            raise ValueError("a piece spans two words")
        self.byte_ids = {int(p.piece[3:-1], 16): i for i, p in enumerate(spec.pieces) if p.type == kind.BYTE}
        self.unknown = types.index(kind.UNKNOWN)
        self.fallback = bool(spec.trainer_spec.byte_fallback) and len(self.byte_ids) == 256
        self.end = spec.trainer_spec.eos_id
        # What an id stands for when it is decoded.
        surface = [p.piece.replace(SPACE, " ").encode() if p.type == kind.NORMAL else b"" for p in spec.pieces]
        for value, i in self.byte_ids.items():
            surface[i] = bytes([value])
        surface[self.unknown] = spec.trainer_spec.unk_surface.encode()
        self.surface = np.array(surface, object)
        self.is_control = np.array([t == kind.CONTROL for t in types])
        self.written = np.array([t == kind.NORMAL for t in types])
        # Symbols are piece ids, then the characters that occur in pieces without being one.
        symbol = dict(normal)
        for char in sorted(set("".join(normal))):
            symbol.setdefault(char, len(spec.pieces) + len(symbol) - len(normal))
        self.pieces = len(spec.pieces)
        self.char_of = np.zeros(max(symbol.values(), default=0) + 1, np.int64)
        self.symbol_of = {ord(c): i for c, i in symbol.items() if len(c) == 1}
        for char, i in self.symbol_of.items():
            self.char_of[i] = char
        score = {i: spec.pieces[i].score for i in normal.values()}
        # Best first; pieces of the same score share a rank, and the leftmost pair goes first.
        ranks = {value: k for k, value in enumerate(sorted(set(score.values()), reverse=True))}
        self.rank = np.full(len(self.char_of), _NONE, np.int32)
        for i, value in score.items():
            self.rank[i] = ranks[value]
        # The piece of each rank, or -1 where several share it.
        self.of_rank = np.full(len(ranks) + 1, -1, np.int32)
        shared = np.bincount([ranks[v] for v in score.values()], minlength=len(ranks)) > 1
        for i, value in score.items():
            if not shared[ranks[value]]:
                self.of_rank[ranks[value]] = i
        pairs = {}
        for piece, i in normal.items():
            for cut in range(1, len(piece)):
                a, b = symbol.get(piece[:cut]), symbol.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[a, b] = i
        self.table = PairTable(pairs, len(self.char_of))
        # Characters up to the last in the vocabulary; the rest are unknown.
        self.by_char = np.full(max(self.symbol_of, default=0) + 2, -1, np.int32)
        self.by_char[list(self.symbol_of)] = list(self.symbol_of.values())

    # -- encoding ---------------------------------------------------------------------------------

    def segments(self, text: str) -> list[str]:
        """The words of a text, each with the space marks before it."""
        return _SEGMENT.findall(self.prefix + text.replace(" ", SPACE)) if text else []

    def encode_words(self, words: Sequence[str]) -> list[bytes]:
        """The ids of each word by itself, as 32-bit numbers (a word may be a whole normalised text)."""
        out: list[bytes] = []
        for start in range(0, len(words), STEP_WORDS):
            out += self._step(words[start : start + STEP_WORDS])
        return out

    def _symbols(self, words: Sequence[str]) -> np.ndarray:
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        known = self.by_char[np.minimum(chars, len(self.by_char) - 1)]
        return np.where(known >= 0, known, -1 - chars).astype(np.int32)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        merged = self.table.merged(left, right)
        none = merged == _NONE
        merged[none] = 0
        ranks = self.rank[merged]
        ranks[none] = _NONE
        return ranks

    def _step(self, words: Sequence[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(words)
        by_length: dict[int, list[int]] = {}
        for k, word in enumerate(words):
            by_length.setdefault(len(word), []).append(k)
        long = [k for n in [n for n in by_length if n > LONG] for k in by_length.pop(n)]
        if long:
            for k, symbols in zip(long, self._flat_rounds([words[k] for k in long]), strict=True):
                self._emit(symbols[None, :], np.array([k]), out)
        symbol, rank, owner = np.zeros((0, 0), np.int32), np.zeros((0, 0), np.int32), np.zeros(0, np.int64)
        for n in range(max(by_length, default=0), 0, -1):
            if fresh := by_length.get(n):
                new = self._symbols([words[k] for k in fresh]).reshape(-1, n)
                new_rank = self._ranks(new[:, :-1].ravel(), new[:, 1:].ravel()).reshape(len(new), n - 1)
                symbol = np.concatenate([symbol.reshape(len(owner), n), new])
                rank = np.concatenate([rank.reshape(len(owner), n - 1), new_rank])
                owner = np.concatenate([owner, fresh])
            if not len(owner):
                symbol, rank = np.zeros((0, n - 1), np.int32), np.zeros((0, max(n - 2, 0)), np.int32)
                continue
            row = np.arange(len(owner))
            at = rank.argmin(axis=1) if n > 1 else np.zeros(len(owner), np.int64)  # the leftmost of equal ones
            best = rank[row, at] if n > 1 else np.full(len(owner), _NONE)
            finished = best == _NONE
            if finished.any():
                self._emit(symbol[finished], owner[finished], out)
                stay = ~finished
                symbol, rank, owner, at, best = symbol[stay], rank[stay], owner[stay], at[stay], best[stay]
                row = row[: len(owner)]
            if not len(owner):
                symbol, rank = np.zeros((0, n - 1), np.int32), np.zeros((0, max(n - 2, 0)), np.int32)
                continue
            merged = self.of_rank[best]
            several = np.flatnonzero(merged < 0)
            if len(several):
                r, c = row[several], at[several]
                merged[several] = self.table.merged(symbol[r, c], symbol[r, c + 1])
            symbol[row, at] = merged
            keep = np.ones(symbol.shape, bool)
            keep[row, at + 1] = False
            symbol = symbol[keep].reshape(-1, n - 1)
            keep = np.ones(rank.shape, bool)
            keep[row, at] = False
            rank = rank[keep].reshape(len(owner), n - 2)
            for r, c in ((row[at > 0], at[at > 0] - 1), (row[at < n - 2], at[at < n - 2])):
                rank[r, c] = self._ranks(symbol[r, c], symbol[r, c + 1])
        return out

    def _emit(self, symbol: np.ndarray, owner: np.ndarray, out: list[bytes]) -> None:
        plain = ((symbol >= 0) & (symbol < self.pieces)).all(axis=1)
        for k in np.flatnonzero(~plain).tolist():
            out[owner[k]] = self._ids(symbol[k]).tobytes()
        symbol, owner = symbol[plain], owner[plain]
        blob, size = symbol.tobytes(), 4 * symbol.shape[1]
        for i, k in enumerate(owner.tolist()):
            out[k] = blob[i * size : (i + 1) * size]

    def _flat_rounds(self, words: Sequence[str]) -> list[np.ndarray]:
        """The symbols of each word once no pair is left; words of any length, all in one array."""
        symbol = np.append(self._symbols(words), np.int32(-1))
        n = len(symbol) - 1
        ends = np.cumsum([len(w) for w in words])
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[ends - 1] = n  # one past the array stands for no neighbour
        before[np.r_[0, ends[:-1]]] = n
        rank = np.full(n + 1, _NONE)  # of the pair of a symbol and the next
        gone = np.zeros(n + 1, bool)
        waiting: dict[int, list[np.ndarray]] = {}
        order: list[int] = []

        def offer(at: np.ndarray) -> None:
            """Look up the pairs that start at some places and put these down under their ranks."""
            found = np.where(after[at] < n, self._ranks(symbol[at], symbol[after[at]]), _NONE)
            rank[at] = found
            at, found = at[found != _NONE], found[found != _NONE]
            by_rank = np.argsort(found, kind="stable")
            at, found = at[by_rank], found[by_rank]
            if len(at):
                starts = np.flatnonzero(np.diff(found, prepend=-1))
                for r, places in zip(found[starts].tolist(), np.split(at, starts[1:]), strict=True):
                    put(r, places)

        def put(r: int, places: np.ndarray) -> None:
            if r not in waiting:
                waiting[r] = []
                heapq.heappush(order, r)
            waiting[r].append(places)

        offer(np.arange(n))
        while order:
            r = heapq.heappop(order)
            at = np.unique(np.concatenate(waiting.pop(r)))
            every = at = at[~gone[at] & (rank[at] == r)]
            if not len(at):
                continue
            # In a run of pairs that overlap, every other one from the first on.
            heads = np.r_[True, after[at[:-1]] != at[1:]]
            place = np.arange(len(at))
            at = at[(place - np.maximum.accumulate(np.where(heads, place, 0))) % 2 == 0]
            right = after[at]
            merged = np.full(len(at), self.of_rank[r], np.int32)
            if merged[0] < 0:
                merged = self.table.merged(symbol[at], symbol[right])
            # The pairs that merging one by one meets: with the left side merged already, the right one not yet.
            left, beyond = before[at], after[right]
            left_symbol = symbol[left]
            beside = np.flatnonzero(left[1:] == right[:-1]) + 1
            left_symbol[beside] = merged[beside - 1]
            met = np.where(left < n, self._ranks(left_symbol, merged), _NONE)
            met = np.minimum(met, np.where(beyond < n, self._ranks(merged, symbol[beyond]), _NONE))
            better = np.flatnonzero(met <= r)
            if len(better):
                put(r, every)
                at, right, merged, beyond = (a[: better[0] + 1] for a in (at, right, merged, beyond))
            symbol[at], gone[right] = merged, True
            after[at] = beyond
            before[beyond] = at
            left = before[at]
            offer(np.unique(np.r_[left[left < n], at]))
        stay = ~gone[:n]
        return np.split(symbol[:n][stay], np.cumsum(np.add.reduceat(stay, np.r_[0, ends[:-1]], dtype=np.int64))[:-1])

    def _ids(self, symbols: np.ndarray) -> np.ndarray:
        """Symbols as ids; characters without a piece become their bytes, or the unknown id."""
        ids: list[int] = []
        for s in symbols.tolist():
            if 0 <= s < self.pieces:
                ids.append(s)
            elif self.fallback:
                ids += [self.byte_ids[b] for b in chr(-1 - s if s < 0 else int(self.char_of[s])).encode()]
            else:
                ids.append(self.unknown)
        return np.array(ids, np.int32)

    # -- decoding ---------------------------------------------------------------------------------

    def decode(self, ids: Sequence[int] | np.ndarray) -> str:
        """The text of ids: space marks become spaces, the one put in front goes, bytes are joined."""
        ids = np.asarray(ids, np.int32)
        control = self.is_control[ids]
        # A control symbol parts the bytes before it from those behind.
        runs = np.split(ids, np.flatnonzero(control)) if control.any() else [ids]
        text = "".join(b"".join(self.surface[run].tolist()).decode("utf-8", "each_byte") for run in runs)
        if self.prefix and text[:1] == " ":
            first = ids[~control][0]
            return text[1:] if self.written[first] else text
        return text


class Encoder:
    """Encodes texts, with a bounded memory of the words it has met."""

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        self.plain: dict[str, bytes] = {}  # words between single spaces, without their mark
        self.other: dict[str, bytes] = {}  # words with the marks before them

    def _learn(self, cache: dict[str, bytes], found: set[str], mark: str) -> list[str]:
        new = found.difference(cache)
        if len(cache) + len(new) > CACHE_WORDS:
            cache.clear()
            new = found
        words = list(new)
        cache.update(zip(words, self.model.encode_words([mark + w for w in words]), strict=True))
        return [w for w in words if len(w) > CACHE_CHARS]

    def __call__(self, texts: Sequence[str | None]) -> list[bytes]:
        """The ids of each text, as 32-bit numbers."""
        parts: list[tuple[dict[str, bytes], list[str]]] = []
        plain: set[str] = set()
        other: set[str] = set()
        for text in texts:
            text = text or ""
            # Beside single spaces, a mark may join with the next.
            if text and self.model.prefix and SPACE not in text and "  " not in text and text[0] != " " != text[-1]:
                words = text.split(" ")
                plain.update(words)
                parts.append((self.plain, words))
            else:
                words = self.model.segments(text)
                other.update(words)
                parts.append((self.other, words))
        long = [(self.plain, self._learn(self.plain, plain, SPACE)), (self.other, self._learn(self.other, other, ""))]
        out = [b"".join(map(cache.__getitem__, words)) for cache, words in parts]
        for cache, words in long:
            for word in words:
                del cache[word]
        return out


_encoders: dict[bytes, Encoder] = {}


def encoder_of(model: bytes) -> Encoder:
    """The encoder of a model; a worker keeps the last one and what it has met over its tasks."""
    if model not in _encoders:
        _encoders.clear()
        _encoders[model] = Encoder(PieceModel(model))
    return _encoders[model]


def _lists(encoded: Sequence[bytes]) -> pa.ListArray:
    offsets = np.cumsum([0, *(len(found) // 4 for found in encoded)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(encoded), np.int32)))


def _broadcast(df: DataFrame, model_path: str):
    with open(model_path, "rb") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode(df: DataFrame, model_path: str, text: str = "text", ids: str = "ids", end: bool = True) -> DataFrame:
    """Add the ids of each text as ``array<int>``; a column of that name is replaced.

    A null or empty text has no pieces, so its ids are the end id alone (or none). Everything else in
    a row is passed through. The model file is read on the driver and broadcast (its size is that of
    the vocabulary). Memory per task: one slice of texts and the remembered words.
    """
    model = _broadcast(df, model_path)
    keep = [f for f in df.schema.fields if f.name != ids]
    schema = T.StructType([*keep, T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)])
    names = [f.name for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(model.value)
        tail = np.array([encoder.model.end] if end else [], np.int32).tobytes()
        for batch in batches:
            for part in slices(batch, text, _SLICE):
                column = _lists([found + tail for found in encoder(part.column(text).to_pylist())])
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), column], [*names, ids])

    return map_batches(df, run, schema)


def decode(df: DataFrame, model_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text of an ``array<int>`` of ids; null ids give an empty text."""
    model = _broadcast(df, model_path)
    keep = [f for f in df.schema.fields if f.name != text]
    schema = T.StructType([*keep, T.StructField(text, T.StringType(), False)])
    names = [f.name for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = encoder_of(model.value).model
        for batch in batches:
            for at in range(0, batch.num_rows, _DECODED_ROWS):
                part = batch.slice(at, _DECODED_ROWS)
                lists = part.column(ids)
                flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
                valid = lists.is_valid().to_pylist()
                texts = [pieces.decode(flat[a:b]) if ok else "" for a, b, ok in zip(ends, ends[1:], valid, strict=False)]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(texts, pa.string())], [*names, text])

    return map_batches(df, run, schema)


def round_trip(
    df: DataFrame, model_path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded", end: bool = True
) -> DataFrame:
    """Add the ids of each text and the text that these decode to; columns of these names are replaced.

    The same as :func:`encode` and then :func:`decode`, by one worker a task instead of two, and only the texts go to it.
    """
    model = _broadcast(df, model_path)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = encoder_of(model.value)
        tail = np.array([encoder.model.end] if end else [], np.int32).tobytes()
        kind = pa.struct([("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
        for batch in batches:
            parts = []
            for part in slices(pa.RecordBatch.from_arrays([batch], ["text"]), "text", _SLICE):
                encoded = [found + tail for found in encoder(part.column("text").to_pylist())]
                texts = [encoder.model.decode(np.frombuffer(found, np.int32)) for found in encoded]
                parts.append(pa.StructArray.from_arrays([_lists(encoded), pa.array(texts, pa.string())], fields=list(kind)))
            yield pa.concat_arrays(parts) if parts else pa.array([], kind)

    both = of_column(df.sparkSession, run, "struct<ids: array<int>, decoded: string>")(F.col(text).cast("string"))
    kept = [F.col(f"`{c}`") for c in df.columns if c not in (ids, decoded)]
    coded = df.select(*kept, both.alias("_logtally_coded"))
    return coded.select(*kept, F.col("_logtally_coded.ids").alias(ids), F.col("_logtally_coded.decoded").alias(decoded))
