"""Language identification: averaged hashed subword embeddings with a linear softmax.

Subwords are the letter 2- to 4-grams of each lower-cased word with a mark at both its ends, hashed
into a table of embeddings. A text is the mean of its subwords' embeddings, and a softmax over a linear
map of it gives the languages. Both are trained by stochastic gradient descent in numpy on a bounded
sample; a temperature and a rejection threshold are then set on rows kept out of that training. Any number of
languages can be told apart: a further one adds a column to the linear map, not to the table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtally.llm.common import join_on, map_batches, slices, stored

UNDETERMINED = "und"
#: Rows of the training sample per language and in all, about, and subwords drawn of a row.
ROWS_PER_LANGUAGE, SAMPLE_ROWS, SUBWORDS_PER_ROW = 500, 64_000, 768
BUCKETS, DIM = 1 << 16, 16
GRAMS = (2, 3, 4)
_SLICE = 1_000_000
_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D), np.uint32(0x27D4EB2F))
_letters: list[np.ndarray] = []


def _is_letter(chars: np.ndarray) -> np.ndarray:
    if not _letters:  # made once in a worker
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0][chars]


def subwords(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all subwords of some texts, and how many each text has; whole texts, in order."""
    lowered = [(text or "").lower() + " " for text in texts]
    chars = np.frombuffer(" ".join(["", *lowered]).encode("utf-32-le"), np.uint32)
    # Text k's characters end at ends[k]; the separator in front is a mark of no text's own.
    ends = 1 + np.cumsum([len(t) + 1 for t in lowered]) - 1 if lowered else np.zeros(0, np.int64)
    letter = _is_letter(chars)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one mark behind each word,
    keep[:-1] |= letter[1:]  # and one in front
    first = np.cumsum(keep)[ends - 1] if lowered else ends  # kept characters up to each text's end
    code = np.where(letter, chars, 0)[keep].astype(np.uint32)
    inner = code != 0
    buckets, owners = [], []
    for n in GRAMS:
        if len(code) < n:
            continue
        last = len(code) - n + 1
        value = np.zeros(last, np.uint32)
        ok = np.ones(last, bool)
        for k in range(n):
            value = (value ^ code[k : k + last]) * _MIX[k]
            value ^= value >> np.uint32(15)
            if 0 < k < n - 1:
                ok &= inner[k : k + last]
        if n == 2:
            ok &= inner[:last] | inner[1 : 1 + last]
        at = np.flatnonzero(ok)
        buckets.append((value[at] * _MIX[0]) >> np.uint32(16))
        owners.append(np.searchsorted(first, at, side="right"))
    if not buckets:
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    bucket, owner = np.concatenate(buckets), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return bucket[order].astype(np.int64), np.bincount(owner, minlength=len(texts))[: len(texts)]


@dataclass
class LanguageModel:
    """What prediction needs. As mean and map are linear, ``table`` holds the embeddings or, if that is
    narrower, what each bucket adds for each language; ``weights`` takes the table's mean to the languages."""

    languages: list[str]
    table: np.ndarray = field(repr=False)  # (width, BUCKETS), float32
    weights: np.ndarray = field(repr=False)  # (width, languages)
    bias: np.ndarray = field(repr=False)
    temperature: float = 1.0
    threshold: float = 0.0

    @classmethod
    def of(cls, languages: list[str], embeddings: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> LanguageModel:
        if len(languages) < weights.shape[0]:
            embeddings, weights = embeddings @ weights, np.eye(len(languages), dtype=np.float32)
        return cls(languages, np.ascontiguousarray(embeddings.T), weights, bias)

    @property
    def logits(self) -> np.ndarray:
        """What each bucket adds for each language."""
        return self.table.T @ self.weights

    def scores(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and probability of each text; ``und`` and 0 where no letter is found."""
        bucket, counts = subwords(texts)
        names, best = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        some = np.flatnonzero(counts)
        if not len(some) or not self.languages:
            return names, best
        starts = (np.cumsum(counts) - counts)[some]
        sums = np.stack([np.add.reduceat(column[bucket], starts, dtype=np.float64) for column in self.table], axis=1)
        p = softmax((sums / counts[some, None] @ self.weights + self.bias) / self.temperature)
        for i, k, value in zip(some.tolist(), p.argmax(axis=1).tolist(), p.max(axis=1).tolist(), strict=True):
            names[i], best[i] = self.languages[k], value
        return names, best


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(rows: Sequence[Sequence[int]], labels: Sequence[str], epochs: int = 12, rate: float = 4.0, keep: float = 0.99) -> LanguageModel:
    """Train on bags of buckets. A fifth of the rows is kept out to set temperature and threshold.

    ``threshold`` is the score that a share of ``keep`` of the kept-out texts, short excerpts included,
    reaches when they are identified rightly.
    """
    languages = sorted(set(labels))
    rng = np.random.default_rng(3)
    embeddings = rng.normal(0, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    weights, bias = np.zeros((DIM, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    if not languages:
        return LanguageModel.of([], embeddings, weights, bias)
    bags = [np.asarray(r, np.int64) for r in rows]
    number = {language: k for k, language in enumerate(languages)}
    y = np.array([number[label] for label in labels])
    order = rng.permutation(len(bags))
    kept, train = order[: len(bags) // 5], order[len(bags) // 5 :]
    share = np.bincount(y[train], minlength=len(languages)) / len(train)
    balance = np.where(share > 0, 1 / np.maximum(share * len(languages), 1e-9), 0).astype(np.float32)

    def views(rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Excerpts: some subwords of each row, drawn with repetition, padded with weight 0."""
        drawn = np.stack([bags[i][rng.integers(0, len(bags[i]), sizes.max())] for i in rows])
        return drawn, (np.arange(sizes.max()) < sizes[:, None]).astype(np.float32) / sizes[:, None]

    steps = [part for _ in range(epochs) for part in np.array_split(rng.permutation(train), max(1, len(train) // 32))]
    for k, part in enumerate(steps):
        tokens, share_of = views(part, rng.integers(4, 96, len(part)))
        mean = (embeddings[tokens] * share_of[:, :, None]).sum(axis=1)
        error = softmax(mean @ weights + bias)
        error[np.arange(len(part)), y[part]] -= 1
        error *= balance[y[part], None]
        step = rate * (1 - k / len(steps)) / len(part)
        back = (error @ weights.T)[:, None, :] * share_of[:, :, None]
        weights -= step * (mean.T @ error)
        bias -= 0.1 * step * error.sum(axis=0)
        np.add.at(embeddings, tokens, -step * DIM * back)
    model = LanguageModel.of(languages, embeddings, weights, bias)
    if len(kept) >= 5:
        # Their number bounds the memory of the views and of a score for each language.
        kept = kept[: max(200, 4_000_000 // len(languages))]
        repeated = np.repeat(kept, 4)
        sizes = np.tile([8, 32, 128, 512], len(kept))
        logits = []
        for at in range(0, len(repeated), 256):
            tokens, share_of = views(repeated[at : at + 256], sizes[at : at + 256])
            logits.append((embeddings[tokens] * share_of[:, :, None]).sum(axis=1) @ weights + bias)
        logits, truth = np.concatenate(logits), y[repeated]
        grid = np.geomspace(0.05, 20, 60)
        loss = [-np.log(softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
        p = softmax(logits / model.temperature)
        right = p.max(axis=1)[p.argmax(axis=1) == truth]
        model.threshold = float(np.quantile(right, 1 - keep)) if len(right) else 0.0
    return model


def training_sample(labelled: DataFrame, id_col: str, text: str, lang: str, per_language: int, drawn: int) -> DataFrame:
    """``(lang, draw, buckets)``: about ``per_language`` rows of each language, chosen by a hash of id and text.

    All languages take part; there are about ``SAMPLE_ROWS`` rows in all, so fewer of each if languages are very many.
    Of a row ``drawn`` subwords are taken at random from its whole text. Rows of equal id and text are one.
    """
    names = labelled.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(id_col).alias("id"), F.col(text).alias("text"))
    # Written, so that the join knows its size: broadcast while it is small.
    counts = stored(names.groupBy("lang").agg(F.count("*").alias("_n")), "languages")
    number = counts.count()
    wanted = min(per_language, max(1, SAMPLE_ROWS // max(number, 1)))
    draw = F.xxhash64("id", "text", F.lit("language sample"))
    chosen = join_on(names.withColumn("draw", draw), counts, ["lang"])
    chosen = chosen.filter(F.pmod("draw", F.lit(1 << 30)) / (1 << 30) < F.lit(float(wanted)) / F.col("_n"))
    chosen = chosen.select("lang", "draw", "text").dropDuplicates(["lang", "draw"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                bucket, counts = subwords(part.column("text").to_pylist())
                ends = np.cumsum(counts)
                found = []
                for start, end in zip(ends - counts, ends, strict=True):
                    rng = np.random.default_rng(int(end - start))
                    found.append(bucket[start:end][rng.integers(0, end - start, drawn)].astype(np.int32) if end > start else [])
                buckets = pa.array(found, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("lang"), part.column("draw"), buckets], ["lang", "draw", "buckets"])

    return map_batches(chosen, run, "lang string, draw bigint, buckets array<int>").filter(F.size("buckets") > 0)


def train(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_language: int = ROWS_PER_LANGUAGE,
    drawn: int = SUBWORDS_PER_ROW,
) -> LanguageModel:
    """Fit on a sample of about ``per_language`` rows a language and ``SAMPLE_ROWS`` in all, ``4 * drawn`` bytes each on the driver."""
    sample = training_sample(labelled, id_col, text, lang, per_language, drawn).toArrow().combine_chunks()
    sample = sample.sort_by([("lang", "ascending"), ("draw", "ascending")])
    rows = [row.values.to_numpy(zero_copy_only=False) for row in sample.column("buckets")]
    return fit(rows, sample.column("lang").to_pylist())


def identify(
    df: DataFrame, model: LanguageModel, text: str = "text", lang_pred: str = "lang_pred", score: str = "score", accepted: str = "accepted"
) -> DataFrame:
    """Add language, probability and whether the calibrated threshold accepts it.

    Null texts and texts without a letter are ``und`` with score 0, not accepted; so is every text if
    nothing could be learned. Equal scores go to the first language by name. Columns of these names
    are replaced. The model is broadcast: ``4 * BUCKETS * DIM`` bytes at most and ``4 * DIM`` a language.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)
    own = (lang_pred, score, accepted)
    keep = [f for f in df.schema.fields if f.name not in own]
    names = [f.name for f in keep]
    fields = [T.StructField(lang_pred, T.StringType()), T.StructField(score, T.DoubleType()), T.StructField(accepted, T.BooleanType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in slices(batch, text, _SLICE):
                found, best = known.scores(part.column(text).to_pylist())
                sure = (best >= known.threshold) & (best > 0)
                columns = [pa.array(found, pa.string()), pa.array(best), pa.array(sure)]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), *columns], [*names, *own])

    return map_batches(df, run, T.StructType([*keep, *fields]))
