"""Toxicity: a sparse linear classifier regularised by counterfactuals.

A text is the set of its words and of the words' beginnings, hashed. The training minimises the
class-balanced logistic loss plus three penalties: on the weights' size, on their number, and on how much
the score of a labelled sentence changes when an identity term in it is swapped for another one of
its group (or for the group's neutral word). The last keeps neutral mentions of a group from counting
as toxic because the labelled rows happen to mention that group in toxic sentences more often.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtally.llm.common import map_batches, of_column, slices

#: Labelled rows of each class that the training takes, by expectation; four times that in all is a hard limit.
ROWS_PER_CLASS = 1500
#: Further labelled rows that are looked through for sentences with identity terms, in multiples of ``ROWS_PER_CLASS``.
SWAP_ROWS = 12
#: Rows that a feature occurs in at least; a few copies of one text do not make its words telling.
LEAST_ROWS = 4
BUCKETS = 1 << 20
#: Lengths of the word beginnings that are features beside the whole word.
PREFIXES = (4, 5, 6)
#: Swaps taken from one labelled row at most: of more, those of smallest hash over the whole text.
SWAPS_PER_ROW = 64
#: Swaps held while a text is read, in multiples of those that are taken.
_HELD_SWAPS = 8
_CACHE_WORDS = 300_000

# Identity terms that may stand for one another, by language; the last of a group is its neutral word.
IDENTITY_GROUPS: dict[str, tuple[tuple[str, ...], ...]] = {
    "en": (
        ("muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "atheist", "religious"),
        ("muslims", "christians", "jews", "hindus", "buddhists", "catholics", "atheists", "people"),
        ("black", "white", "asian", "latino", "african", "european", "arab", "indigenous", "local"),
        ("women", "men", "girls", "boys", "people"),
        ("woman", "man", "girl", "boy", "person"),
        ("she", "he", "they"),
        ("gay", "lesbian", "bisexual", "straight", "transgender", "queer", "single"),
        ("american", "chinese", "indian", "mexican", "russian", "german", "french", "turkish", "foreign"),
        ("immigrants", "refugees", "foreigners", "citizens", "residents"),
        ("old", "young", "elderly", "adult"),
        ("disabled", "blind", "deaf", "healthy"),
    ),
    "de": (
        ("muslimisch", "christlich", "jüdisch", "katholisch", "evangelisch", "religiös"),
        ("muslime", "christen", "juden", "hindus", "buddhisten", "katholiken", "atheisten", "leute"),
        ("schwarze", "weiße", "asiatische", "afrikanische", "arabische", "einheimische"),
        ("frauen", "männer", "mädchen", "jungen", "menschen"),
        ("frau", "mann", "person"),
        ("schwule", "lesben", "homosexuelle", "heterosexuelle", "ledige"),
        ("türken", "polen", "russen", "araber", "chinesen", "deutsche", "franzosen", "ausländer", "bürger"),
        ("flüchtlinge", "einwanderer", "migranten", "bewohner"),
        ("behinderte", "blinde", "gehörlose", "gesunde"),
    ),
    "fr": (
        ("musulman", "chrétien", "juif", "catholique", "bouddhiste", "athée", "religieux"),
        ("musulmans", "chrétiens", "juifs", "catholiques", "bouddhistes", "athées", "gens"),
        ("noir", "blanc", "asiatique", "africain", "arabe", "européen", "local"),
        ("femmes", "hommes", "filles", "garçons", "personnes"),
        ("femme", "homme", "fille", "garçon", "personne"),
        ("gays", "lesbiennes", "homosexuels", "hétérosexuels", "célibataires"),
        ("américains", "chinois", "allemands", "russes", "turcs", "français", "étrangers"),
        ("immigrés", "réfugiés", "migrants", "citoyens", "habitants"),
        ("handicapés", "aveugles", "sourds", "valides"),
    ),
    "es": (
        ("musulmán", "cristiano", "judío", "católico", "budista", "ateo", "religioso"),
        ("musulmanes", "cristianos", "judíos", "católicos", "budistas", "ateos", "personas"),
        ("negro", "blanco", "asiático", "africano", "árabe", "europeo", "local"),
        ("mujeres", "hombres", "chicas", "chicos", "personas"),
        ("mujer", "hombre", "chica", "chico", "persona"),
        ("gays", "lesbianas", "homosexuales", "heterosexuales", "solteros"),
        ("americanos", "chinos", "mexicanos", "rusos", "alemanes", "españoles", "extranjeros"),
        ("inmigrantes", "refugiados", "migrantes", "ciudadanos", "vecinos"),
        ("discapacitados", "ciegos", "sordos", "sanos"),
    ),
}

Groups = Mapping[str, Sequence[Sequence[str]]]


def swaps_of(groups: Groups = IDENTITY_GROUPS) -> dict[str, list[str]]:
    """Each term with the others of its groups."""
    out: dict[str, list[str]] = {}
    for group in (g for language in groups.values() for g in language):
        for term in group:
            own = out.setdefault(term, [])
            own += [other for other in group if other != term and other not in own]
    return out


SWAPS = swaps_of()

_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"[^.!?\n]+")


def features(word: str) -> list[int]:
    """The buckets of a lower-cased word and of its beginnings."""
    parts = [f"={word}", *(word[:k] for k in PREFIXES if len(word) > k)]
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) % BUCKETS for p in parts]


def words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def feature_set(found: Iterable[str]) -> set[int]:
    return {f for word in found for f in features(word)}


def _by_hash(item: tuple[tuple[frozenset[int], frozenset[int]], int]) -> tuple[int, list[int], list[int]]:
    (come, go), digest = item
    return digest, sorted(come), sorted(go)


def swaps(text: str | None, limit: int = SWAPS_PER_ROW, others: Mapping[str, Sequence[str]] = SWAPS) -> list[tuple[frozenset[int], frozenset[int]]]:
    """For each sentence with an identity term, and each swap of it: the features that come and that go."""
    out: dict[tuple[frozenset[int], frozenset[int]], int] = {}
    for sentence in _SENTENCE.findall((text or "").lower()):
        found = set(_WORD.findall(sentence))
        for term in sorted(found & others.keys()):
            before, rest = feature_set(found), found - {term}
            for other in others[term]:
                after = feature_set(rest | {other})
                come, go = after - before, before - after
                out.setdefault((frozenset(come), frozenset(go)), zlib.crc32(repr((sorted(come), sorted(go))).encode()))
        if len(out) > _HELD_SWAPS * limit:
            out = dict(heapq.nsmallest(limit, out.items(), key=_by_hash))
    return [swap for swap, _ in heapq.nsmallest(limit, out.items(), key=_by_hash)] if len(out) > limit else list(out)


def _csr(rows: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    lengths = [len(r) for r in rows]
    flat = np.fromiter((f for r in rows for f in r), np.int64, sum(lengths))
    return np.repeat(np.arange(len(rows)), lengths), flat


@dataclass
class ToxicityModel:
    """Weights by bucket (those that are not 0) and the constant term."""

    weights: dict[int, float] = field(repr=False)
    bias: float

    def word_weights(self, word: str) -> tuple[int, ...]:
        return tuple(f for f in features(word) if f in self.weights)

    def scorer(self):
        """A function of texts that remembers the features of words it has met, up to a bound."""
        cache: dict[str, tuple[int, ...]] = {}

        def score(texts: Sequence[str | None]) -> np.ndarray:
            logits = np.empty(len(texts))
            for i, text in enumerate(texts):
                found = words(text)
                new = found.difference(cache)
                if len(cache) + len(new) > _CACHE_WORDS:
                    cache.clear()
                    new = found
                for word in new:
                    cache[word] = self.word_weights(word)
                hit = {f for word in found for f in cache[word]}
                logits[i] = self.bias + sum(self.weights[f] for f in sorted(hit))
            return 1 / (1 + np.exp(-np.clip(logits, -500, 500)))

        return score


def fit(
    rows: Sequence[Sequence[int]],
    labels: Sequence[int],
    pairs: Sequence[tuple[Iterable[int], Iterable[int]]] = (),
    sparsity: float = 2e-3,
    ridge: float = 1e-4,
    counterfactual: float = 1.0,
    rounds: int = 150,
) -> ToxicityModel:
    """Proximal gradient descent with momentum; ``pairs`` are the features that a swap adds and removes.

    Features of under ``LEAST_ROWS`` rows are not used. Without both classes the score is the share of
    toxic rows everywhere (0 without rows).
    """
    y = np.asarray(labels, np.float64)
    if not len(y) or y.min() == y.max():
        return ToxicityModel({}, 30.0 if len(y) and y[0] else -30.0)
    at, bucket = _csr([sorted(set(r)) for r in rows])
    used, column, counts = np.unique(bucket, return_inverse=True, return_counts=True)
    enough = counts >= LEAST_ROWS
    new = np.cumsum(enough) - 1
    at, column = at[enough[column]], new[column[enough[column]]]
    used = used[enough]
    place = {f: i for i, f in enumerate(used.tolist())}
    swap = [([place[f] for f in a if f in place], [place[f] for f in b if f in place]) for a, b in pairs]
    swap = [(a, b) for a, b in swap if a or b]
    s_at, s_column = _csr([[*a, *b] for a, b in swap])
    s_sign = np.array([1.0] * 0 + [v for a, b in swap for v in (*[1.0] * len(a), *[-1.0] * len(b))])
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    n = len(used)

    def descend(w: np.ndarray, bias: float, active: np.ndarray, l1: float, l2: float, turns: int) -> tuple[np.ndarray, float]:
        def gradient(w: np.ndarray, bias: float) -> tuple[np.ndarray, float]:
            margin = bias + np.bincount(at, w[column], len(y))
            error = weight * (1 / (1 + np.exp(-np.clip(margin, -500, 500))) - y)
            g = np.bincount(column, error[at], n) + l2 * w
            if len(swap):
                change = np.bincount(s_at, w[s_column] * s_sign, len(swap))
                g += 2 * counterfactual / len(swap) * np.bincount(s_column, change[s_at] * s_sign, n)
            return g * active, error.sum()

        # A bound on the curvature, by power iteration on the weighted features and the swaps.
        v = np.random.default_rng(5).normal(size=n + 1) * np.r_[active, 1]
        for _ in range(15):
            z = weight * (np.bincount(at, v[:n][column], len(y)) + v[n]) / 4
            u = np.r_[np.bincount(column, z[at], n) * active, z.sum()]
            if len(swap):
                c = np.bincount(s_at, v[:n][s_column] * s_sign, len(swap)) * 2 * counterfactual / len(swap)
                u[:n] += np.bincount(s_column, c[s_at] * s_sign, n) * active
            size = np.linalg.norm(u)
            v = u / max(size, 1e-12)
        step = 1 / (1.1 * size + l2 + 1e-9)
        wz, bz, t = w.copy(), bias, 1.0
        for _ in range(turns):
            gw, gb = gradient(wz, bz)
            raw = wz - step * gw
            w_new = np.maximum(raw - step * l1, 0) * active  # evidence only adds up: no word excuses another
            b_new = bz - step * gb
            t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
            wz, bz = w_new + (t - 1) / t_new * (w_new - w), b_new + (t - 1) / t_new * (b_new - bias)
            w, bias, t = w_new, b_new, t_new
        return w, bias

    w, bias = descend(np.zeros(n), 0.0, np.ones(n), sparsity, ridge, rounds)
    # What the sparsity penalty has kept is trained on without it, as it shrinks the weights.
    w, bias = descend(w, bias, (w != 0).astype(float), 0.0, ridge, rounds)
    return ToxicityModel({int(f): float(v) for f, v in zip(used, w, strict=True) if v}, float(bias))


def training_sample(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    per_class: int = ROWS_PER_CLASS,
    groups: Groups = IDENTITY_GROUPS,
) -> DataFrame:
    """``(label, kind, features)``: the sampled rows (kind 0) and the distinct swaps of labelled sentences (kind 1).

    About ``per_class`` labels of each class are chosen by a hash of the id, at most four times that in
    all; only those are joined to their texts. Swaps are taken from these and ``SWAP_ROWS`` times as many further
    labelled rows, as few rows hold a term. An id with several labels counts as toxic if one says so;
    of several rows of an id, the one of smallest text hash is taken.
    A swap has the features that it adds and, as ``-1 - feature``, those that it removes.
    """
    labels = labels.filter(F.col(label).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(label).alias(label))
    counts = {row[label]: row["count"] for row in labels.groupBy(label).count().collect()}
    rate = F.lit(0.0)
    for value, count in counts.items():
        rate = F.when(F.col(label) == value, per_class / count).otherwise(rate)
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit("toxicity sample")), F.lit(1 << 30)) / (1 << 30)
    ranked = labels.withColumn("_draw", draw).withColumn("_own", draw < rate).orderBy("_draw", id_col)
    chosen = ranked.filter("_own").limit(4 * per_class).union(ranked.filter("NOT _own").limit(SWAP_ROWS * per_class))
    chosen = chosen.select(id_col, F.col(label).cast("int").alias("label"), F.col("_own").alias("own"))
    others = swaps_of(groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, list[int]]] = []
            for t, y, own in zip(*(batch.column(c).to_pylist() for c in (text, "label", "own")), strict=True):
                if own:
                    out.append((y, 0, sorted(feature_set(words(t)))))
                out += [(0, 1, [*sorted(a), *(-1 - f for f in sorted(b))]) for a, b in swaps(t, others=others)]
            kinds = [pa.int32(), pa.int32(), pa.list_(pa.int32())]
            columns = [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["label", "kind", "features"])

    # The sample's bound is a parameter: (4 + SWAP_ROWS) * per_class rows of 13 bytes.
    found = docs.select(id_col, text).join(F.broadcast(chosen), id_col)
    found = found.groupBy(id_col, "label", "own").agg(F.min_by(text, F.xxhash64(text)).alias(text))
    sample = map_batches(found.select(text, "label", "own"), run, "label int, kind int, features array<int>")
    # Rows stay as they are, equal swaps are one.
    counted = sample.groupBy("label", "kind", "features").count()
    times = F.when(F.col("kind") == 0, F.col("count")).otherwise(1).cast("int")
    return counted.select("label", "kind", "features", F.explode(F.sequence(F.lit(1), times))).drop("col")


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic", per_class: int = ROWS_PER_CLASS, groups: Groups = IDENTITY_GROUPS, **penalties
) -> ToxicityModel:
    """Fit on a bounded sample of labelled rows; the driver holds their feature numbers, not their texts."""
    rows = training_sample(docs, labels, id_col, text, label, per_class, groups).collect()
    rows.sort(key=lambda r: (r["kind"], r["label"], r["features"]))
    own = [r for r in rows if not r["kind"]]
    pairs = {tuple(r["features"]) for r in rows if r["kind"]}
    split = [([f for f in p if f >= 0], [-1 - f for f in p if f < 0]) for p in sorted(pairs)]
    return fit([r["features"] for r in own], [r["label"] for r in own], split, **penalties)


def classify(df: DataFrame, model: ToxicityModel, text: str = "text", score: str = "score", predicted: str = "predicted") -> DataFrame:
    """Add the score of each whole text, 0 to 1, and whether it is at least 0.5.

    Null and empty texts have the score of a text without known words. Columns of these names are
    replaced. The model is broadcast; its size is bounded by the training sample.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = shared.value.scorer()
        for batch in batches:
            column = pa.RecordBatch.from_arrays([batch], ["text"])
            found = [scorer(part.column("text").to_pylist()) for part in slices(column, "text")]
            yield pa.array(np.concatenate([np.zeros(0), *found]))

    scored = df.drop(score, predicted).withColumn(score, of_column(spark, run, "double")(text))
    return scored.withColumn(predicted, (F.col(score) >= 0.5).cast("int"))
