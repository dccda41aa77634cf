"""Severity of toxic language by cumulative-link ordinal regression."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import Carried, releasing


#: Labelled documents per value of the label that the model is fitted on.
TRAIN_DOCS = 6000
#: Sparse features kept, those that tell the labels apart best.
MAX_FEATURES = 4096
MIN_DOCS = 5
#: Lengths in bytes of the word beginnings that are features beside whole words.
PREFIXES = (4, 5, 6)
#: A feature seen in toxic documents at least this often is a marker; the share of
#: markers among the words of a toxic document decides between its grades.
MARKER_SHARE = 0.9
GRADES = 3
CACHED_WORDS = 300_000
#: Penalties tried, the share of the sample they are judged on, and steps of a trial.
PENALTIES = (2e-4, 1e-3, 5e-3, 2.5e-2)
HELD_EVERY, CHOICE_STEPS = 5, 150
_STRIP = b".,;:!?\"'()[]{}<>*#-_~|/\\"


def features_of(word: bytes) -> set[int]:
    """Hashed features of a word: itself and its beginnings."""
    word = word.strip(_STRIP)
    if len(word) < 3:
        return set()
    found = {zlib.crc32(b"w" + word)}
    return found | {zlib.crc32(b"p" + word[:n]) for n in PREFIXES if len(word) >= n}


def _words(text: bytes) -> list[bytes]:
    return text.split()


@dataclass
class SeverityModel:
    """Weights shared by all thresholds: P(grade > k) = sigmoid(weights . x - thresholds[k])."""

    features: dict[int, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def probabilities(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for every score and threshold."""
        with np.errstate(over="ignore"):
            return 1.0 / (1.0 + np.exp(self.thresholds[None, :] - score[:, None]))


def fit_ordinal(
    rows: list[np.ndarray],
    grades: np.ndarray,
    n_features: int,
    n_grades: int = GRADES,
    l2: float = 2e-4,
    steps: int = 400,
    rate: float = 0.1,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds of binary sparse rows, by full-batch Adam.

    ``rows`` hold the columns present in every document. The likelihood of grade g is
    F(b[g]) - F(b[g-1]) with F the logistic function at thresholds minus score.
    """
    lengths = np.array([len(r) for r in rows])
    columns = np.concatenate(rows).astype(int) if lengths.sum() else np.zeros(0, int)
    owner = np.repeat(np.arange(len(rows)), lengths)
    size = n_features + n_grades - 1
    x = np.zeros(size)
    x[n_features] = 1.0
    x[n_features + 1 :] = 0.5
    mean, square = np.zeros(size), np.zeros(size)
    n = len(rows)
    for step in range(1, steps + 1):
        weights, raw = x[:n_features], x[n_features:]
        gaps = np.exp(raw[1:])
        bounds = raw[0] + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.bincount(owner, weights[columns], n)
        upper = _logistic(np.append(bounds, np.inf)[grades] - score)
        lower = _logistic(np.insert(bounds, 0, -np.inf)[grades] - score)
        mass = np.maximum(upper - lower, 1e-12)
        up, low = upper * (1 - upper) / mass, lower * (1 - lower) / mass
        # Derivatives of minus the mean log likelihood.
        by_score = (up - low) / n
        by_bound = np.zeros(n_grades + 1)
        np.add.at(by_bound, grades + 1, -up / n)
        np.add.at(by_bound, grades, low / n)
        by_bound = by_bound[1:n_grades]
        gradient = np.empty(size)
        gradient[:n_features] = np.bincount(columns, by_score[owner], n_features) + l2 * weights
        gradient[n_features] = by_bound.sum()
        gradient[n_features + 1 :] = np.cumsum(by_bound[::-1])[::-1][1:] * gaps
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        x -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    gaps = np.exp(x[n_features + 1 :])
    return x[:n_features], x[n_features] + np.concatenate([[0.0], np.cumsum(gaps)])


def _logistic(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1.0 / (1.0 + np.exp(-x))


def _extract(selected: dict[int, int] | None, markers: set[int] = frozenset()):
    """(toxic, features, share) of labelled texts: hashes or selected columns, and the
    features that are markers, one for each word they are in, as a share of the words."""
    schema = pa.schema(
        [("toxic", pa.int32()), ("features", pa.list_(pa.int64())), ("share", pa.float64())]
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features, shares = [], []
            for text in batch.column("data").to_pylist():
                words = _words(text)
                times = Counter(words)
                per_word = {w: features_of(w) for w in times}
                if selected is not None:
                    per_word = {
                        w: {selected[f] for f in fs if f in selected} for w, fs in per_word.items()
                    }
                features.append(sorted(set().union(*per_word.values())))
                marked = sum(n * len(per_word[w] & markers) for w, n in times.items())
                shares.append(marked / max(1, len(words)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("toxic").cast(pa.int32()),
                    pa.array(features, pa.list_(pa.int64())),
                    pa.array(shares, pa.float64()),
                ],
                schema=schema,
            )

    return extract


_EXTRACTED = "toxic int, features array<long>, share double"


def train(
    docs: DataFrame,
    labels: DataFrame,
    train_docs: int = TRAIN_DOCS,
    max_features: int = MAX_FEATURES,
) -> SeverityModel | None:
    """Fit on at most ``train_docs`` labelled documents of either label value.

    ``labels`` holds doc_id and toxic (0, 1 or null; the largest counts where an id
    repeats). The sample are the documents with the smallest hashed ids, whole texts.
    Grade 0 is a clean document; the toxic ones are halved by their share of marker
    words into grades 1 and 2. None when either label value is missing.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic")
    )
    # Every task hands on the smallest hashes it holds, so no task sorts a whole label.
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    halves = [known.where(F.col("toxic") == v).orderBy(*order).limit(train_docs) for v in (0, 1)]
    chosen = halves[0].union(halves[1])
    # At most 2 * train_docs ids.
    sample = docs.select(F.col("doc_id").cast("long"), _lower_utf8()).join(
        F.broadcast(chosen), "doc_id"
    ).select("toxic", "data")
    extracted = sample.mapInArrow(releasing(_extract(None)), _EXTRACTED)
    total = F.sum(F.lit(1))
    counted = (
        extracted.select("toxic", F.explode("features").alias("feature"))
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), total.alias("n"))
        .where(F.col("n") >= MIN_DOCS)
    )
    sizes = sample.agg(F.sum("toxic").alias("toxic"), total.alias("n")).first()
    if not sizes["n"] or sizes["toxic"] in (None, 0, sizes["n"]):
        return None
    expected = F.col("n") * (sizes["toxic"] / sizes["n"])
    contrast = F.pow(F.col("toxic") - expected, 2) / expected
    best = counted.orderBy(F.desc(contrast), "feature").limit(max_features).collect()
    selected = {row["feature"]: i for i, row in enumerate(best)}
    markers = {i for i, row in enumerate(best) if row["toxic"] >= MARKER_SHARE * row["n"]}
    rows = sample.mapInArrow(releasing(_extract(selected, markers)), _EXTRACTED).collect()
    rows.sort(key=lambda r: (r["toxic"], r["features"], r["share"]))
    toxic = np.array([r["toxic"] for r in rows])
    share = np.array([r["share"] for r in rows])
    middle = np.median(share[toxic == 1])
    grades = np.where(toxic == 0, 0, np.where(share > middle, 2, 1))
    present = [np.array(r["features"], int) for r in rows]
    weights, thresholds = fit_ordinal(present, grades, len(best), l2=choose_l2(present, grades, len(best)))
    return SeverityModel(selected, weights, thresholds)


def choose_l2(rows: list[np.ndarray], grades: np.ndarray, n_features: int) -> float:
    """The penalty whose fit on most rows finds every fifth of the others likeliest."""
    held = np.arange(len(rows)) % HELD_EVERY == 0
    if not held.any() or held.all():
        return PENALTIES[-1]
    learned = [r for r, h in zip(rows, held) if not h]
    likely = []
    for l2 in PENALTIES:
        weights, bounds = fit_ordinal(learned, grades[~held], n_features, l2=l2, steps=CHOICE_STEPS)
        score = np.array([weights[r].sum() for r, h in zip(rows, held) if h])
        edges = np.concatenate([[-np.inf], bounds, [np.inf]])
        of = grades[held]
        mass = _logistic(edges[of + 1] - score) - _logistic(edges[of] - score)
        likely.append(np.log(np.maximum(mass, 1e-12)).mean())
    return PENALTIES[int(np.argmax(likely))]


def _lower_utf8():
    return F.coalesce(F.lower("text"), F.lit("")).cast("binary").alias("data")


SCORED = "doc_id long, severity double, grade int, toxic_probability double, toxic boolean"


def score_severity(docs: DataFrame, model: SeverityModel | None, keep: list[str] = ()) -> DataFrame:
    """doc_id, severity, grade, toxic_probability and toxic of every row, with the
    columns ``keep`` of ``docs``.

    ``severity`` is the expected grade from 0 to 2, ``grade`` the likeliest one and
    ``toxic`` whether a grade above 0 is at least as likely as grade 0. Presence of a
    feature counts, so that length alone never makes a document toxic. A null or empty
    text and any text without a model have severity 0; repeated rows are scored each.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    carried = Carried(docs, keep)
    rows = docs.select(F.col("doc_id").cast("long"), _lower_utf8(), *carried.columns)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        cache: dict[bytes, tuple] = {}
        for batch in batches:
            texts = batch.column("data").to_pylist()
            sums, empty = np.zeros(len(texts)), np.ones(len(texts), bool)
            for i, text in enumerate(texts if model else []):
                words = set(_words(text))
                new = words.difference(cache)
                if len(cache) + len(new) > CACHED_WORDS:
                    cache.clear()
                    new = words
                for w in new:
                    cache[w] = tuple(model.features[f] for f in features_of(w) if f in model.features)
                present = set().union(*filter(None, map(cache.__getitem__, words)))
                sums[i], empty[i] = model.weights[sorted(present)].sum(), not words
            if model is None:
                above = np.zeros((len(texts), GRADES - 1))
            else:
                above = np.where(empty[:, None], 0.0, model.probabilities(sums))
            bounds = np.hstack([np.ones((len(texts), 1)), above, np.zeros((len(texts), 1))])
            columns = {
                "doc_id": batch.column("doc_id"),
                "severity": above.sum(axis=1),
                "grade": np.argmax(-np.diff(bounds, axis=1), axis=1).astype(np.int32),
                "toxic_probability": above[:, 0],
                "toxic": above[:, 0] >= 0.5,
            }
            yield pa.RecordBatch.from_pydict(columns | carried.of(batch))

    scored = rows.mapInArrow(releasing(score), carried.schema(SCORED))
    own = ["doc_id", "severity", "grade", "toxic_probability", "toxic"]
    return carried.renamed(scored, own)
