"""Marginal document probabilities over all subword segmentations."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import stored, utf8, words_of
from starmill.llm.pieces import Trie, Vocabulary, expected_counts, marginals

#: Languages with scores of their own; all others share one more set.
MAX_MODELS = 12
#: The most frequent words, whose scores every task holds; the others are joined.
HEAD_WORDS = 100_000
#: The most frequent words that start the fit of the scores, and its steps over them.
#: One more step over all words of all documents follows.
FIRST_WORDS, FIRST_STEPS = 30_000, 8
#: Distinct words that a counting task holds before it hands them on.
COUNTED_AT_ONCE = 400_000
#: Stands for the end of a document; no word is empty.
END = b""
#: Words whose lattices are worked on together.
CHUNK = 2000


def count_words(docs: DataFrame, models: list[str]) -> DataFrame:
    """(word, n per model) of all documents with an end each; A-Z in lower case.

    Tasks count before they shuffle, so that a frequent word is a row per task.
    """
    schema = pa.schema([("model", pa.int32()), ("word", pa.binary()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, Counter] = {}

        def leave() -> Iterator[pa.RecordBatch]:
            for model, counter in counts.items():
                words, n = list(counter), list(counter.values())
                for a in range(0, len(words), 20_000):
                    some = words[a : a + 20_000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([model] * len(some), pa.int32()),
                            pa.array(some, pa.binary()),
                            pa.array(n[a : a + 20_000], pa.int64()),
                        ],
                        schema=schema,
                    )
            counts.clear()

        for batch in batches:
            for model, text in zip(
                batch.column("model").to_pylist(), batch.column("text"), strict=True
            ):
                counter = counts.setdefault(model, Counter())
                counter.update(words_of(text.as_py()))
                counter[END] += 1
            if sum(map(len, counts.values())) > COUNTED_AT_ONCE:
                yield from leave()
        yield from leave()

    rows = docs.select(_model_of(models).alias("model"), utf8().alias("text"))
    counted = rows.mapInArrow(count, "model int, word binary, n long")
    per_model = [
        F.sum(F.when(F.col("model") == m, F.col("n")).otherwise(0)).alias(f"n{m}")
        for m in range(len(models) + 1)
    ]
    return counted.groupBy("word").agg(F.sum("n").alias("n"), *per_model)


def _model_of(models: list[str]) -> Column:
    """The number of a document's model: by language, the last one for all the rest."""
    rest = F.lit(len(models))
    number = rest
    for i, name in enumerate(models):
        number = F.when(F.col("lang") == name, F.lit(i)).otherwise(number)
    return number


@dataclass
class LatticeModel:
    """A mixture of unigram models over words.

    Every model gives a word ``(max(n - discount, 0) + discount * kinds * lattice) / total``:
    the word as a piece of its own plus all its segmentations into vocabulary pieces,
    whose marginal probability is ``lattice``. A document's probability is the product
    over its words and its end, averaged over the models with their shares of documents.
    """

    pieces: list[bytes]
    log_probs: np.ndarray  # a row per piece, a column per model
    shares: np.ndarray
    totals: np.ndarray
    kinds: np.ndarray
    discounts: np.ndarray
    tokens: int  # all training tokens
    distinct: int  # distinct ones

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))

    def scores(self, words: list[bytes], counts: np.ndarray, trie: Trie) -> np.ndarray:
        """log10 probability of every word (b"" is the end) per model."""
        out = np.empty((len(words), len(self.shares)))
        for a in range(0, len(words), CHUNK):
            some = words[a : a + CHUNK]
            spelled = marginals([b" " + w for w in some], trie, self.log_probs)
            ends = [i for i, w in enumerate(some) if w == END]
            with np.errstate(divide="ignore"):
                whole = np.log(np.maximum(counts[a : a + CHUNK] - self.discounts, 0.0))
                spelled = spelled + np.log(self.discounts * self.kinds)
                # An end has no segmentation; one that was never seen counts as seen once.
                spelled[ends] = np.where(np.isneginf(whole[ends]), np.log(self.discounts), -np.inf)
            out[a : a + CHUNK] = np.logaddexp(whole, spelled) - np.log(self.totals)
        return out / np.log(10.0)


def train(docs: DataFrame, vocabulary: Vocabulary) -> tuple[LatticeModel, DataFrame]:
    """The model of ``docs`` (text, lang) and the table of its word counts.

    The counts cover all documents. The scores of the vocabulary are refitted to every
    language by expectation maximisation: a few steps over the most frequent words,
    then one over all of them, as a job whose tasks return one number per piece.
    """
    named = docs.where(F.col("lang").isNotNull()).groupBy("lang").count()
    models = [r["lang"] for r in named.orderBy(F.desc("count"), "lang").limit(MAX_MODELS).collect()]
    words = stored(count_words(docs, models), "word-counts")
    columns = [f"n{m}" for m in range(len(models) + 1)]
    facts = words.agg(
        F.count("*").alias("distinct"),
        F.sum("n").alias("tokens"),
        *[F.sum(c).alias(f"{c}_total") for c in columns],
        *[F.count_if(F.col(c) > 0).alias(f"{c}_kinds") for c in columns],
        *[F.count_if(F.col(c) == 1).alias(f"{c}_once") for c in columns],
        *[F.count_if(F.col(c) == 2).alias(f"{c}_twice") for c in columns],
        *[F.sum(F.when(F.length("word") == 0, F.col(c)).otherwise(0)).alias(f"{c}_docs") for c in columns],
    ).first()

    def numbers(kind: str) -> np.ndarray:
        return np.array([float(facts[f"{c}_{kind}"] or 0) for c in columns])

    once, twice = numbers("once"), numbers("twice")
    ends = numbers("docs")
    flat = np.repeat(vocabulary.log_probs[:, None], len(columns), axis=1)
    model = LatticeModel(
        vocabulary.pieces,
        flat,
        ends / ends.sum() if ends.sum() else np.full(len(columns), 1 / len(columns)),
        np.maximum(numbers("total"), 1.0),
        np.maximum(numbers("kinds"), 1.0),
        np.clip((once + 0.5) / (once + 2 * twice + 1.0), 0.1, 0.95),
        int(facts["tokens"] or 0),
        int(facts["distinct"]),
    )
    if facts["tokens"]:
        model.log_probs = _fitted(words, columns, vocabulary, flat)
    return model, words


def _fitted(words: DataFrame, columns: list[str], vocabulary: Vocabulary, log_probs: np.ndarray) -> np.ndarray:
    spelled = words.where(F.length("word") > 0).select("word", "n", *columns)
    often = spelled.orderBy(F.desc("n"), "word").limit(FIRST_WORDS).collect()
    head = [b" " + bytes(r["word"]) for r in often]
    # Every word counts once: what reaches the lattice is one discount per word.
    weights = np.array([[r[c] > 0 for c in columns] for r in often], float).reshape(-1, len(columns))
    for _ in range(FIRST_STEPS):
        total = sum(
            expected_counts(head[a : a + CHUNK], weights[a : a + CHUNK], vocabulary.trie, log_probs)
            for a in range(0, len(head), CHUNK)
        )
        log_probs = _normalised(total)
    sent = words.sparkSession.sparkContext.broadcast((vocabulary.trie, log_probs))

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, scores = sent.value
        total = np.zeros_like(scores)
        for batch in batches:
            texts = [b" " + w for w in batch.column("word").to_pylist()]
            n = np.column_stack([batch.column(c).to_numpy() > 0 for c in columns]).astype(float)
            for a in range(0, len(texts), CHUNK):
                total += expected_counts(texts[a : a + CHUNK], n[a : a + CHUNK], trie, scores)
        piece, model = np.nonzero(total)
        yield pa.RecordBatch.from_pydict(
            {"piece": piece.astype(np.int32), "model": model.astype(np.int32), "n": total[piece, model]}
        )

    found = spelled.select("word", *columns).mapInArrow(expect, "piece int, model int, n double")
    # One number per piece and model, whatever the number of documents.
    sums = found.groupBy("piece", "model").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros_like(log_probs)
    total[sums["piece"].to_numpy(int), sums["model"].to_numpy(int)] = sums["n"].to_numpy(float)
    return _normalised(total)


def _normalised(counts: np.ndarray) -> np.ndarray:
    return np.log((counts + 0.01) / (counts.sum(axis=0) + 0.01 * len(counts)))


def score_documents(
    docs: DataFrame,
    model: LatticeModel,
    words: DataFrame,
    vocabulary: Vocabulary,
    head_words: int = HEAD_WORDS,
) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every row of ``docs``.

    ``score`` is the log10 probability of the text under ``model``; ``base_score`` that
    of a smoothed unigram model over whole words. The most frequent ``head_words`` are
    looked up where the text is; occurrences of all other words meet their counts in a
    shuffle, which computes the lattice of every word once and sums up per row.

    A null or empty text is an end alone. Repeated rows are scored each. ``docs`` must
    be a table that is read the same way again, as rows are told apart by their place.
    """
    session = docs.sparkSession
    columns = [f"n{m}" for m in range(len(model.shares))]
    # The end comes first: every text has one, however small the head.
    often = words.orderBy(F.length("word") > 0, F.desc("n"), "word").limit(head_words).toArrow()
    head = often.column("word").to_pylist()
    counts = np.column_stack([often.column(c).to_numpy() for c in columns]).astype(float)
    base = model.base(often.column("n").to_numpy().astype(float))
    table = np.column_stack([base, model.scores(head, counts, vocabulary.trie)])
    if END not in head:  # nothing was learned
        end = model.scores([END], np.zeros((1, len(columns))), vocabulary.trie)
        head, table = [*head, END], np.vstack([table, [model.base(np.zeros(1))[0], *end[0]]])
        known_from = len(head) - 1
    else:
        known_from = len(head)
    sent = session.sparkContext.broadcast((head, table.astype(float), known_from))
    sums = ["base", *(f"s{m}" for m in range(len(columns)))]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, table, known_from = sent.value
        index = _Index(zip(head, range(len(head)), strict=True))
        for batch in batches:
            out: list[tuple] = []
            for text in batch.column("text"):
                found = words_of(text.as_py())
                found.append(END)
                at = np.fromiter(map(index.__getitem__, found), np.int64, len(found))
                here = at[at >= 0]
                rare = Counter(w for w, i in zip(found, at.tolist()) if i < 0)
                out.append(
                    (
                        len(found),
                        int((here < known_from).sum()),
                        table[here].sum(axis=0),
                        list(rare),
                        list(rare.values()),
                    )
                )
            tokens, known, values, rare, often = zip(*out, strict=True)
            values = np.array(values)
            yield pa.RecordBatch.from_pydict(
                {
                    "row_id": batch.column("row_id"),
                    "doc_id": batch.column("doc_id"),
                    "n_tokens": np.array(tokens, np.int64),
                    "n_known": np.array(known, np.int64),
                    **{name: values[:, i] for i, name in enumerate(sums)},
                    "words": pa.array(rare, pa.list_(pa.binary())),
                    "times": pa.array(often, pa.list_(pa.int32())),
                }
            )

    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long"), utf8().alias("text")
    )
    schema = (
        "row_id long, doc_id long, n_tokens long, n_known long, "
        + ", ".join(f"{s} double" for s in sums)
        + ", words array<binary>, times array<int>"
    )
    partly = stored(rows.mapInArrow(look_up, schema), "scored-frequent-words")
    rare = (
        partly.select("row_id", F.explode(F.arrays_zip("words", "times")).alias("x"))
        .select("row_id", F.col("x.words").alias("word"), F.col("x.times").alias("times"))
        .join(words, "word", "left")
        .sortWithinPartitions("word")
    )
    sent_model = session.sparkContext.broadcast((model, vocabulary.trie))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, trie = sent_model.value
        for batch in batches:
            texts = batch.column("word").to_pylist()
            first = np.flatnonzero([i == 0 or texts[i] != texts[i - 1] for i in range(len(texts))])
            owner = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(texts))))
            n = np.column_stack([_numbers(batch, c)[first] for c in ["n", *columns]])
            scores = model.scores([texts[i] for i in first], n[:, 1:], trie)
            times = batch.column("times").to_numpy().astype(float)
            every = np.column_stack([model.base(n[:, 0]), scores])[owner] * times[:, None]
            yield pa.RecordBatch.from_pydict(
                {
                    "row_id": batch.column("row_id"),
                    "known": np.where(n[owner, 0] > 0, times, 0).astype(np.int64),
                    **{f"{s}_rare": every[:, i] for i, s in enumerate(sums)},
                }
            )

    spelled = rare.mapInArrow(
        spell, "row_id long, known long, " + ", ".join(f"{s}_rare double" for s in sums)
    )
    added = spelled.groupBy("row_id").agg(
        F.sum("known").alias("known"), *[F.sum(f"{s}_rare").alias(f"{s}_rare") for s in sums]
    )
    whole = partly.drop("words", "times").join(added, "row_id", "left")
    both = {s: F.col(s) + F.coalesce(f"{s}_rare", F.lit(0.0)) for s in sums}
    # log10 of the mixture, from its largest part.
    parts = [
        both[f"s{m}"] + F.lit(float(np.log10(share)))
        for m, share in enumerate(model.shares)
        if share > 0
    ]
    most = F.greatest(*parts) if len(parts) > 1 else parts[0]
    used = [(m, float(np.log10(share))) for m, share in enumerate(model.shares) if share > 0]
    terms = [F.pow(F.lit(10.0), F.col(f"s{m}") + share - F.col("most")) for m, share in used]
    return whole.select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        both["base"].alias("base_score"),
        most.alias("most"),
        *[both[f"s{m}"].alias(f"s{m}") for m in range(len(columns))],
    ).select(
        "doc_id",
        "n_tokens",
        "n_known",
        "base_score",
        (F.col("most") + F.log10(sum(terms, F.lit(0.0)))).alias("score"),
    )


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A count column, 0 where a word was never counted."""
    return batch.column(name).fill_null(0).to_numpy(zero_copy_only=False).astype(float)


class _Index(dict):
    """Numbers of words, -1 for those it lacks."""

    def __missing__(self, word: bytes) -> int:
        return -1
