"""Language identification by prediction by partial matching over bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import Carried, releasing
from starmill.llm.shingles import text_bytes

UNDETERMINED = "und"
#: Longest context in bytes.
MAX_ORDER = 3
#: Labelled documents per language that the statistics are taken from, whole texts.
TRAIN_DOCS = 300
#: Labelled documents that all languages share, once there are so many that each gets fewer.
TRAIN_TOTAL = 9600
#: Positions worked on at once, so that a long text needs no more memory.
WINDOW = 1 << 18


def grams(data: np.ndarray, length: int) -> np.ndarray:
    """Every run of ``length`` bytes as one number, the last byte lowest."""
    n = len(data) - length + 1
    keys = data[:n].astype(np.uint32) if n > 0 else np.zeros(0, np.uint32)
    for i in range(1, length):
        keys = (keys << np.uint32(8)) | data[i : i + n]
    return keys


class Lookup:
    """Rows of known keys: one slot per hash value, what collides in a sorted rest."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(4 * len(keys)).bit_length())
        self._shift = np.uint32(32 - min(bits, 30))
        slot = self._slot(keys)
        self._keys = np.zeros(1 << min(bits, 30), np.uint32)
        self._rows = np.full(len(self._keys), -1, np.int32)
        taken, first = np.unique(slot, return_index=True)
        self._keys[taken], self._rows[taken] = keys[first], first
        rest = np.setdiff1d(np.arange(len(keys)), first)
        order = rest[np.argsort(keys[rest])]
        self._rest, self._rest_rows = keys[order], order.astype(np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint32) * np.uint32(2654435761)) >> self._shift

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of every key, -1 for unknown ones."""
        slot = self._slot(keys)
        rows = self._rows[slot]
        wrong = np.flatnonzero((self._keys[slot] != keys) | (rows < 0))
        rows[wrong] = -1
        if len(self._rest) and len(wrong):
            at = np.minimum(np.searchsorted(self._rest, keys[wrong]), len(self._rest) - 1)
            hit = self._rest[at] == keys[wrong]
            rows[wrong[hit]] = self._rest_rows[at[hit]]
        return rows


@dataclass
class ContextTrees:
    """Frozen statistics of all languages, ready for scoring.

    ``keys[o]`` are the known runs of a context of ``o`` bytes and its symbol, with the
    code length in bits of that symbol per language in ``bits[o]``; ``contexts[o]`` and
    ``escapes[o]`` hold what leaving a known context costs. A language that does not
    know a context passes to the shorter one for free.
    """

    languages: list[str]
    keys: list[np.ndarray]
    bits: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]

    @staticmethod
    def of(counts: pd.DataFrame) -> ContextTrees:
        """From columns lang, context (its order), gram, n."""
        languages = sorted(counts["lang"].unique())
        column = {name: i for i, name in enumerate(languages)}
        keys, bits, contexts, escapes = [], [], [], []
        for order in range(MAX_ORDER + 1):
            part = counts[counts["context"] == order]
            known, row = np.unique(part["gram"].to_numpy(np.uint32), return_inverse=True)
            n = np.zeros((len(known), len(languages)))
            np.add.at(n, (row, part["lang"].map(column).to_numpy(int)), part["n"].to_numpy(float))
            context, of = np.unique(known >> np.uint32(8), return_inverse=True)
            total = np.zeros((len(context), len(languages)))
            kinds = np.zeros_like(total)
            np.add.at(total, of, n)
            np.add.at(kinds, of, n > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, np.log2((total + kinds) / kinds), 0.0)
                seen = np.log2((total + kinds)[of] / n)
            if order == 0:
                shorter = np.full_like(n, 8.0)
            else:
                low = np.uint32((1 << (8 * order)) - 1)
                shorter = bits[-1][np.searchsorted(keys[-1], known & low)]
            keys.append(known)
            bits.append(np.where(n > 0, seen, escape[of] + shorter))
            contexts.append(context)
            escapes.append(escape)
        return ContextTrees(languages, keys, bits, contexts, escapes)

    def prepare(self) -> None:
        """Build the lookups; they are not sent to the tasks."""
        self._find = [Lookup(k) for k in self.keys]
        self._leave = [Lookup(c) for c in self.contexts]

    def code_lengths(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Bits per language of every text; text i is ``data[starts[i]:starts[i + 1]]``."""
        total = np.zeros((len(starts) - 1, len(self.languages)))
        for begin in range(int(starts[0]), int(starts[-1]), WINDOW):
            end = min(begin + WINDOW, int(starts[-1]))
            first = int(np.searchsorted(starts, begin, side="right")) - 1
            last = int(np.searchsorted(starts, end, side="left"))
            cuts = np.clip(starts[first : last + 1], begin, end)
            text = np.repeat(np.arange(first, last), np.diff(cuts))
            depth = np.minimum(np.arange(begin, end) - starts[text], MAX_ORDER)
            self._add(total, data, np.arange(begin, end), text, depth)
        return total

    def _add(self, total, data, at, text, depth) -> None:
        for order in range(MAX_ORDER, -1, -1):
            now = depth >= order
            here = at[now] if not now.all() else at
            if not len(here):
                continue
            base = here[0] - order
            key = grams(data[base : here[-1] + 1], order + 1)[here - here[0]]
            rows = self._find[order].find(key)
            hit = rows >= 0
            docs = text[now] if len(here) < len(at) else text
            self._sum(total, docs[hit], self.bits[order][rows[hit]])
            missed = ~hit
            left = self._leave[order].find(key[missed] >> np.uint32(8))
            known = left >= 0
            self._sum(total, docs[missed][known], self.escapes[order][left[known]])
            # Still to be coded: what was missed here, and what had no such context.
            rest = np.ones(len(at), bool)
            rest[np.flatnonzero(now)[hit]] = False
            at, text, depth = at[rest], text[rest], np.minimum(depth[rest], order - 1)
        if len(at):
            np.add.at(total, text, 8.0)

    @staticmethod
    def _sum(total: np.ndarray, text: np.ndarray, bits: np.ndarray) -> None:
        """Add rows of bits to their texts, which come in ascending order."""
        if len(text):
            start = np.flatnonzero(np.diff(text, prepend=-1))
            total[text[start]] += np.add.reduceat(bits, start, axis=0)


def _lower_bytes():
    return F.coalesce(F.lower("text"), F.lit("")).cast("binary").alias("data")


def learn(
    labelled: DataFrame, train_docs: int = TRAIN_DOCS, train_total: int = TRAIN_TOTAL
) -> ContextTrees | None:
    """Context statistics of every language, from at most ``train_docs`` documents each.

    ``labelled`` holds doc_id, text, lang. The documents are those with the smallest
    hashed ids; their whole texts count. Many languages share ``train_total`` documents,
    at least one each. None when nothing is labelled.
    """
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    languages = rows.agg(F.count_distinct("lang")).first()[0]
    each = max(1, min(train_docs, train_total // max(languages, 1)))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    # At most the larger of train_total ids and one per language.
    chosen = (
        rows.select("doc_id", "lang")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= each)
        .select("doc_id", "lang")
        .distinct()
    )
    rows = rows.select("doc_id", "lang", _lower_bytes()).join(F.broadcast(chosen), ["doc_id", "lang"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = text_bytes(batch, "data")
            found: dict[tuple, list] = {}
            for lang, a, b in zip(batch.column("lang").to_pylist(), starts[:-1], starts[1:]):
                for context in range(MAX_ORDER + 1):
                    found.setdefault((lang, context), []).append(grams(data[a:b], context + 1))
            for (lang, context), keys in found.items():
                gram, n = np.unique(np.concatenate(keys), return_counts=True)
                if len(gram):
                    yield pa.RecordBatch.from_pydict(
                        {
                            "lang": [lang] * len(gram),
                            "context": np.full(len(gram), context, np.int32),
                            "gram": gram.astype(np.int64),
                            "n": n.astype(np.int64),
                        }
                    )

    counted = (
        rows.mapInArrow(releasing(count), "lang string, context int, gram long, n long")
        .groupBy("lang", "context", "gram")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    return ContextTrees.of(counted) if len(counted) else None


PREDICTED = "doc_id long, lang_pred string, score double, bits_per_byte double"


def predict_languages(docs: DataFrame, trees: ContextTrees | None, keep: list[str] = ()) -> DataFrame:
    """doc_id, lang_pred, score and bits_per_byte of every row, with the columns ``keep``.

    The language with the shortest exact code for the whole lower-cased text wins, ties
    by name; ``score`` is its share when the code lengths are read as likelihoods with
    equal priors. A null text, one without a letter, or no learned language give
    ``und`` with score 0 and no bits_per_byte. Repeated rows are predicted each; only
    ``text`` is looked at.
    """
    session = docs.sparkSession
    sent = session.sparkContext.broadcast(trees)
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has_letter")
    carried = Carried(docs, keep)
    rows = docs.select(F.col("doc_id").cast("long"), letters, _lower_bytes(), *carried.columns)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = sent.value
        if trees is not None:
            trees.prepare()
        for batch in batches:
            data, starts = text_bytes(batch, "data")
            size = np.diff(starts)
            known = np.array(batch.column("has_letter").to_pylist(), bool)
            if trees is None:
                known[:] = False
                names, best, score = [UNDETERMINED], np.zeros(len(size), int), np.zeros(len(size))
                bits = np.zeros((len(size), 1))
            else:
                names = trees.languages
                bits = trees.code_lengths(data, starts)
                best = np.argmin(bits, axis=1)
                less = bits.min(axis=1, keepdims=True) - bits
                score = 1.0 / np.exp2(np.maximum(less, -1000.0)).sum(axis=1)
            rate = bits[np.arange(len(best)), best] / np.maximum(size, 1)
            columns = {
                "doc_id": batch.column("doc_id"),
                "lang_pred": [names[b] if k else UNDETERMINED for b, k in zip(best, known)],
                "score": np.where(known, score, 0.0),
                "bits_per_byte": pa.array(rate, mask=~known),
            }
            yield pa.RecordBatch.from_pydict(columns | carried.of(batch))

    found = rows.mapInArrow(releasing(predict), carried.schema(PREDICTED))
    return carried.renamed(found, ["doc_id", "lang_pred", "score", "bits_per_byte"])
