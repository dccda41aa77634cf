"""Spelling variants of words by permuterm rotations."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import OUT_ROWS, ship_package, stored

#: Code points and occurrences that make a run a word.
MIN_LETTERS, MIN_COUNT = 7, 2
#: One distinct run of a document in so many loses a code point.
DAMAGE = 31
#: A form occurs at least so many times as often as its variant.
RATIO = 10
#: Marks the end of a word in its rotations; no letter.
END = "$"
#: Distinct words that a task counts before it hands them on.
HELD = 1 << 18

_RUN = re.compile(f"[a-zÀ-ÿ]{{{MIN_LETTERS},}}")


def words_in(doc_id: int | None, text: bytes) -> Iterator[tuple[str, int]]:
    """Words of a text, long enough, with their occurrences in it.

    Runs of Latin letters, A-Z in lower case. Where DAMAGE divides the checksum of
    ``<doc_id>:<run>`` the run loses the code point at the checksum modulo its length.
    A null doc_id counts as empty.
    """
    runs = Counter(_RUN.findall(text.lower().decode("utf-8", "replace")))
    name = b"%d:" % doc_id if doc_id is not None else b":"
    seed = zlib.crc32(name)
    for run, n in runs.items():
        code = zlib.crc32(run.encode(), seed)
        if code % DAMAGE == 0:
            at = code % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < MIN_LETTERS:
                continue
        yield run, n


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): words with at least MIN_COUNT occurrences over all whole texts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            words, counts = list(held), list(held.values())
            held.clear()
            for i in range(0, len(words), OUT_ROWS):
                yield pa.RecordBatch.from_pydict(
                    {"word": pa.array(words[i : i + OUT_ROWS], pa.string()),
                     "n": pa.array(counts[i : i + OUT_ROWS], pa.int64())}
                )

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, batch.column("text"), strict=True):
                for word, n in words_in(doc_id, text.as_py()):
                    held[word] += n
                if len(held) > HELD:
                    yield from flush()
        yield from flush()

    text = F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    words = rows.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return words.where(F.col("n") >= MIN_COUNT)


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, skipped, single, n): the rotations of ``word$`` that near words share.

    Rotating the code point after an edited one to the front puts the edited one last.
    With it set aside (``skipped``) the rotation is the prefix that words have in common
    which differ there, and the whole rotation of the word without it (``skipped`` empty).
    Of equal neighbouring letters only the first is ``single``: without any of them the
    word is the same.
    """
    marked = F.concat("word", F.lit(END))
    length = F.length("word")
    # substring counts from 1: the rotation behind letter i is marked[i + 1:] + marked[:i - 1].
    without = F.transform(
        F.sequence(F.lit(1), length),
        lambda i: F.struct(
            F.concat(F.substring(marked, i + 1, length), F.substring(marked, F.lit(1), i - 1)).alias("prefix"),
            F.substring("word", i, F.lit(1)).alias("skipped"),
            ((i == 1) | (F.substring("word", i, F.lit(1)) != F.substring("word", i - 1, F.lit(1)))).alias("single"),
        ),
    )
    whole = F.transform(
        F.sequence(F.lit(1), length + 1),
        lambda i: F.struct(
            F.concat(F.substring(marked, i, length + 1), F.substring(marked, F.lit(1), i - 1)).alias("prefix"),
            F.lit("").alias("skipped"),
            F.lit(True).alias("single"),
        ),
    )
    return words.select("n", F.inline(F.concat(without, whole)))


def word_of(prefix: str, skipped: str) -> str:
    """The word behind a rotation."""
    tail, head = prefix.split(END)
    return head + skipped + tail


_NEAR = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])


def _neighbours(group: list[tuple[str, str, bool, int]]) -> Iterator[tuple[str, str, int]]:
    """Near words within one prefix: letters replaced by each other, or left out."""
    words = [word_of(prefix, skipped) for prefix, skipped, _, _ in group]
    for i, (_, ours, single, _) in enumerate(group):
        for j, (_, theirs, other, n) in enumerate(group):
            if i == j:
                continue
            if (ours and theirs) or (not ours and other) or (not theirs and single):
                yield words[i], words[j], n


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): every pair of words one edit apart, both ways, once.

    Rotations meet by hash of their prefix and are sorted; a prefix holds one rotation
    per letter that was skipped and one whole word at most, so no group grows with the
    vocabulary, whatever the words.
    """
    dealt = rotations(words).repartition("prefix").sortWithinPartitions("prefix", "skipped")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        out: list[tuple] = []

        def made() -> pa.RecordBatch:
            columns = [pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), _NEAR, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, schema=_NEAR)

        for batch in batches:
            prefix = batch.column("prefix")
            # Only rows beside one of the same prefix need a look; the ends may continue.
            if len(batch) > 1:
                same = np.asarray(pa.compute.equal(prefix[1:], prefix[:-1]))
                beside = np.concatenate([[True], same]) | np.concatenate([same, [True]])
            else:
                beside = np.ones(len(batch), bool)
            wanted = batch.filter(pa.array(beside))
            columns = (wanted.column(c).to_pylist() for c in ("prefix", "skipped", "single", "n"))
            for row in zip(*columns, strict=True):
                if group and group[0][0] != row[0]:
                    if len(group) > 1:
                        out.extend(_neighbours(group))
                        if len(out) >= OUT_ROWS:
                            yield made()
                    group = []
                group.append(row)
        if len(group) > 1:
            out.extend(_neighbours(group))
        if out:
            yield made()

    return dealt.mapInArrow(scan, "word string, near string, near_n long")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word.

    ``n_near`` words are one inserted, deleted or replaced code point away. ``form`` is
    the one of them that occurs most, ties to the smallest in code-point order, if it
    occurs at least RATIO times as often, and ``form_n`` its count; ``root`` is where
    forms lead, the word itself without any. A null or empty text has no words, rows of
    equal doc_id and text count each, other columns are ignored; an empty table gives no
    rows.
    """
    ship_package(docs.sparkSession)
    words = stored(vocabulary(docs), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("rarity"), "near")).alias("best")
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    joined = words.join(near, "word", "left")
    often = -F.col("best.rarity")
    chosen = often >= RATIO * F.col("n")
    formed = stored(
        joined.select(
            "word",
            F.when(chosen, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(chosen, often).alias("form_n"),
        ),
        "word-forms",
    )
    roots = _roots(formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(steps: DataFrame) -> DataFrame:
    """(word, root) by doubling the steps taken until none leads on.

    Each step multiplies the count by RATIO, so there are as many as the largest count
    has digits, and rounds as many as their number has binary digits.
    """
    while True:
        steps = stored(steps, "word-roots")
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = steps.join(onward, "root", "left")
        if further.where(F.col("next").isNotNull()).isEmpty():
            return steps
        steps = further.select("word", F.coalesce("next", "root").alias("root"))
