"""The pipeline stage by stage against plain Python, with awkward rows and columns."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from starmill.llm import language_id, toxicity

CLASHES = "toxic string, severity int, lang_pred string, bits_per_byte int, row_id long, had_text int, kept string, spans int, whole int, gone_id long"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}"
VALUES = ("t", 1, "l", 2, 3, 4, "k", 5, 6, 7)


def prose(seed: int, n: int = 80) -> str:
    draw = random.Random(seed)
    syllables = ["the", "an", "tion", "re", "wh", "st", "ou", "ing", "of", "nd", "é"]
    return " ".join("".join(draw.choices(syllables, k=draw.randint(1, 4))) for _ in range(n))


PASSAGE = "€" * 40 + " ufffd� " + prose(99, 30)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sf")
    texts = [(i, prose(i) + (" idiot scum" * 2 if i % 4 == 0 else "")) for i in range(120)]
    texts += [
        (200, prose(1) + " more"), (201, None), (202, ""), (203, "12 34 !!"), (204, "a�b " + prose(7, 9)),
        (205, prose(50, 40) + PASSAGE), (206, "é" + PASSAGE + prose(51, 40)), (207, prose(52, 3000)),
        (208, prose(153)), (208, prose(153)), (None, prose(154)),
    ]
    rows = [(d, t, "en", "s", len(t or ""), *VALUES) for d, t in texts]
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 0, int(i % 4 == 0)) for i in range(100)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder), spark.read.parquet(f"{folder}/documents.parquet")


def key(r):
    return (r.doc_id is None, r.doc_id or 0, r.text or "")


def rows_of(df):
    return sorted(df.collect(), key=key)


def test_toxic_documents_go_and_all_columns_stay(spark, tables):
    folder, docs = tables
    kept = corpus_pipeline.drop_toxic(spark, docs, folder)
    assert kept.schema == docs.schema
    model = toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    scored = {(r.doc_id, r.toxic) for r in toxicity.score_severity(docs, model).collect()}
    assert {r.doc_id for r in kept.collect()} == {d for d, toxic in scored if not toxic}
    assert all(not (r.doc_id or 1) % 4 == 0 or r.doc_id >= 120 for r in kept.collect())
    assert all(tuple(r)[5:] == VALUES for r in kept.collect())


def test_texts_in_no_language_go(spark, tables):
    folder, docs = tables
    kept = corpus_pipeline.drop_unknown_languages(spark, docs, folder)
    assert kept.schema == docs.schema
    found = language_id.predict_languages(docs, language_id.learn(docs)).collect()
    good = [r for r in found if r.lang_pred != "und" and r.bits_per_byte <= corpus_pipeline.MAX_BITS_PER_BYTE]
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(r.doc_id or -1 for r in good)
    assert not {201, 202, 203} & {r.doc_id for r in kept.collect()}


def test_one_of_each_group_stays(spark, tables):
    folder, docs = tables
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, folder)
    assert kept.columns == docs.columns
    gone = set(docs.select("doc_id").distinct().collect()) - set(kept.select("doc_id").distinct().collect())
    assert {r.doc_id for r in gone} == {200} and kept.where("doc_id = 208").count() == 2


def plain_cuts(rows):
    """Bytes covered by 50-byte strings that also start in a document of smaller id."""
    starts: dict[bytes, int] = {}
    for r in rows:
        data = (r.text or "").encode()
        for i in range(len(data) - 49):
            s = data[i : i + 50]
            if r.doc_id is not None:
                starts[s] = min(starts.get(s, r.doc_id), r.doc_id)
    out = []
    for r in rows:
        data = (r.text or "").encode()
        gone = [False] * len(data)
        for i in range(len(data) - 49):
            first = starts.get(data[i : i + 50])
            if first is not None and r.doc_id is not None and first < r.doc_id:
                gone[i : i + 50] = [True] * 50
        text, at = [], 0
        for c in r.text or "":
            size = len(c.encode())
            if not any(gone[at : at + size]):
                text.append(c)
            at += size
        out.append((r.doc_id, None if r.text is None else "".join(text)))
    return out


def test_repeated_passages_are_cut_at_characters(spark, tables):
    folder, docs = tables
    docs = docs.where("doc_id is not null")
    docs.write.mode("overwrite").parquet(f"{folder}/named")
    docs = spark.read.parquet(f"{folder}/named")
    kept = corpus_pipeline.cut_repeated_passages(spark, docs, folder)
    assert kept.schema == docs.schema
    found = rows_of(kept)
    assert [(r.doc_id, r.text) for r in found] == [
        x for _, x in sorted(zip([key(r) for r in found], [(r.doc_id, r.text) for r in found]))
    ]
    expected = sorted(plain_cuts(docs.collect()), key=lambda x: (x[0], x[1] or ""))
    assert sorted([(r.doc_id, r.text) for r in found], key=lambda x: (x[0], x[1] or "")) == expected
    texts = dict(expected)
    assert texts[204].startswith("a�b") and texts[206].startswith("é")
    assert all(r.n_chars == len(r.text) for r in found if r.text is not None)
    assert all(tuple(r)[5:] == VALUES for r in found)


def test_empty_tables_stay_empty(spark, tables, tmp_path):
    folder, docs = tables
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{folder}/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    none = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).count() == 0


def test_run_is_its_stages_one_after_the_other(spark, tables):
    folder, docs = tables
    whole = corpus_pipeline.run(spark, folder)
    assert whole.where("doc_id % 4 = 0 and doc_id < 120").count() == 0
    assert {"doc_id", "sequence_id", "offset"} <= set(whole.columns)
    assert not {200, 201, 202, 203} & {r.doc_id for r in whole.select("doc_id").collect()}
