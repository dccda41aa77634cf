"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm import language_id, near_dedup, packing, suffix_dedup, toxicity
from starmill.llm.common import ship_package, stored

#: A text whose best model still needs more bits for a byte is in none of the languages.
MAX_BITS_PER_BYTE = 7.0
#: Word shingles and similarity of near duplicates.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def _carried(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """What a model reads of documents, beside all their columns under names of our own,
    so that no column of theirs meets one of the model's."""
    names = [f"carried_{i}" for i in range(len(docs.columns))]
    own = [F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)]
    return docs.select("doc_id", "text", "lang", *own), names


def _restored(rows: DataFrame, names: list[str], docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model, fitted on the labelled ones, finds not toxic.

    A null or empty text is not toxic, nor is any text without both kinds of labels.
    Repeated rows stay or go alike; extra columns pass whatever their names; an empty
    table stays empty.
    """
    ship_package(spark)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows, names = _carried(docs)
    return _restored(toxicity.score_severity(rows, model, names).where(~F.col("toxic")), names, docs)


def drop_unknown_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters that read like one of the learned languages.

    Null and empty texts and those without a letter go, and all of them where no document
    names a language. Repeated rows stay or go alike; extra columns pass whatever their
    names; an empty table stays empty.
    """
    ship_package(spark)
    rows, names = _carried(docs)
    known = language_id.predict_languages(rows, language_id.learn(docs), names)
    readable = F.col("bits_per_byte") <= MAX_BITS_PER_BYTE
    known = known.where((F.col("lang_pred") != language_id.UNDETERMINED) & readable)
    return _restored(known, names, docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near duplicates.

    Texts without words and rows without doc_id stay; rows that repeat a doc_id stay or
    go alike; extra columns pass whatever their names; an empty table stays empty.
    """
    ship_package(spark)
    found = near_dedup.near_duplicates(docs, SHINGLE_WORDS, SIMILAR_PERCENT)
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("gone_id")).distinct()
    gone = gone.hint("merge")
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that start in an earlier one; ``n_chars`` follows.

    A character that is cut in two goes as a whole, all others stay as they are. A
    document may end up empty; it stays, since nothing of it was wrong. A null text stays
    null. Rows without doc_id stay whole unless an earlier document holds a passage of
    theirs; extra columns pass whatever their names; an empty table stays empty.
    """
    ship_package(spark)
    found = suffix_dedup.remove_repeated_passages(docs).select("row_id", "spans")
    found = found.where(F.size("spans") > 0)
    rows, names = _carried(docs)
    rows = rows.select(F.monotonically_increasing_id().alias("row_id"), "text", *names)
    cut = rows.hint("merge").join(found, "row_id", "left")
    without = F.udf(suffix_dedup.without_spans, "string", useArrow=True)
    cut = cut.withColumn("whole", without("text", "spans"))
    new = {names[docs.columns.index("text")]: F.col("whole")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new[names[docs.columns.index("n_chars")]] = F.length("whole").cast(kind)
    return _restored(cut.withColumns(new), names, docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of all remaining documents."""
    ship_package(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language ID", drop_unknown_languages),
    ("MinHash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", cut_repeated_passages),
    ("packing", pack),
]

#: Learned models and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
