"""The operators as named queries over whole tables, with their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm import (
    cross_polytope,
    language_id,
    line_dedup,
    lm_scoring,
    near_dedup,
    packing,
    pieces,
    pivot_simhash,
    prefix_trie,
    sampling,
    spelling,
    suffix_dedup,
    toxicity,
    vector_topk,
)
from starmill.llm.common import id_remainder, ship_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"
QUERY_STEP = 20


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query of this subpackage."""

    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op2_packing")
def op2_packing(spark, sf_dir):
    path = public_tokenizers.path(TOKENIZER)
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), path)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query("op7_cross_polytope")
def op7_cross_polytope(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    vectors = rows.select("vec_id", F.col("embedding").alias("vector"))
    return cross_polytope.nearest_products(vectors, vectors.where(F.col("vec_id") % QUERY_STEP == 0))


VECTOR_TOP_K = """
    WITH whole AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scores AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda x: x[1] * x[2])) AS BIGINT) AS score
        FROM whole q JOIN whole c
          ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
    )
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
               AS rank, vec_id, score
    FROM scores
    QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""


@query("op10_vector_file", VECTOR_TOP_K)
def op10_vector_file(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").where(vector_topk.usable(F.col("embedding")))
    vectors = rows.select("vec_id", vector_topk.scaled(F.col("embedding"), 64).alias("vector"))
    return vector_topk.top_k_products(vectors, vectors.where(F.col("vec_id") % QUERY_STEP == 0))


@query("op9_language_id")
def op9_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(id_remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    trees = language_id.learn(docs.where(~held_out))
    found = language_id.predict_languages(docs, trees)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits_per_byte")


@query("op3_toxicity")
def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_severity(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


LINE_DEDUP = r"""
    WITH lines AS (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               unnest(range(len(string_split(text, chr(10))))) AS number
        FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
    ), cut AS (
        SELECT doc_id, number, CASE WHEN length(line) < 40 THEN [line]
            ELSE regexp_extract_all(line, '.{20,}?(?:[.!?]+[ \t]+|[。！？]+)|.+', 0, 's') END AS parts
        FROM lines
    ), joined AS (
        SELECT doc_id, number, CASE WHEN len(parts) > 1 AND length(parts[-1]) < 20
            THEN list_append(parts[:-3], parts[-2] || parts[-1]) ELSE parts END AS parts
        FROM cut
    ), pieces AS (
        SELECT doc_id, number, unnest(parts) AS piece, unnest(range(len(parts))) AS place,
               len(parts) - 1 AS last FROM joined
    ), units AS (
        SELECT doc_id, length(piece) AS size, regexp_extract_all(lower(piece), '[\p{L}\p{M}\p{N}_]+') AS words,
               CAST(row_number() OVER upto - 1 AS INTEGER) AS unit,
               SUM(length(piece) + CASE WHEN place = last THEN 1 ELSE 0 END) OVER upto
                   - CASE WHEN place = last THEN 1 ELSE 0 END AS after
        FROM pieces WINDOW upto AS (PARTITION BY doc_id ORDER BY number, place ROWS UNBOUNDED PRECEDING)
    ), ranked AS (
        SELECT *, min(struct_pack(d := doc_id, u := unit)) OVER (PARTITION BY array_to_string(words, ' ')) AS first
        FROM units WHERE len(words) >= 1
    )
    SELECT doc_id, unit, CAST(after - size AS INTEGER) AS start, CAST(after AS INTEGER) AS "end",
           first.d AS first_doc_id, first.u AS first_unit
    FROM ranked WHERE doc_id <> first.d OR unit <> first.u
"""


@query("op4_line_dedup", LINE_DEDUP)
def op4_line_dedup(spark, sf_dir):
    return line_dedup.repeated_units(table(spark, sf_dir, "documents"), by="sentence")


@query("op1_lattice_likelihood")
def op1_lattice_likelihood(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(id_remainder(F.col("doc_id"), 5) == 1, F.lit(False))
    vocabulary = pieces.read_vocabulary(public_tokenizers.path(PIECES))
    model, words = lm_scoring.train(docs.where(~held_out), vocabulary)
    scored = lm_scoring.score_documents(docs, model, words, vocabulary)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


@query("op5_setsketch_near_duplicates")
def op5_setsketch_near_duplicates(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op6_suffix_dedup")
def op6_suffix_dedup(spark, sf_dir):
    kept = suffix_dedup.remove_repeated_passages(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op8_gumbel_segmentations")
def op8_gumbel_segmentations(spark, sf_dir):
    vocabulary = pieces.read_vocabulary(public_tokenizers.path(PIECES))
    drawn = sampling.sample_segmentations(table(spark, sf_dir, "documents"), vocabulary)
    return drawn.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query("op11_pivot_simhash")
def op11_pivot_simhash(spark, sf_dir):
    return pivot_simhash.simhash_components(table(spark, sf_dir, "documents"))


@query("op12_prefix_trie")
def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query("op13_spelling_variants")
def op13_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))
