"""Words of texts by a table function, without the texts in a shuffle."""

from __future__ import annotations

from starmill.sources.sql_functions import register_functions

TEXTS = [(1, "Ab abc, abc-ABCD 12345"), (1, "Ab abc, abc-ABCD 12345"), (2, "  "), (3, None), (4, "Kelvin été")]


def found(spark, min_chars):
    register_functions(spark)
    spark.createDataFrame(TEXTS, "id long, body string").createOrReplaceTempView("word_texts")
    return spark.sql(
        "SELECT id, word FROM word_texts AS texts, LATERAL words(texts.body, :min_chars)",
        {"min_chars": min_chars},
    )


def test_words_stay_in_the_scan_of_the_texts(spark):
    plan = found(spark, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" in plan
    assert "Join" not in plan and "Exchange" not in plan


def test_words_of_repeated_empty_and_null_texts(spark):
    assert sorted(map(tuple, found(spark, 3).collect())) == sorted(
        [(1, w) for w in ("abc", "abc", "abcd", "12345")] * 2 + [(4, "elvin")]
    )
    least = [tuple(r) for r in found(spark, 0).collect() if r.id == 4]
    assert sorted(least) == [(4, "elvin"), (4, "t")]
    assert found(spark, None).count() == 0
