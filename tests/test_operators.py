"""Operators: exact results under skew, nulls and any partitioning."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starmill.operators.dedup import dedup_by_key
from starmill.operators.joins import hot_keys, lookup_join, with_group_size
from starmill.operators.keywords import clean_tokens, rank_keywords
from starmill.operators.moments import Moments, centred, overall_mean
from starmill.operators.profile import clean_counts, profile_table, sample_rows
from starmill.operators.ranking import share_of_total, top_k_per_group, top_n
from starmill.operators.split import in_train
from tests.conftest import plan, rows


@pytest.fixture
def skewed(spark):
    """900 rows: a third on one key, a third without key, the rest on single keys."""
    n = F.col("id")
    key = F.when(n < 300, F.lit(-1)).when(n >= 600, n)
    return spark.range(900).select(n.alias("row"), key.alias("key")).repartition(5)


@pytest.fixture
def lookup(spark):
    """Names for the hot key and for every second single key."""
    hot = spark.createDataFrame([(-1, "hot")], "key bigint, name string")
    rest = spark.range(0, 900, 2).select(F.col("id").alias("key"), F.lit("cold").alias("name"))
    return hot.union(rest)


def test_hot_keys_are_those_above_their_share(skewed):
    assert rows(hot_keys(skewed, "key", parts=100, min_rows=1)) == [(-1,)]
    assert rows(hot_keys(skewed, "key", parts=3, min_rows=1)) == [(-1,)]
    assert len(rows(hot_keys(skewed, "key", parts=100_000, min_rows=1))) == 301
    assert rows(hot_keys(skewed, "key", parts=100)) == []


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("parts", [1, 100, 100_000])
def test_lookup_join_equals_a_plain_join(skewed, lookup, how, parts):
    ours = lookup_join(skewed, lookup, "key", how, parts, min_rows=1)
    ours = ours.select("row", "key", "name")
    plain = skewed.join(lookup, "key", how).select("row", "key", "name")
    assert sorted(map(repr, rows(ours))) == sorted(map(repr, rows(plain)))


def test_lookup_join_takes_no_other_kind(skewed, lookup):
    with pytest.raises(ValueError, match="inner or left"):
        lookup_join(skewed, lookup, "key", "full")


def test_the_facts_are_scanned_once_beside_their_keys(spark, lookup, tmp_path):
    """One pass over the key column for the hot keys, one over the facts."""
    facts = spark.range(50).select(F.col("id").alias("key"), F.col("id").alias("other"))
    facts.write.parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    joined = lookup_join(facts, lookup, "key", parts=1, min_rows=1)
    scans = [line for line in plan(joined).splitlines() if "FileScan parquet" in line]
    assert sum("other" in line for line in scans) == 1
    assert joined.count() == 25


def test_building_a_lookup_starts_no_job(spark, skewed, lookup):
    spark.sparkContext.setJobGroup("building", "")
    lookup_join(skewed, lookup, "key", "left")
    with_group_size(skewed, "key", "n")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("parts", [1, 100, 100_000])
def test_group_size(skewed, parts):
    sized = with_group_size(skewed, "key", "n", parts, min_rows=1)
    assert rows(sized.groupBy("n").count().orderBy("n")) == [(1, 300), (300, 300)]


def test_dedup_keeps_the_same_row_under_any_partitioning(spark):
    data = [("a", 1, "x"), ("a", 1, None), ("a", 1, "b"), (None, 1, "q"), (None, 1, "p"), ("b", 2, "z")]
    df = spark.createDataFrame(data, "k string, t int, v string")
    expected = {("a", 1, "b"), (None, 1, "q"), ("b", 2, "z")}
    for parts in (1, 3, 17):
        assert set(rows(dedup_by_key(df.repartition(parts), ["k", "t"]))) == expected


def test_dedup_trims_copies_ahead_of_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    text = plan(dedup_by_key(df, ["k"]))
    assert "row_number(), 1, Partial" in text
    assert text.count("Exchange hashpartitioning") == 1


def test_dedup_of_key_columns_only(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert sorted(rows(dedup_by_key(df, ["k"]))) == [(1,), (2,)]


def test_share_of_total_needs_no_single_task_window(spark):
    df = spark.range(30).groupBy((F.col("id") % 7).alias("g")).agg(F.count("*").alias("n"))
    shared = share_of_total(df, "n", "pct")
    assert abs(sum(r["pct"] for r in shared.collect()) - 100) < 0.1
    assert "Window" not in plan(shared)


def test_top_k_breaks_ties_by_key_and_trims_early(spark):
    data = [("g", "b", 5), ("g", "a", 5), ("g", "c", 9), ("h", "z", 1)]
    df = spark.createDataFrame(data, "g string, w string, n int")
    top = top_k_per_group(df, ["g"], [F.desc("n"), F.asc("w")], 2, "r")
    assert sorted(rows(top)) == [("g", "a", 5, 2), ("g", "c", 9, 1), ("h", "z", 1, 1)]
    assert "row_number(), 2, Partial" in plan(top)


def test_top_n_does_not_sort_everything(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v"))
    top = top_n(df, [F.desc("v")], 3)
    assert rows(top) == [(999,), (998,), (997,)]
    assert "TakeOrderedAndProject" in plan(top)


def test_moments_add_up_across_keys(spark):
    df = spark.range(500).select(
        (F.col("id") % 37).alias("k"), (F.col("id") * 13 % 5 + 1).cast("double").alias("x")
    )
    m = Moments("x")
    collapsed = df.groupBy("k").agg(*m.of("x")).withColumn("all", F.lit(1))
    two_steps = centred(collapsed, "all", m).groupBy("all").agg(m.mean(), m.stddev())
    one_step = df.agg(F.avg("x"), F.stddev_samp("x")).first()
    assert tuple(two_steps.first())[1:] == pytest.approx(tuple(one_step), rel=1e-12)


def test_moments_survive_a_large_offset(spark):
    df = spark.range(1000).select(
        (F.col("id") % 30).alias("k"), (F.col("id") % 3 + 1e9).alias("x"), F.lit(1).alias("all")
    )
    m = Moments("x")
    collapsed = df.groupBy("all", "k").agg(*m.of("x"))
    ours = centred(collapsed, "all", m).groupBy("all").agg(m.stddev().alias("s")).first()["s"]
    # Exact without the offset; the built-in itself is off by 1e-9 with it.
    exact = df.agg(F.stddev_samp(F.col("x") - 1e9)).first()[0]
    assert ours == pytest.approx(exact, rel=1e-12)


@pytest.mark.parametrize("offset", [0, 3, 1e6])
def test_moments_around_one_centre(spark, offset):
    """One scalar centre for all groups gives each group's own deviation."""
    df = spark.range(900).select(
        (F.col("id") % 3).alias("g"), (F.col("id") % 50).alias("k"),
        (F.col("id") * 7 % 5 + F.col("id") % 3 + offset).cast("double").alias("x"),
    )
    m = Moments("x")
    collapsed = df.groupBy("g", "k").agg(*m.of("x"))
    ours = collapsed.groupBy("g").agg(m.stddev(overall_mean(collapsed, m)).alias("s")).orderBy("g")
    exact = df.groupBy("g").agg(F.stddev_samp(F.col("x") - offset).alias("s")).orderBy("g")
    assert [r[1] for r in rows(ours)] == pytest.approx([r[1] for r in rows(exact)], rel=1e-9)
    assert "Join" not in plan(ours)


def test_a_group_without_spread_around_one_centre(spark):
    df = spark.createDataFrame([(1, "a", 2.0)] * 3 + [(1, "b", 2.0), (2, "c", 5.0)], "g int, k string, x double")
    m = Moments("x")
    collapsed = df.groupBy("g", "k").agg(*m.of("x"))
    ours = collapsed.groupBy("g").agg(m.stddev(overall_mean(collapsed, m)).alias("s")).orderBy("g")
    assert rows(ours)[1] == (2, None)
    assert rows(ours)[0][1] == pytest.approx(0.0, abs=1e-7)


def test_moments_of_one_row_and_of_none(spark):
    df = spark.createDataFrame([(1, 4.0), (2, None)], "k int, x double")
    m = Moments("x")
    per_key = df.groupBy("k").agg(*m.of("x"))
    grouped = centred(per_key, "k", m).groupBy("k")
    report = grouped.agg(m.mean().alias("a"), m.stddev().alias("s")).orderBy("k")
    assert rows(report) == [(1, 4.0, None), (2, None, None)]


def test_split_is_stable_and_near_its_fraction(spark):
    df = spark.range(20_000).select(F.col("id").alias("a"), (F.col("id") % 7).alias("b"))
    split = df.withColumn("t", in_train(["a", "b"]))
    train = {r["a"] for r in split.where("t").collect()}
    again = {r["a"] for r in split.repartition(17).where("t").collect()}
    assert train == again
    assert abs(len(train) / 20_000 - 0.8) < 0.01


def test_split_of_missing_keys_is_never_null(spark):
    df = spark.createDataFrame([(None, None), ("a", None)], "a string, b string")
    assert df.where(in_train(["a", "b"]).isNull()).count() == 0


def test_tokens_and_ranking(spark):
    data = [("g", "Red mouse, red MOUSE 123 the"), ("g", "blue"), ("h", "blue don't"), ("h", None)]
    df = spark.createDataFrame(data, "g string, t string")
    tokens = clean_tokens(df, F.col("t"), ["g"])
    assert sorted(rows(tokens)) == [
        ("g", "blue"), ("g", "mouse"), ("g", "mouse"), ("g", "red"), ("g", "red"), ("h", "blue")
    ]
    assert rows(rank_keywords(tokens, "g", k=2)) == [
        ("g", 1, "mouse", 2, 4000.0),
        ("g", 2, "red", 2, 4000.0),
        ("h", 1, "blue", 1, 10000.0),
    ]


def test_ranking_counts_tokens_once(spark):
    """Totals and ranks share one shuffle, and no Python runs."""
    df = spark.createDataFrame([("g", "some words here")], "g string, t string").repartition(3)
    text = plan(rank_keywords(clean_tokens(df, F.col("t"), ["g"]), "g"))
    assert "ReusedExchange" in text
    assert "Python" not in text
    assert "row_number(), 40, Partial" in text


def test_profile_and_samples(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    assert rows(profile_table(df, "t")) == [("t", 1, "a", "int", 2), ("t", 2, "b", "string", 2)]
    sample = sample_rows(df, ["b"], 1)
    assert sample.columns == ["b"] and sample.count() == 1


def test_clean_counts_add_up(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, None), (None, 3), (2, 2)], "a int, b int")
    valid = F.col("a").isNotNull()
    assert rows(clean_counts(df, valid, df.where(valid).distinct())) == [(5, 0, 1, 1, 3)]
    assert rows(clean_counts(df.limit(0), valid, df.limit(0))) == [(0, 0, 0, 0, 0)]
