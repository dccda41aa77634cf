"""Tables laid side by side: whole results, and no rows moved after the landing."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starmill.operators.dedup import dedup_by_key
from starmill.sources.bucketed import (
    PART,
    dedup_landed,
    join_landed,
    land_facts,
    land_lookup,
    plan_buckets,
)
from tests.conftest import plan, rows

ROW_KEY = ["item", "user"]


@pytest.fixture(scope="module")
def facts(spark):
    """A third on one item, a third copies of one row key, null items and null users."""
    n = F.col("id")
    item = F.when(n < 300, F.lit(-1)).when(n < 600, F.lit(-2)).when(n % 11 != 0, n % 40)
    user = F.when((n >= 300) & (n < 600), F.lit(7)).when(n % 13 != 0, n % 90)
    return spark.range(900).select(
        item.alias("item"), user.alias("user"), (n * 7919 % 900).alias("value"), (n % 3).alias("year")
    ).repartition(5)


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.range(-2, 30, 2).select(F.col("id").alias("item"), F.concat(F.lit("n"), "id").alias("name"))


@pytest.fixture(scope="module", params=[(5, 1), (10_000, 100_000)], ids=["hot", "plain"])
def landed(request, facts, lookup):
    parts, min_rows = request.param
    layout = plan_buckets(facts, "item", ROW_KEY, buckets=4, parts=parts, min_rows=min_rows)
    return layout, land_facts(facts, layout, ("year",)), land_lookup(lookup, layout)


def as_sorted(df):
    return sorted(map(repr, rows(df)))


def test_dedup_equals_the_shuffled_one_and_moves_nothing(facts, landed):
    layout, table, _ = landed
    ours = dedup_landed(table, layout).select(*facts.columns)
    assert as_sorted(ours) == as_sorted(dedup_by_key(facts, ROW_KEY))
    text = plan(ours)
    assert "Exchange" not in text and "Bucketed: true" in text


@pytest.mark.parametrize("how", ["inner", "left"])
def test_joins_equal_plain_ones_and_move_nothing(facts, lookup, landed, how):
    layout, table, names = landed
    ours = join_landed(table, names, layout, how).select("item", "user", "value", "name")
    whole = facts if layout.copied.isEmpty() else dedup_by_key_of(facts, layout)
    plain = whole.join(lookup, "item", how).select("item", "user", "value", "name")
    assert as_sorted(ours) == as_sorted(plain)
    assert "Exchange" not in plan(ours)


def dedup_by_key_of(facts, layout):
    """What landing keeps: copies of the hot row keys are one row."""
    hot = {tuple(r) for r in rows(layout.copied)}
    many = F.lit(False)
    for item, user in hot:
        many |= F.col("item").eqNullSafe(F.lit(item)) & F.col("user").eqNullSafe(F.lit(user))
    return facts.where(~many).unionByName(dedup_by_key(facts.where(many), ROW_KEY))


def test_a_hot_item_lies_in_many_parts(facts):
    layout = plan_buckets(facts, "item", ROW_KEY, buckets=4, parts=5, min_rows=1)
    assert set(rows(layout.hot)) == {(-1,), (-2,)} and rows(layout.copied) == [(-2, 7)]
    parts = land_facts(facts, layout).where("item = -1").select(PART).distinct().count()
    assert parts > 20


def test_years_are_read_alone(landed):
    _, table, _ = landed
    text = plan(table.where("year = 1"))
    assert "PartitionFilters: [isnotnull(year" in text


def test_an_empty_table_and_a_key_outside_the_row_key(facts, lookup):
    layout = plan_buckets(facts.limit(0), "item", ROW_KEY, buckets=2)
    landed = land_facts(facts.limit(0), layout)
    assert rows(dedup_landed(landed, layout)) == []
    assert rows(join_landed(landed, land_lookup(lookup, layout), layout)) == []
    with pytest.raises(ValueError, match="tell rows apart"):
        plan_buckets(facts, "value", ROW_KEY)
    with pytest.raises(ValueError, match="inner or left"):
        join_landed(landed, landed, layout, "full")
