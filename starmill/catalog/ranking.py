"""Shares, ranks and top rows over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmill.catalog.bindings import table
from starmill.catalog.registry import query
from starmill.operators.ranking import share_of_total, top_k_per_group, top_n


@query(
    "share_of_total",
    """
    SELECT event_type, COUNT(*) AS events,
           ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 2) AS share_pct
    FROM events GROUP BY event_type
    """,
)
def event_shares(spark, sf_dir):
    counts = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("events"))
    return share_of_total(counts, "events", "share_pct")


@query(
    "top_k_per_group",
    """
    SELECT event_type, CAST(place AS INTEGER) AS place, user_id, events
    FROM (SELECT event_type, user_id, COUNT(*) AS events,
                 row_number() OVER (PARTITION BY event_type
                                    ORDER BY COUNT(*) DESC, user_id) AS place
          FROM events GROUP BY event_type, user_id)
    WHERE place <= 40
    """,
)
def busiest_users(spark, sf_dir):
    counts = (
        table(spark, sf_dir, "events")
        .groupBy("event_type", "user_id")
        .agg(F.count("*").alias("events"))
    )
    order = [F.desc("events"), F.asc("user_id")]
    return top_k_per_group(counts, ["event_type"], order, 40, "place").select(
        "event_type", "place", "user_id", "events"
    )


@query(
    "top_n",
    """
    SELECT o_custkey, COUNT(*) AS orders, MAX(o_totalprice) AS largest
    FROM orders GROUP BY o_custkey ORDER BY orders DESC, largest DESC, o_custkey LIMIT 30
    """,
)
def top_customers(spark, sf_dir):
    customers = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.count("*").alias("orders"), F.max("o_totalprice").alias("largest"))
    )
    return top_n(customers, [F.desc("orders"), F.desc("largest"), F.asc("o_custkey")], 30)
