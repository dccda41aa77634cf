"""The most frequent keywords of a vocabulary too large to shuffle.

Mergeable summaries name candidates, one pass counts the candidates exactly and everything
else by hash cell, and the cells prove that no other word can be among the first: a word
outside the candidates occurs at most as often as its cell holds words. Where that does
not hold yet, summaries and cells widen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.operators.keywords import rank_counts, rank_keywords
from starmill.operators.ranking import top_k_per_group
from starmill.session import materialise

#: Words that a summary tracks at first, and the factor and limit of its widening.
TRACKED, WIDEN, WIDEST = 4096, 16, 1 << 19
#: Hash cells for every tracked word.
CELLS_PER_WORD = 16
#: Candidates over all groups that are worth sending to every task.
MOST_CANDIDATES = 1 << 20


def rank_heavy_keywords(
    tokens: DataFrame,
    group: str,
    token: str = "token",
    k: int = 40,
    tracked: int = TRACKED,
    widest: int = WIDEST,
) -> DataFrame:
    """The rows of ``rank_keywords``, with shuffles bounded by the summaries.

    A task sends one summary per group, then a row per candidate and cell, whatever the
    size of the vocabulary, for two passes over the tokens. A distribution so flat that
    the widest summary proves nothing is ranked from its whole vocabulary, as are groups
    so many that their candidates exceed MOST_CANDIDATES: results are always exact.
    """
    tokens = tokens.where(F.col(group).isNotNull() & F.col(token).isNotNull())
    tokens = tokens.select(group, F.col(token).alias("keyword"))
    while tracked <= widest:
        candidates = materialise(_candidates(tokens, group, tracked), "heavy-candidates")
        if candidates.count() > MOST_CANDIDATES:
            break
        counted = materialise(_counted(tokens, candidates, group, tracked), "heavy-counts")
        if uncertain_groups(counted, group, k).isEmpty():
            counts = counted.where(F.col("keyword").isNotNull()).drop("cell")
            totals = counted.groupBy(group).agg(F.sum("keyword_count").alias("_total"))
            return rank_counts(counts, totals, group, k)
        tracked *= WIDEN
    return rank_keywords(tokens, group, "keyword", k)


def _candidates(tokens: DataFrame, group: str, tracked: int) -> DataFrame:
    summary = F.expr(f"approx_top_k_accumulate(keyword, {tracked})")
    summaries = tokens.groupBy(group).agg(summary.alias("_summary"))
    found = summaries.select(group, F.expr(f"inline(approx_top_k_estimate(_summary, {tracked}))"))
    return found.select(group, F.col("item").alias("keyword"))


def _counted(tokens: DataFrame, candidates: DataFrame, group: str, tracked: int) -> DataFrame:
    """Occurrences per candidate, and of all other words per hash cell."""
    known = F.broadcast(candidates.withColumn("_known", F.lit(True)))
    cell = F.pmod(F.xxhash64("keyword"), F.lit(tracked * CELLS_PER_WORD))
    marked = tokens.join(known, [group, "keyword"], "left").select(
        group,
        F.when(F.col("_known"), F.col("keyword")).alias("keyword"),
        F.when(F.col("_known").isNull(), cell).alias("cell"),
    )
    return marked.groupBy(group, "keyword", "cell").agg(F.count("*").alias("keyword_count"))


def uncertain_groups(counted: DataFrame, group: str, k: int) -> DataFrame:
    """Groups in which a word outside the candidates might be among the first ``k``.

    A group is certain if its k-th candidate occurs more often than any cell is filled,
    or if nothing lies outside its candidates.
    """
    candidates = counted.where(F.col("keyword").isNotNull())
    first = top_k_per_group(candidates, [group], [F.desc("keyword_count"), F.asc("keyword")], k, "_at")
    kth = first.where(F.col("_at") == k).select(group, F.col("keyword_count").alias("_kth"))
    cells = counted.where(F.col("cell").isNotNull()).groupBy(group)
    fullest = cells.agg(F.max("keyword_count").alias("_fullest"))
    proven = F.coalesce(F.col("_kth") > F.col("_fullest"), F.lit(False))
    return fullest.join(kth, group, "left").where(~proven).select(group)
