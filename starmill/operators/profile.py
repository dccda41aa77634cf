"""What is in a table: rows, schema, samples, and what cleaning removed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from starmill.sources.schemas import CORRUPT


def profile_table(df: DataFrame, name: str) -> DataFrame:
    """One row per column: table, position, column, type, and the table's row count."""
    columns = F.array(
        *[
            F.struct(
                F.lit(position).alias("column_position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
            )
            for position, field in enumerate(df.schema, start=1)
        ]
    )
    counted = df.agg(F.count("*").alias("row_count"))
    return counted.select(F.lit(name).alias("table_name"), F.inline(columns), "row_count")


def sample_rows(df: DataFrame, columns: Sequence[str], n: int = 5) -> DataFrame:
    """The ``n`` rows with the smallest digest of some columns, for a look at the data.

    The same rows under any partitioning; every task hands on ``n`` rows at most.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    digest = F.md5(F.concat_ws("|", *parts))
    return df.select(*columns).orderBy(digest, *columns).limit(n)


class WriteCounts:
    """Counts of the cleaning, taken by the job that writes.

    ``watched`` goes into the job in place of the raw rows; after the write ``counts``
    gives what ``clean_counts`` would, without another scan. Tasks that ran twice may
    have counted twice, so the raw rows must equal those of the files' footers; where
    they do not, the columns behind ``valid`` are scanned after all.

    ``raw`` should be a table read in a session of its own (``spark.newSession()``): once
    a session observes, models of MLlib can no longer be sent to its tasks (Spark 4.1).
    """

    def __init__(self, raw: DataFrame, valid: Column):
        self._raw, self._valid = raw, valid
        self._seen = Observation()
        corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else F.lit(False)
        self.watched = raw.observe(
            self._seen,
            F.count(F.lit(1)).alias("raw_rows"),
            F.count_if(corrupt).alias("corrupt_rows"),
            F.count_if(~valid).alias("rejected_rows"),
        )

    def counts(self, written: DataFrame) -> DataFrame:
        seen = self._seen.get
        if seen["raw_rows"] != self._raw.count():
            return clean_counts(self._raw, self._valid, written)
        kept = written.agg(F.count("*").alias("clean_rows"))
        known = [F.lit(seen[c]).alias(c) for c in ("raw_rows", "corrupt_rows", "rejected_rows")]
        surplus = F.col("raw_rows") - F.col("rejected_rows") - F.col("clean_rows")
        return kept.select(*known, "clean_rows").select(
            "raw_rows", "corrupt_rows", "rejected_rows", surplus.alias("surplus_rows"), "clean_rows"
        )


def clean_counts(raw: DataFrame, valid: Column, cleaned: DataFrame) -> DataFrame:
    """Rows before cleaning, those that did not parse whole, rows failing ``valid``,
    surplus copies, and rows kept. A corrupt row may still be valid: what of it parsed
    is used, so it counts in both places.

    With ``cleaned`` read back from where it was written this costs a file footer count
    and one scan of the columns behind ``valid``, and it states what is really there,
    also when tasks had to run twice.
    """
    kept = cleaned.agg(F.count("*")).scalar()
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else F.lit(False)
    counted = raw.agg(
        F.count("*").alias("raw_rows"),
        F.count_if(corrupt).alias("corrupt_rows"),
        F.count_if(~valid).alias("rejected_rows"),
    )
    surplus = F.col("raw_rows") - F.col("rejected_rows") - kept
    return counted.select("*", surplus.alias("surplus_rows"), kept.alias("clean_rows"))
