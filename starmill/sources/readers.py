"""Raw JSON lines, Parquet tables, result CSVs and named views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.sources.schemas import CORRUPT


def read_json_lines(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """JSON lines, gzip or plain, under an explicit schema: no inference pass."""
    return (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def land_json_lines(
    spark: SparkSession, path: str | list[str], schema: str, target: str
) -> DataFrame:
    """Parse raw files once into Parquet and return that table.

    A gzip file cannot be split, so it is one task whatever follows; landing it costs
    no shuffle and every later pass reads columns in parallel.
    """
    read_json_lines(spark, path, schema).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def quarantine_lines(
    spark: SparkSession, path: str | list[str], schema: str, target: str, bad_target: str
) -> tuple[DataFrame, DataFrame]:
    """Land raw lines as tables: those that parse whole, and the others for a look.

    Bad lines keep their file and where its part began, beside the text as it was. The
    raw files are parsed once: both tables come from the one landing, the bad ones from
    the few rows whose column for them is not null.
    """
    lines = read_json_lines(spark, path, schema).select(
        "*",
        F.col("_metadata.file_path").alias("raw_file"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )
    bad = F.col(CORRUPT).isNotNull()
    lines.withColumn("is_bad", bad).write.mode("overwrite").partitionBy("is_bad").parquet(target)
    landed = spark.read.schema(f"{schema}, raw_file string, block_start bigint, is_bad boolean").parquet(target)
    kept = landed.where("is_bad").select("raw_file", "block_start", F.col(CORRUPT).alias("line"))
    kept.write.mode("overwrite").parquet(bad_target)
    good = landed.where("not is_bad").drop("raw_file", "block_start", "is_bad", CORRUPT)
    return good, spark.read.parquet(bad_target)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_result_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A result table with a header line. Types are inferred unless given; a missing
    path raises Spark's own error."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make tables available to ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
