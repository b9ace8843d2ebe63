"""Loading the driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


# The fact tables: large, and in the test data one row group each.
FACT_TABLES = frozenset({"lineitem", "orders", "events", "documents"})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from daybook.sources.io import spread

    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if name in FACT_TABLES else df
