"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import sys
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.sources.session import checkpoint_dir

# Fixed value: the white-space characters of the operators' contracts.
BLANKS = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def save(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    This cuts the lineage: executors lost later cost a reread, not a recomputation. The
    table is compressed and its measured size is known to the planner.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Delete the files behind a DataFrame that ``save`` returned and nothing reads any more."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsc.hadoopConfiguration()
    for d in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/llm-" in d:
            p = jvm.org.apache.hadoop.fs.Path(d)
            p.getFileSystem(conf).delete(p, True)


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def release(spark: SparkSession, seconds: float = 1.0) -> None:
    """Let go of finished shuffles before the next step: their files stay until the driver
    collects garbage, and are then removed in the background, for which this waits a little."""
    gc.collect()
    spark._jvm.System.gc()
    time.sleep(seconds)


def per_worker(key: str, make: Callable[[], object]) -> object:
    """What ``make`` builds, built once in a Python worker process and kept for its later tasks
    (functions of this subpackage travel by value, so their modules' globals don't stay).
    ``key`` says what it is built from; only the last one of a kind (before ``:``) is kept."""
    kept = sys.__dict__.setdefault("_daybook_kept", {})
    kind = key.partition(":")[0]
    if kind not in kept or kept[kind][0] != key:
        kept[kind] = (key, make())
    return kept[kind][1]
