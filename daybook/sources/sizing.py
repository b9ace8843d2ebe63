"""Parquet output in files of about one size (survey: S9).

How many files a partition gets follows from its measured bytes, not from a given number: a
small partition is one file, a large or skewed one as many as it fills, and no partition is
scattered over all writing tasks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.sources.session import checkpoint_dir

# Rows, and bytes of rows, of the sample that tells how many bytes of Parquet a byte of row makes.
SAMPLE_ROWS, SAMPLE_BYTES = 100_000, 256 << 20


def _row_bytes(df: DataFrame):
    each = [F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) + 4 if f.dataType.typeName() in ("string", "binary") else
            F.length(F.to_json(F.struct(f.name))) if f.dataType.typeName() in ("array", "map", "struct") else F.lit(8) for f in df.schema.fields]
    total = F.lit(0)
    for e in each:
        total = total + e
    return total.cast("long")


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """``(file, bytes, rows)`` of the Parquet files under ``path``."""
    at = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
    return at.groupBy("file", "bytes").agg(F.count(F.lit(1)).alias("rows"))


def write_sized(df: DataFrame, path: str, file_bytes: int = 256 << 20, partition_by: list[str] | None = None, mode: str = "errorifexists") -> int:
    """Writes ``df`` in Parquet files of about ``file_bytes`` and returns how many.

    One aggregate measures rows and bytes of each value of ``partition_by`` (these values are
    folders, so their list is small enough for the driver), and a sample of at most about
    ``SAMPLE_ROWS`` rows and ``SAMPLE_BYTES``, written beside, how much of that Parquet keeps. Each partition's
    rows are then dealt by a hash over the files that its bytes make, one writing task a
    file. ``df`` is read twice, and once more for the sample: write an expensive one first.
    Rows equal in all columns go into one file. An empty table writes an empty folder.
    """
    spark, keys = df.sparkSession, partition_by or []
    body = df.drop(*keys)
    sizes = df.groupBy(*[F.col(k) for k in keys]).agg(F.sum(_row_bytes(body)).alias("_bytes"), F.count(F.lit(1)).alias("_rows")).collect()
    rows, raw = sum(r["_rows"] or 0 for r in sizes), sum(r["_bytes"] or 0 for r in sizes)
    if not rows:
        df.write.mode(mode).partitionBy(*keys).parquet(path)
        return 0
    probe = f"{checkpoint_dir(spark).rstrip('/')}/daybook-probe-{uuid.uuid4().hex}"
    # the table is sampled by all tasks that read it; the sample alone is dealt into one
    part = min(1.0, SAMPLE_ROWS / rows, SAMPLE_BYTES / max(1, raw))
    body.sample(part, seed=1).repartition(1).write.parquet(probe)
    kept, tried = file_sizes(spark, probe).agg(F.sum("bytes"), F.sum("rows")).first()
    share = kept / (raw / rows * tried) if tried else 1.0
    files = [max(1, round((r["_bytes"] or 0) * share / file_bytes)) for r in sizes]
    plan, first = [], 0
    for r, n in zip(sizes, files):
        plan.append((*[r[k] for k in keys], first, n))
        first += n
    if keys:
        fields = ", ".join(f"`_key{i}` {df.schema[k].dataType.simpleString()}" for i, k in enumerate(keys))
        at = F.broadcast(spark.createDataFrame(plan, f"{fields}, _first int, _files int"))
        on = F.lit(True)
        for i, k in enumerate(keys):
            on = on & F.col(k).eqNullSafe(F.col(f"_key{i}"))
        dealt = df.join(at, on).drop(*[f"_key{i}" for i in range(len(keys))])
    else:
        dealt = df.withColumn("_first", F.lit(0)).withColumn("_files", F.lit(first))
    hashable = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    slot = F.col("_first") + F.pmod(F.xxhash64(*hashable), F.col("_files"))
    # the number of the file is the number of the task
    dealt = dealt.repartitionById(first, slot.cast("int")).select(*df.columns)
    dealt.write.mode(mode).partitionBy(*keys).parquet(path)
    return first
