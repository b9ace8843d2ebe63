"""Rejected input beside the result (survey: S4): the raw line, why, and where it stands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Fixed value: a cell put after the last one, to see where that is.
_END = "\u0001"


def placed_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text lines with their place: ``value, file, block, line``. ``block`` is the byte at
    which the file's split begins, ``line`` counts from 1 within it (a file read in one
    split has the block 0, and ``line`` is its line number)."""
    d = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                                     F.monotonically_increasing_id().alias("_n"))
    # a row for each split of the input
    first = d.groupBy("file", "block").agg(F.min("_n").alias("_first"))
    return d.join(F.broadcast(first), ["file", "block"]).select("value", "file", "block", (F.col("_n") - F.col("_first") + 1).alias("line"))


def csv_rejects(spark: SparkSession, path: str | list[str], schema: StructType | str, header: bool = True, sep: str = ",") -> DataFrame:
    """The lines of which ``read_csv`` with this schema makes nulls or leaves out cells:
    ``value, reason, file, block, line``. ``reason`` is the first of ``short row``, ``long
    row``, ``open quote`` and ``cell <name>`` (a non-empty cell that isn't of the column's type). Empty lines
    are no rows; a cell may be quoted, a quoted cell may not hold a line break.
    """
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = kind.names
    texts = StructType([StructField(f"c{i}", StringType()) for i in range(len(names) + 1)])
    lines = placed_lines(spark, path).where(F.trim("value") != "")
    if header:
        lines = lines.where(~((F.col("block") == 0) & (F.col("line") == 1)))
    raw = F.from_csv(F.concat("value", F.lit(sep + _END)), F.lit(", ".join(f"{c} string" for c in texts.names)), {"sep": sep})
    typed = F.from_csv("value", F.lit(", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind.fields)), {"sep": sep})
    d = lines.withColumn("raw", raw).withColumn("typed", typed)
    cells = [F.col(f"raw.{c}") for c in texts.names]

    def bad(i: int) -> Column:
        return F.when(cells[i].isNotNull() & (cells[i] != "") & F.col("typed").getField(names[i]).isNull(), F.lit(f"cell {names[i]}"))

    early = F.lit(False)
    for c in cells[:-1]:
        early = early | F.coalesce(c == _END, F.lit(False))
    reason = F.coalesce(F.when(early, F.lit("short row")), F.when(cells[-1] != _END, F.lit("long row")),
                        F.when(cells[-1].isNull(), F.lit("open quote")), *[bad(i) for i in range(len(names))])
    return d.select("value", reason.alias("reason"), "file", "block", "line").where("reason IS NOT NULL")
