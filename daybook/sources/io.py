"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per text line, column ``value``."""
    return spark.read.text(path)


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None,
             header: bool = True, sep: str = ",") -> DataFrame:
    """CSV scan. Without a schema every column is a string named by the header
    (no inference pass over the data). With a schema, short rows and unparsable cells
    become null (PERMISSIVE)."""
    r = spark.read.option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def string_schema(*names: str) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


def read_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """S5."""
    return spark.read.parquet(path) if isinstance(path, str) else spark.read.parquet(*path)


def read_table(spark: SparkSession, name: str, where: str | None = None) -> DataFrame:
    """Catalog table; a predicate on a partition column is pruned at planning."""
    df = spark.table(name)
    return df.where(where) if where else df


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str],
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Relational table over JDBC. Give a numeric ``partition_column`` with bounds
    so a big table is read by ``num_partitions`` parallel range queries instead of
    one connection."""
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                               upperBound=upper_bound, numPartitions=num_partitions,
                               properties=properties)
    return spark.read.jdbc(url, table, properties=properties)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", files: int | None = None,
                  partition_by: list[str] | None = None) -> None:
    """Parquet sink. ``files`` merges to that many files with ``coalesce``
    (keep it unset for large outputs: one file means one writing task)."""
    if files:
        df = df.coalesce(files)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append_table(df: DataFrame, name: str, partition_by: list[str] | None = None,
                 overwrite_partitions: bool = False) -> None:
    """Append to a catalog table. With ``overwrite_partitions`` a rerun of the same
    ``dt`` replaces that partition instead of duplicating it (dynamic overwrite)."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        # insertInto is positional: follow the table's column order
        ordered = df.select(*spark.table(name).columns)
        if overwrite_partitions:
            # an option of this write (insertInto has none): the session's setting isn't touched
            parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
            about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
            (ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts)
             .format(about["Provider"]).save(about["Location"]))
            if parts:
                spark.catalog.recoverPartitions(name)
            spark.catalog.refreshTable(name)
        else:
            ordered.write.mode("append").insertInto(name)
        return
    w = df.write.mode("append").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def write_bucketed(df: DataFrame, name: str, by: str, buckets: int) -> None:
    """S8 as a catalog table of ``buckets`` buckets hashed and sorted by ``by``, replacing a
    table of that name: joins and aggregates on ``by`` read it without a shuffle. Rows are
    dealt by ``by`` first, so each bucket is one file."""
    (df.repartition(buckets, by).write.mode("overwrite").format("parquet").bucketBy(buckets, by).sortBy(by).saveAsTable(name))


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Make a DataFrame visible to SQL."""
    df.createOrReplaceTempView(name)
    return df


def lines_of(df: DataFrame, *cols: str, sep: str = ",") -> DataFrame:
    """Render columns as delimited text lines (``value``), the shape S1 reads back."""
    return df.select(F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
                     .alias("value"))


def spread(df: DataFrame) -> DataFrame:
    """Scan parallelism guard for a large input that arrives in fewer splits than the
    cluster has cores (one big row group, a single gzip file, ...): redistribute it
    round-robin so the per-row work after the scan uses every core. On inputs that are
    already well split (the normal case for large tables) it returns ``df`` unchanged.
    Apply it to fact tables, not to small dimension tables."""
    target = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= target else df.repartition(target)
