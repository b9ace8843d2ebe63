"""Driver query for the sources and sinks (S1-S5, S8): a write/read round trip of a
whole table through text, CSV and parquet in a fresh folder under the session's
checkpoint folder (a shared folder on a cluster)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from daybook import sources
from daybook.plans.registry import register
from daybook.plans.tables import table


@register("q_sources", """SELECT 'text' AS fmt, c_custkey, c_name, c_acctbal FROM customer
UNION ALL SELECT 'csv', c_custkey, c_name, c_acctbal FROM customer
UNION ALL SELECT 'csv strings', c_custkey, c_name, c_acctbal FROM customer
UNION ALL SELECT 'csv plain', c_custkey, c_name, c_acctbal FROM customer
UNION ALL SELECT 'parquet', c_custkey, c_name, c_acctbal FROM customer""")
def q_sources(spark, sf_dir):
    base = f"{sources.checkpoint_dir(spark).rstrip('/')}/daybook-sources-{uuid.uuid4().hex}"
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    # Parquet sink (fails if the folder exists), S5: parquet scan
    sources.write_parquet(c, f"{base}/parquet")
    pq = sources.read_parquet(spark, f"{base}/parquet")
    # Header CSV with a declared schema
    c.write.option("header", True).csv(f"{base}/csv")
    csv = sources.read_csv(spark, f"{base}/csv", "c_custkey long, c_name string, c_acctbal double", header=True)
    # The same without a schema, all strings
    strings = sources.read_csv(spark, f"{base}/csv", header=True).select(
        F.col("c_custkey").cast("long"), "c_name", F.col("c_acctbal").cast("double"))
    # S3: a declared schema over files without a header
    c.write.csv(f"{base}/plain")
    plain = sources.read_csv(spark, f"{base}/plain", "c_custkey long, c_name string, c_acctbal double", header=False)
    # Text lines (tab-separated; names hold no tabs), parsed back with split
    c.select(F.concat_ws("\t", "c_custkey", "c_name", F.col("c_acctbal").cast("string")).alias("value")) \
        .write.text(f"{base}/text")
    parts = F.split(F.col("value"), "\t")
    txt = sources.read_lines(spark, f"{base}/text").select(
        parts[0].cast("long").alias("c_custkey"), parts[1].alias("c_name"), parts[2].cast("double").alias("c_acctbal"))
    return (txt.select(F.lit("text").alias("fmt"), "*")
            .unionByName(csv.select(F.lit("csv").alias("fmt"), "*"))
            .unionByName(strings.select(F.lit("csv strings").alias("fmt"), "*"))
            .unionByName(plain.select(F.lit("csv plain").alias("fmt"), "*"))
            .unionByName(pq.select(F.lit("parquet").alias("fmt"), "*")))


_FILE_BYTES = 64 << 10


@register("q_sized_files", """SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS rows, true AS in_band
FROM lineitem GROUP BY year(l_shipdate)""")
def q_sized_files(spark, sf_dir):
    """Line items written by ship year in files of about 64 KB; every file of a year is
    between half and twice that, unless it is the year's only one."""
    path = f"{sources.checkpoint_dir(spark).rstrip('/')}/daybook-sized-{uuid.uuid4().hex}"
    li = table(spark, sf_dir, "lineitem").withColumn("year", F.year("l_shipdate"))
    sources.write_sized(li, path, _FILE_BYTES, ["year"])
    year = F.regexp_extract("file", "/year=([0-9]+)/", 1)
    sizes = sources.file_sizes(spark, path).withColumn("year", F.when(year != "", year.cast("int")))
    fits = F.col("bytes").between(_FILE_BYTES // 2, 2 * _FILE_BYTES)
    return sizes.groupBy("year").agg(F.sum("rows").alias("rows"), ((F.count(F.lit(1)) == 1) | F.every(fits)).alias("in_band"))
