"""The driver contract: entry, queries, oracle_sql, compared with DuckDB on the
smallest tables, under a session time zone other than UTC."""

import os
import sys

import pytest

import __spark_entry__ as E

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))


def test_contract_shape():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert not [name for name in q if name.startswith("q_") and name not in o]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "guid" in df.columns


@pytest.mark.parametrize("name", ["q_uca", "q_interval", "q_idmap_roll", "q_applog", "q_knn", "q_bayes_score",
                                  "q_tokens", "q_geo_dict", "q_segment", "q_comment_classify", "q_similarity", "q_link",
                                  "q_catalog", "q_sources", "q_sql_functions", "q_sparse_vectors", "q_date_add",
                                  "q_idmap_collide", "q_segment_best", "q_rejects", "q_sized_files", "q_uca_ordered", "q_term_freq"])
def test_matches_duckdb_in_another_time_zone(spark, sf_dir, name):
    import duckdb
    from check_oracle import digest

    from daybook.plans.tables import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        df = E.queries()[name](spark, sf_dir)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    cur = con.execute(E.oracle_sql()[name])
    orows = cur.fetchall()
    assert len(rows) == len(orows)
    assert digest(rows, df.columns) == digest(orows, [d[0] for d in cur.description])
