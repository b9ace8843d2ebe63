"""A dictionary bucketed by its hash is joined where it lies."""

import json

import pytest

from daybook import sources
from daybook.operators import applog, identity, idmap
from daybook.plans import jobs


def _line(uid, imei):
    return json.dumps({"user": {"uid": uid, "phone": {"imei": imei}}})


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_and_roll_leave_the_dictionary(spark, no_broadcast):
    rows = [(f"n{i}", i * 31 % 977, i % 50) for i in range(500)]
    d = spark.createDataFrame(rows, "name string, biaoshi_hashcode long, guid long")
    spark.sql("DROP TABLE IF EXISTS daybook_dict")
    sources.write_bucketed(d, "daybook_dict", "biaoshi_hashcode", 8)
    table = spark.table("daybook_dict")
    assert sorted(map(tuple, table.collect())) == sorted(rows)
    tuples = spark.createDataFrame([("n1", "x"), ("n7", None)], "a string, b string")
    today = spark.createDataFrame([("n1",), ("new",)], "name string")
    for work in (lambda x: applog.guid_of_tuples(tuples, x, ("a", "b")), lambda x: identity.look_up(x, today)):
        assert "Exchange hashpartitioning(biaoshi_hashcode" in _plan(work(d))
        kept = _plan(work(table))
        assert "Bucketed: true" in kept and "SortMergeJoin" in kept and "Exchange hashpartitioning(biaoshi_hashcode" not in kept
        assert sorted(map(str, work(table).collect())) == sorted(map(str, work(d).collect()))


def test_jobs_over_the_catalog(spark, tmp_path):
    for t in ("daybook_ids1", "daybook_ids2"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    one, two = str(tmp_path / "one.txt"), str(tmp_path / "two.txt")
    with open(one, "w") as f:
        f.write("\n".join([_line("Aa", "i1")] * 3 + [_line("BB", "i2")] * 3))
    with open(two, "w") as f:
        f.write("\n".join([_line("u3", "i2")] * 3 + [_line("u4", "i4")]))
    jobs.identity_table_job(spark, [one], "daybook_ids1", buckets=4)
    jobs.identity_table_job(spark, [two], "daybook_ids2", "daybook_ids1", buckets=4)
    got = {r.name: r.guid for r in spark.table("daybook_ids2").collect()}
    assert got["i1"] == got["Aa"] != got["BB"] == got["i2"] == got["u3"] and set(got) == {"Aa", "BB", "i1", "i2", "u3", "u4", "i4"}
    assert spark.table("daybook_ids2").count() == 7
    names = {r.name: r.guid for r in idmap.identity_dictionary(idmap.extract_ids(spark.read.text([one]))).collect()}
    assert names["Aa"] == got["Aa"] and names["BB"] == got["BB"]
