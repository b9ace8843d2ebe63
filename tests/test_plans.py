"""Plan-shape checks: the properties the scale design relies on, read from the plans."""

from pyspark.sql import functions as F

from daybook.operators import activity, applog, bayes
from tests.test_ml import FEATS


def _physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_json_is_parsed_once(spark):
    lines = spark.createDataFrame([('{"eventid":"e"}',)], "value string")
    assert _optimized(applog.parse_app_log(lines)).count("from_json(") == 1


def test_interval_report_shuffles_once(spark):
    rng = spark.createDataFrame([(1, "x", "2020-03-01", "9999-12-31")],
                                "guid long, first_dt string, rng_start string, rng_end string")
    rng = rng.repartition(3)  # a source that is not partitioned by guid
    plan = _physical(activity.visit_intervals(rng, "2020-03-14"))
    # one exchange for the source's repartition, one hash exchange on guid for window + sum
    assert plan.count("Exchange hashpartitioning") == 1


def test_small_bayes_model_is_broadcast(spark, tmp_path):
    from tests.test_ml import SAMPLE, TEST
    rows = [tuple(line.split(",")) for line in SAMPLE.splitlines()]
    sample = spark.createDataFrame(rows, "name string, job string, income string, age string, sex string, label string")
    test = spark.createDataFrame(TEST, "name string, job string, income string, age string, sex string")
    plan = _physical(bayes.bayes_score(bayes.bayes_fit(sample, FEATS, "label", "pos"), test, "name", FEATS))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "CartesianProduct" not in plan


def test_scan_pruning_and_pushdown(spark, sf_dir):
    from daybook.plans.reports import event_ranges
    plan = _physical(activity.continuous_active_users(event_ranges(spark, sf_dir), "2024-01-30"))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan or (
        "struct<ts:timestamp_ntz,user_id:bigint>" in plan)
    assert "PushedFilters: [IsNotNull(ts), IsNotNull(user_id), LessThan(ts," in plan


def test_no_cartesian_anywhere(spark, sf_dir):
    import __spark_entry__ as E
    for name in ("q_knn", "q_similarity", "q_bayes_score", "q_sqdist", "q_stopwords", "q_applog", "q_link"):
        plan = _physical(E.queries()[name](spark, sf_dir))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
    assert F is not None
