from daybook.operators import activity as act

RNG = [
    ("a", "2020-05-20", "2020-05-20", "2020-05-26"),
    ("a", "2020-05-20", "2020-05-29", "2020-06-01"),
    ("a", "2020-05-20", "2020-06-03", "9999-12-31"),
    ("b", "2020-05-22", "2020-05-22", "2020-05-30"),
    ("b", "2020-05-22", "2020-06-03", "2020-06-05"),
    ("t", "2020-05-22", "2020-05-22", "2020-05-30"),
    ("t", "2020-05-22", "2020-06-07", "9999-12-31"),
    ("c", "2020-06-03", "2020-06-03", "9999-12-31"),
    ("x", "2020-06-04", "2020-06-04", "2020-06-05"),
    ("stray sentence", None, None, None),
]
SCHEMA = "guid string, first_dt string, rng_start string, rng_end string"

DEMO = [
    (1, "2020-05-20", "2020-01-01", "2020-01-12"),
    (1, "2020-05-20", "2020-02-09", "2020-03-11"),
    (1, "2020-05-20", "2020-03-13", "9999-12-31"),
    (2, "2020-05-22", "2020-03-02", "2020-03-02"),
    (2, "2020-05-22", "2020-03-04", "2020-03-05"),
    (3, "2020-05-22", "2020-03-02", "2020-03-09"),
    (3, "2020-05-22", "2020-03-12", "9999-12-31"),
    (4, "2020-06-03", "2020-03-04", "9999-12-31"),
    (5, "2020-06-04", "2020-03-12", "2020-03-13"),
]
DEMO_SCHEMA = "guid long, first_dt string, rng_start string, rng_end string"


def test_uca_golden(spark):
    rng = spark.createDataFrame(RNG, SCHEMA)
    want = [(1, 3), (2, 3), (3, 2), (4, 2), (5, 2), (6, 2)]
    for m in ("explode", "histogram"):
        got = sorted((r.act_days, r.users) for r in act.continuous_active_users(rng, "2020-06-08", m).collect())
        assert got == want, m


def test_itv_golden(spark):
    rng = spark.createDataFrame(DEMO, DEMO_SCHEMA)
    got = sorted(tuple(r) for r in act.visit_intervals(rng, "2020-03-14", 30).collect())
    assert got == [(1, 0, 28), (1, 2, 1), (2, 0, 1), (2, 2, 1), (3, 0, 9), (3, 3, 1), (4, 0, 10), (5, 0, 1)]


def test_retention_golden(spark):
    rng = spark.createDataFrame(DEMO, DEMO_SCHEMA)
    want = [("2020-03-14", 0, 3), ("2020-03-13", 1, 3), ("2020-03-12", 2, 2)] + [
        (f"2020-03-{d:02d}", 14 - d, 1) for d in range(4, 12)]
    for m in ("explode", "histogram"):
        got = sorted(((r.act_dt, r.rt_days, r.rt_users) for r in act.retention(rng, "2020-03-14", method=m).collect()),
                     reverse=True)
        assert got == sorted(want, reverse=True), m


def test_retention_edges(spark):
    rows = [(9, "x", "2020-03-20", "9999-12-31"),  # starts after as_of: no rows
            (8, "x", "2019-12-30", "9999-12-31")]  # crosses a new year (D1)
    rng = spark.createDataFrame(rows, DEMO_SCHEMA)
    got = act.retention(rng, "2020-01-02").collect()
    assert sorted((r.act_dt, r.rt_days) for r in got) == [
        ("2019-12-30", 3), ("2019-12-31", 2), ("2020-01-01", 1), ("2020-01-02", 0)]
    uca = sorted((r.act_days, r.users) for r in act.continuous_active_users(rng, "2020-01-02").collect())
    assert uca == [(1, 1), (2, 1), (3, 1), (4, 1)]


def test_itv_window_edges(spark):
    rows = [(1, "x", "2020-02-01", "2020-02-13"),  # ends exactly 30 days before: kept
            (1, "x", "2020-02-01", "2020-02-12"),  # 31 days: dropped
            (2, "x", "2019-12-31", "2020-01-02")]
    rng = spark.createDataFrame(rows, DEMO_SCHEMA)
    got = sorted(tuple(r) for r in act.visit_intervals(rng, "2020-03-14", 30).collect())
    assert got == [(1, 0, 0)]
    got = sorted(tuple(r) for r in act.visit_intervals(rng.where("guid = 2"), "2020-01-10", 30).collect())
    assert got == [(2, 0, 2)]  # across a new year (D1)


def test_active_ranges(spark):
    import datetime as dt
    ev = [(1, dt.datetime(2024, 1, d, 5)) for d in (1, 2, 3, 5, 6, 30)] + [(1, dt.datetime(2024, 1, 2, 9))] + \
         [(2, dt.datetime(2024, 1, 29, 1)), (2, dt.datetime(2024, 1, 31, 1))]
    df = spark.createDataFrame(ev, "u long, ts timestamp")
    got = sorted(tuple(r) for r in act.active_ranges(df, "u", "ts", "2024-01-30").collect())
    assert got == [(1, "2024-01-01", "2024-01-01", "2024-01-03"), (1, "2024-01-01", "2024-01-05", "2024-01-06"),
                   (1, "2024-01-01", "2024-01-30", "9999-12-31"), (2, "2024-01-29", "2024-01-29", "2024-01-29")]


def test_uca_counts_ranges_not_distinct_users(spark):
    rows = [("g", "x", "2020-06-07", "9999-12-31"), ("g", "x", "2020-06-08", "9999-12-31")]
    rng = spark.createDataFrame(rows, SCHEMA)
    for m in ("explode", "histogram"):
        got = sorted((r.act_days, r.users) for r in act.continuous_active_users(rng, "2020-06-08", m).collect())
        assert got == [(1, 2), (2, 1)], m


def test_date_helpers(spark):
    from daybook.functions import date_add_str, date_diff_days
    df = spark.createDataFrame([("2019-12-31", "2020-01-01"), ("bad", "2020-01-01")], "a string, b string")
    got = df.select(date_diff_days("b", "a").alias("d"), date_add_str("a", 2).alias("p")).collect()
    assert (got[0].d, got[0].p) == (1, "2020-01-02")  # D1: true calendar difference across a new year
    assert (got[1].d, got[1].p) == (None, None)
