"""Driver queries for the active-range reports (Q-UCA, Q-ART, Q-ITV) over ``events``
and ``orders``; each has a DuckDB oracle."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from daybook import sources
from daybook.functions.core import date_add_str, to_day
from daybook.operators import activity as act
from daybook.plans import jobs
from daybook.plans.registry import register
from daybook.plans.tables import table

EVENTS_AS_OF = "2024-01-30"
# a day with orders a little after the new year, and the last day on which there are orders
ORDERS_AS_OF, ORDERS_END = "2000-01-10", "2001-08-01"


def ranges_sql(src: str, user: str, ts: str, as_of: str) -> str:
    """DuckDB CTE body ``rng(guid, first_dt, rng_start, rng_end)`` by gaps-and-islands."""
    return f"""
    d AS (SELECT DISTINCT {user} AS guid, CAST({ts} AS DATE) AS day FROM {src}
          WHERE {user} IS NOT NULL AND {ts} IS NOT NULL AND CAST({ts} AS DATE) <= DATE '{as_of}'),
    g AS (SELECT guid, day, day - CAST(row_number() OVER (PARTITION BY guid ORDER BY day) AS INTEGER) AS grp FROM d),
    r AS (SELECT guid, min(day) AS s, max(day) AS e FROM g GROUP BY guid, grp),
    rng AS (SELECT guid, strftime(min(s) OVER (PARTITION BY guid), '%Y-%m-%d') AS first_dt,
                   strftime(s, '%Y-%m-%d') AS rng_start,
                   CASE WHEN e = DATE '{as_of}' THEN '9999-12-31' ELSE strftime(e, '%Y-%m-%d') END AS rng_end
            FROM r)"""


def _uca_sql(rng_cte: str, as_of: str) -> str:
    return f"""WITH {rng_cte},
    o AS (SELECT * FROM rng WHERE rng_end = '9999-12-31' AND CAST(rng_start AS DATE) <= DATE '{as_of}'),
    x AS (SELECT guid, unnest(generate_series(1, date_diff('day', CAST(rng_start AS DATE), DATE '{as_of}') + 1)) AS act_days FROM o)
    SELECT '{as_of}' AS dt, CAST(act_days AS INTEGER) AS act_days, CAST(count(guid) AS BIGINT) AS users
    FROM x GROUP BY act_days"""


def _art_sql(rng_cte: str, as_of: str) -> str:
    return f"""WITH {rng_cte},
    o AS (SELECT * FROM rng WHERE rng_end = '9999-12-31' AND CAST(rng_start AS DATE) <= DATE '{as_of}'),
    x AS (SELECT guid, CAST(unnest(generate_series(CAST(rng_start AS DATE), DATE '{as_of}', INTERVAL 1 DAY)) AS DATE) AS d FROM o)
    SELECT '{as_of}' AS dt, strftime(d, '%Y-%m-%d') AS act_dt,
           CAST(date_diff('day', d, DATE '{as_of}') AS INTEGER) AS rt_days, CAST(count(*) AS BIGINT) AS rt_users
    FROM x GROUP BY d"""


def _itv_sql(rng_cte: str, as_of: str, w: int) -> str:
    return f"""WITH {rng_cte},
    c AS (SELECT guid,
            CASE WHEN date_diff('day', CAST(rng_start AS DATE), DATE '{as_of}') > {w}
                 THEN DATE '{as_of}' - {w} ELSE CAST(rng_start AS DATE) END AS s,
            CASE WHEN rng_end = '9999-12-31' THEN DATE '{as_of}' ELSE CAST(rng_end AS DATE) END AS e
          FROM rng WHERE date_diff('day', CAST(rng_end AS DATE), DATE '{as_of}') <= {w}),
    l AS (SELECT guid, s, e, lead(s) OVER (PARTITION BY guid ORDER BY s, e) AS nxt FROM c),
    u AS (SELECT guid, 0 AS itv_days, date_diff('day', s, e) AS cnts FROM l
          UNION ALL SELECT guid, date_diff('day', e, nxt), 1 FROM l WHERE nxt IS NOT NULL)
    SELECT guid, CAST(itv_days AS INTEGER) AS itv_days, CAST(sum(cnts) AS BIGINT) AS cnts FROM u GROUP BY guid, itv_days"""


_EV = ranges_sql("events", "user_id", "ts", EVENTS_AS_OF)
_OR = ranges_sql("orders", "o_custkey", "o_orderdate", ORDERS_AS_OF)


def event_ranges(spark: SparkSession, sf_dir: str):
    return act.active_ranges(table(spark, sf_dir, "events"), "user_id", "ts", EVENTS_AS_OF)


def order_ranges(spark: SparkSession, sf_dir: str, as_of: str = ORDERS_AS_OF):
    return act.active_ranges(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", as_of)


@register("q_active_ranges", f"WITH {_EV} SELECT * FROM rng")
def q_active_ranges(spark, sf_dir):
    return event_ranges(spark, sf_dir)


@register("q_uca", _uca_sql(_EV, EVENTS_AS_OF))
def q_uca(spark, sf_dir):
    """Q-UCA, histogram plan."""
    return act.continuous_active_users(event_ranges(spark, sf_dir), EVENTS_AS_OF)


@register("q_uca_explode", _uca_sql(_EV, EVENTS_AS_OF))
def q_uca_explode(spark, sf_dir):
    """Q-UCA, the literal explode plan (X2); must equal ``q_uca``."""
    return act.continuous_active_users(event_ranges(spark, sf_dir), EVENTS_AS_OF, method="explode")


@register("q_retention", _art_sql(_EV, EVENTS_AS_OF))
def q_retention(spark, sf_dir):
    return act.retention(event_ranges(spark, sf_dir), EVENTS_AS_OF)


@register("q_retention_explode", _art_sql(_EV, EVENTS_AS_OF))
def q_retention_explode(spark, sf_dir):
    return act.retention(event_ranges(spark, sf_dir), EVENTS_AS_OF, method="explode")


@register("q_interval", _itv_sql(_EV, EVENTS_AS_OF, 30))
def q_interval(spark, sf_dir):
    return act.visit_intervals(event_ranges(spark, sf_dir), EVENTS_AS_OF, 30)


@register("q_interval_new_year", _itv_sql(_OR, ORDERS_AS_OF, 400))
def q_interval_new_year(spark, sf_dir):
    """Q-ITV over customers' order days; the 400-day window spans two new years."""
    return act.visit_intervals(order_ranges(spark, sf_dir), ORDERS_AS_OF, 400)


# a customer seldom orders two days running; the orders of a priority do
_PR = ranges_sql("orders", "o_orderpriority", "o_orderdate", ORDERS_END)


@register("q_uca_orders", _uca_sql(_PR, ORDERS_END))
def q_uca_orders(spark, sf_dir):
    """Q-UCA over the order days of each priority, all orders."""
    o = table(spark, sf_dir, "orders")
    return act.continuous_active_users(act.active_ranges(o, "o_orderpriority", "o_orderdate", ORDERS_END), ORDERS_END)


@register("q_catalog", f"""SELECT 'uca' AS report, act_days AS days, users, dt FROM ({_uca_sql(_EV, EVENTS_AS_OF)})
UNION ALL SELECT 'retention', rt_days, rt_users, dt FROM ({_art_sql(_EV, EVENTS_AS_OF)})""")
def q_catalog(spark, sf_dir):
    """S6, S10, S11, P4, Q-UCH, Q-ART over catalog tables: the ranges of all events in a
    table partitioned by ``dt``, read through a view, the reports appended to tables by
    ``dt`` (twice: a rerun replaces its day). The tables are dropped again."""
    tag = uuid.uuid4().hex
    src, uca, ret = (f"daybook_{k}_{tag}" for k in ("ranges", "uca", "retention"))
    sources.append_table(event_ranges(spark, sf_dir).withColumn("dt", F.lit(EVENTS_AS_OF)), src, partition_by=["dt"])
    for _ in range(2):
        jobs.uca_report_table(spark, src, uca, EVENTS_AS_OF, source_dt=EVENTS_AS_OF)
        jobs.retention_table(spark, src, ret, EVENTS_AS_OF)
    sources.as_view(sources.read_table(spark, uca, f"dt = '{EVENTS_AS_OF}'"), f"{uca}_view")
    out = spark.sql(f"""SELECT 'uca' AS report, act_days AS days, users, dt FROM {uca}_view
        UNION ALL SELECT 'retention', rt_days, rt_users, dt FROM {ret}""")
    sources.checkpoint_dir(spark)
    out = out.checkpoint()
    spark.catalog.dropTempView(f"{uca}_view")
    for t in (src, uca, ret):
        spark.sql(f"DROP TABLE {t}")
    return out


@register("q_date_add", """SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 - 30 AS INTEGER), '%Y-%m-%d') AS shifted,
  strftime(CAST(o_orderdate AS DATE) + 7, '%Y-%m-%d') AS week_on FROM orders""")
def q_date_add(spark, sf_dir):
    """F4 (text) and F5 (date) over every order day."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", date_add_str(day, (F.col("o_orderkey") % 60 - 30).cast("int")).alias("shifted"),
        F.date_add(to_day(day), 7).cast("string").alias("week_on"))


@register("q_uca_ordered", f"""WITH u AS ({_uca_sql(_EV, EVENTS_AS_OF)})
SELECT CAST(row_number() OVER (ORDER BY act_days) AS INTEGER) AS place, act_days, users FROM u""")
def q_uca_ordered(spark, sf_dir):
    """Q-UCA from a header CSV, as the job does it (S2, O1): the report with the place at
    which each row comes out, which is that of its ``act_days``."""
    path = f"{sources.checkpoint_dir(spark).rstrip('/')}/daybook-ranges-{uuid.uuid4().hex}"
    event_ranges(spark, sf_dir).write.option("header", True).csv(path)
    # partitions of a sorted table follow one another: the id rises with the place
    out = jobs.uca_report(spark, path, EVENTS_AS_OF).withColumn("_at", F.monotonically_increasing_id())
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_at"))  # a row for each day of history
    return out.select(place.cast("int").alias("place"), F.col("act_days").cast("int").alias("act_days"), "users")
