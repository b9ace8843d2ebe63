"""Active-range reports (survey: X1, X2, X6, W2, P3-P5, A1-A3; jobs Q-UCA, Q-ART, Q-ITV).

An *active range* table has one row per continuous stretch of daily activity:
``guid, first_dt, rng_start, rng_end`` with ``yyyy-MM-dd`` strings and
``rng_end = '9999-12-31'`` while the stretch is still open on the report date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.core import OPEN_END, to_day


def _day(as_of: str | Column) -> Column:
    return to_day(F.lit(as_of) if isinstance(as_of, str) else as_of)


def _fmt(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


# --------------------------------------------------------------------------- helper
def active_ranges(events: DataFrame, user_col: str, ts_col: str, as_of: str) -> DataFrame:
    """Input helper (not a reference operator): build the active-range table from raw
    activity rows by gaps-and-islands.

    Plan: ``(user, day)`` is de-duplicated with a partial (map-side) aggregate, so the
    per-user window afterwards holds at most one row per calendar day no matter how
    many events a hot user has. Island id = ``day - row_number``; the island
    aggregate and the ``first_dt`` window reuse the window's ``guid`` partitioning.
    """
    a = _day(as_of)
    days = (events
            .select(F.col(user_col).alias("guid"), F.to_date(F.col(ts_col)).alias("day"))
            .where(F.col("guid").isNotNull() & F.col("day").isNotNull() & (F.col("day") <= a))
            .distinct())
    w = Window.partitionBy("guid").orderBy("day")
    islands = (days
               .withColumn("grp", F.date_sub(F.col("day"), F.row_number().over(w)))
               .groupBy("guid", "grp")
               .agg(F.min("day").alias("s"), F.max("day").alias("e")))
    return islands.select(
        "guid",
        _fmt(F.min("s").over(Window.partitionBy("guid"))).alias("first_dt"),
        _fmt(F.col("s")).alias("rng_start"),
        F.when(F.col("e") == a, F.lit(OPEN_END)).otherwise(_fmt(F.col("e"))).alias("rng_end"),
    )


# --------------------------------------------------------------------------- P3, P4
def open_ranges(rng: DataFrame, dt: str | None = None) -> DataFrame:
    """Ranges still open; with ``dt`` also the partition predicate."""
    cond = F.col("rng_end") == F.lit(OPEN_END)
    if dt is not None:
        cond = (F.col("dt") == F.lit(dt)) & cond
    return rng.where(cond)


# --------------------------------------------------------------------------- X1, X2
def explode_streak(rng: DataFrame, as_of: str) -> DataFrame:
    """One row ``(guid, act_days)`` for ``act_days`` in ``1 .. days+1`` where
    ``days = datediff(as_of, rng_start)``; ranges starting after ``as_of`` give none."""
    days = F.datediff(_day(as_of), to_day("rng_start"))
    return (rng.where(days >= 0)
            .select("guid", F.explode(F.sequence(F.lit(1), days + 1)).alias("act_days")))


def explode_days(rng: DataFrame, as_of: str) -> DataFrame:
    """One row ``(guid, act_dt)`` per day from ``rng_start`` to ``as_of`` inclusive."""
    s, a = to_day("rng_start"), _day(as_of)
    return (rng.where(s <= a)
            .select("guid", F.explode(F.sequence(s, a)).alias("d"))
            .select("guid", _fmt(F.col("d")).alias("act_dt")))


# --------------------------------------------------------------------------- shared
def _open_start_cumulative(open_rng: DataFrame, as_of: str, count_col: Column) -> DataFrame:
    """For every day ``d`` in ``[min start, as_of]``: number of open ranges with
    ``rng_start <= d``. Returns ``(act_dt date, users long)``.

    Work is O(ranges) for one partial aggregate into a histogram keyed by start day,
    then O(calendar days) for a running sum over that histogram. The histogram has at
    most one row per calendar day, so its single-partition window is bounded by the
    date span, not by the number of users.
    """
    a = _day(as_of)
    s = to_day("rng_start")
    hist = (open_rng.where(s <= a)
            .groupBy(s.alias("s")).agg(count_col.alias("n")))
    w = Window.orderBy("s")
    run = hist.select(
        "s",
        F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("users"),
        F.coalesce(F.date_sub(F.lead("s").over(w), 1), a).alias("until"),
    )
    return run.select(F.explode(F.sequence("s", "until")).alias("act_dt"), "users")


# --------------------------------------------------------------------------- Q-UCA
def continuous_active_users(rng: DataFrame, as_of: str, method: str = "histogram") -> DataFrame:
    """Q-UCA: for each ``act_days = n``, how many open ranges have lasted at least
    ``n`` days on ``as_of``: ``(dt, act_days, users)``.

    ``count(guid)`` is not distinct (two open ranges of one guid count twice), as in
    the reference. ``method="explode"`` is the literal plan (X2 then count);
    ``"histogram"`` gives the same rows without multiplying each range by its length.
    """
    o = open_ranges(rng)
    if method == "explode":
        res = explode_streak(o, as_of).groupBy("act_days").agg(F.count("guid").alias("users"))
    else:
        cum = _open_start_cumulative(o, as_of, F.count("guid"))
        res = cum.select((F.datediff(_day(as_of), "act_dt") + 1).alias("act_days"), "users")
    return res.select(F.lit(as_of).alias("dt"), F.col("act_days").cast("int").alias("act_days"),
                      F.col("users").cast("long").alias("users"))


# --------------------------------------------------------------------------- Q-ART
def retention(rng: DataFrame, as_of: str, dt: str | None = None, method: str = "histogram") -> DataFrame:
    """Q-ART: ``(dt, act_dt, rt_days, rt_users)``: for every day from an open range's
    start to ``as_of`` (day 0 included), the open ranges active that day."""
    o = open_ranges(rng, dt)
    if method == "explode":
        res = (explode_days(o, as_of).groupBy("act_dt").agg(F.count(F.lit(1)).alias("rt_users")))
        act = F.col("act_dt")
    else:
        res = _open_start_cumulative(o, as_of, F.count(F.lit(1))).withColumnRenamed("users", "rt_users")
        act = _fmt(F.col("act_dt"))
    return res.select(
        F.lit(as_of).alias("dt"),
        act.alias("act_dt"),
        F.datediff(_day(as_of), to_day(act)).cast("int").alias("rt_days"),
        F.col("rt_users").cast("long").alias("rt_users"),
    )


# --------------------------------------------------------------------------- Q-ITV
def visit_intervals(rng: DataFrame, as_of: str, window_days: int = 30) -> DataFrame:
    """Q-ITV: distribution of visit intervals over the last ``window_days`` days:
    ``(guid, itv_days, cnts)``.

    Ranges whose end is more than ``window_days`` before ``as_of`` are dropped; older
    starts are clipped to ``as_of - window_days``; an open end becomes ``as_of``.
    Each range adds ``(guid, 0, end - start)``; each pair of consecutive ranges adds
    ``(guid, next.start - this.end, 1)``. The ``lead`` window partitions by ``guid``
    and the final sum groups by ``(guid, itv_days)``, which reuses that partitioning:
    one shuffle. Rows per guid are bounded by the window length.
    """
    a = _day(as_of)
    start, end = to_day("rng_start"), to_day("rng_end")
    clipped = (rng.where(F.datediff(a, end) <= window_days)
               .select("guid",
                       F.when(F.datediff(a, start) > window_days, F.date_sub(a, window_days))
                        .otherwise(start).alias("s"),
                       F.when(F.col("rng_end") == F.lit(OPEN_END), a).otherwise(end).alias("e")))
    w = Window.partitionBy("guid").orderBy("s", "e")
    clipped = clipped.withColumn("nxt", F.lead("s").over(w))
    nxt = F.col("nxt")
    pairs = F.array(
        F.struct(F.lit(0).alias("itv_days"), F.datediff("e", "s").alias("cnts")),
        F.when(nxt.isNotNull(), F.struct(F.datediff(nxt, "e").alias("itv_days"), F.lit(1).alias("cnts"))),
    )
    rows = (clipped.select("guid", F.explode(pairs).alias("r"))
            .where(F.col("r").isNotNull())
            .select("guid", "r.itv_days", "r.cnts"))
    return rows.groupBy("guid", "itv_days").agg(F.sum("cnts").cast("long").alias("cnts"))
