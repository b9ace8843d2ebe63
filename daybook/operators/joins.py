"""Join helpers: size-checked broadcast and hot-key splitting (survey J9).

Rules followed throughout the library:

* a side is broadcast only when its size has a proven bound (a row-count check or a
  construction that bounds it), with a shuffle join beyond the bound;
* when one key may hold a large share of the rows (a giant component, a hot device,
  a popular cell), the rows on hot keys are joined map-side against a broadcast of
  the (bounded) hot part of the other side, and only the remaining rows shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A key is hot when it holds at least this many rows ...
HOT_MIN_ROWS = 100_000
# ... or enough rows that no more than this many keys can qualify.
HOT_MAX_KEYS = 10_000


# Most bytes of rows that a join side may hold to be broadcast.
BROADCAST_BYTES = 32 << 20


def measured_bytes(df: DataFrame) -> int:
    """About how many bytes the rows of ``df`` hold: one aggregate over it."""
    each = [F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) + 8 if f.dataType.typeName() in ("string", "binary") else F.lit(8)
            for f in df.schema.fields]
    total = each[0]
    for e in each[1:]:
        total = total + e
    return df.agg(F.coalesce(F.sum(total.cast("long")), F.lit(0))).first()[0]


def top_hot_keys(counts: DataFrame, keys: list[str], count_col: str, min_rows: int = HOT_MIN_ROWS,
                 max_keys: int = HOT_MAX_KEYS) -> DataFrame:
    """Hot keys from an aggregate that already carries per-key row counts: those with at
    least ``min_rows`` rows and at least one ``max_keys``-th of all rows. No more than
    ``max_keys`` keys can hold that much, so the result is safe to broadcast, and a key
    left out holds a ``max_keys``-th of the rows at most, which one task can take."""
    share = F.coalesce(counts.agg(F.sum(count_col) / max_keys).scalar(), F.lit(0.0))
    return (counts.where((F.col(count_col) >= min_rows) & (F.col(count_col) >= share))
            .select(*keys, F.col(count_col).alias("_n")))


def _on(keys: list[str], other: list[str], null_safe: bool) -> Column:
    c = None
    for k, o in zip(keys, other):
        e = F.col(k).eqNullSafe(F.col(o)) if null_safe else F.col(k) == F.col(o)
        c = e if c is None else c & e
    return c


def skew_join(big: DataFrame, dim: DataFrame, keys: str | list[str], hot: DataFrame | list | None,
              how: str = "inner", null_safe: bool = False) -> DataFrame:
    """Equi-join ``big`` with ``dim`` (at most one ``dim`` row per key), splitting hot keys.

    ``hot`` holds the hot key values, bounded by construction (see ``top_hot_keys``): a
    DataFrame, or a short Python list of single-key values (an empty list means a plain
    join). Rows of ``big`` on hot keys are joined with a broadcast of the
    matching ``dim`` rows (no shuffle of the hot rows); the other rows take an ordinary
    shuffle join. The two halves partition ``big``, so no row is lost or duplicated.
    ``how`` is ``inner`` or ``left``. The result has ``big``'s columns then ``dim``'s
    non-key columns (their names must not clash with ``big``'s).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    vals = [c for c in dim.columns if c not in keys]
    dk = [f"__dim_key{i}" for i in range(len(keys))]
    hk = [f"__hot_key{i}" for i in range(len(keys))]
    d = dim.select(*[F.col(k).alias(x) for k, x in zip(keys, dk)], *vals)
    out_cols = [*big.columns, *vals]
    if hot is None or (isinstance(hot, list) and not hot):
        return big.join(d, _on(keys, dk, null_safe), how).select(*out_cols)
    if isinstance(hot, list):
        if len(keys) != 1:
            raise ValueError("a hot-key list needs a single join key")
        in_hot = F.col(keys[0]).isin(hot)
        d_hot = F.broadcast(d.where(F.col(dk[0]).isin(hot)))
        hot_part = big.where(in_hot).join(d_hot, _on(keys, dk, null_safe), how).select(*out_cols)
        cold_part = big.where(~in_hot | F.col(keys[0]).isNull()).join(d, _on(keys, dk, null_safe), how)
        return hot_part.unionByName(cold_part.select(*out_cols))
    h = F.broadcast(hot.select(*[F.col(k).alias(x) for k, x in zip(keys, hk)]))
    big_hot = big.join(h, _on(keys, hk, null_safe), "left_semi")
    big_cold = big.join(h, _on(keys, hk, null_safe), "left_anti")
    d_hot = F.broadcast(d.join(h, _on(dk, hk, null_safe), "left_semi"))
    hot_part = big_hot.join(d_hot, _on(keys, dk, null_safe), how).select(*out_cols)
    cold_part = big_cold.join(d, _on(keys, dk, null_safe), how).select(*out_cols)
    return hot_part.unionByName(cold_part)


# Rows per salt bucket of a hot key, and buckets that rows without a key are dealt over.
SALT_ROWS, NULL_SALTS = 1_000_000, 4096


def salted_join(big: DataFrame, dim: DataFrame, key: str, hot: DataFrame | None, how: str = "left",
                salt_rows: int = SALT_ROWS, repeats: bool = False) -> DataFrame:
    """Equi-join on ``key`` (one ``dim`` row per key) that spreads hot keys over several
    partitions instead of one.

    ``hot`` comes from ``top_hot_keys`` (key and row count ``_n``; None: no key is hot).
    Rows of ``big`` on a hot key get a salt from a hash of the row, ``ceil(_n / salt_rows)``
    buckets per key, and ``dim``'s row for that key is replicated once per bucket, a bounded
    number of extra rows. Hot rows are marked by a broadcast join, so ``big`` is read once
    and the join can be chained without growing the plan. Rows with a null key match
    nothing and are salted too, so that they don't meet in one task.

    Equal rows have equal salts; with ``repeats`` they are counted first, joined once and
    expanded again, so that a row repeated without end is one row of the join. Output:
    ``big``'s columns then ``dim``'s non-key columns.
    """
    vals = [c for c in dim.columns if c != key]
    names = big.columns
    if repeats:
        big = big.groupBy(*names).agg(F.count(F.lit(1)).alias("_times"))
    hashable = [f.name for f in big.schema.fields if "map<" not in f.dataType.simpleString()] or names[:1]
    row = F.xxhash64(*hashable)
    if hot is None:
        b, d = big.withColumn("_buckets", F.lit(1).cast("long")), dim.withColumn("_buckets", F.lit(1).cast("long"))
    else:
        h = F.broadcast(hot.select(key, F.greatest(F.lit(1), F.ceil(F.col("_n") / salt_rows))
                                   .cast("long").alias("_buckets")))
        b, d = (x.join(h, key, "left").withColumn("_buckets", F.coalesce("_buckets", F.lit(1).cast("long"))) for x in (big, dim))
    b = b.withColumn("_salt", F.pmod(row, F.when(F.col(key).isNull(), F.lit(NULL_SALTS)).otherwise(F.col("_buckets"))).cast("long"))
    d = d.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_buckets") - 1)))
    out = b.join(d.drop("_buckets"), [key, "_salt"], how)
    if repeats:
        out = out.withColumn("_again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times"))))
    return out.select(*names, *vals)


def top_k_per_key(df: DataFrame, key: str | list[str], order: list, k: int, rank_col: str = "rank") -> DataFrame:
    """Of each ``key`` the first ``k`` rows by ``order``, numbered from 1 in
    ``rank_col``. Spark keeps ``k`` rows a key and partition before the shuffle, so a hot
    key doesn't move its rows. Ties fall as ``order`` leaves them: end it with a unique
    column for one answer."""
    w = Window.partitionBy(*([key] if isinstance(key, str) else key)).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)
