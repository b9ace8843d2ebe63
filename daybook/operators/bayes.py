"""Counting naive Bayes (survey: A4-A6, M1, M2, J8; job Q-BAY).

The model is two small DataFrames: the class prior and, per (feature, value), the
value's overall frequency and its frequency within the positive class.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.joins import BROADCAST_BYTES, measured_bytes, salted_join, top_hot_keys

# The label among the unpivoted features; no column is called so.
_LABEL = "\x00label"


@dataclass
class BayesModel:
    label_prior: DataFrame   # (label, label_prob)
    features: DataFrame      # (feature, value, feature_prob, cond_prob)
    positive: str


def bayes_fit(df: DataFrame, features: list[str], label: str, positive: str,
              materialize: bool = True) -> BayesModel:
    """M1: priors and likelihoods from one scan and one aggregate.

    The feature columns, and the label as one more, are unpivoted to ``(feature, value)``
    and counted in a single partial aggregate, with the positive-class count as a
    ``count_if`` of the same aggregate (A5 + A6). The counts, one row per distinct value,
    are written with a reliable ``checkpoint`` (``materialize``; the reference collects its
    model to the driver), and totals, likelihoods and prior are derived from them: totals
    are one row per feature column, broadcast.
    ``feature_prob = count / N``; ``cond_prob = count(label = positive) / N_pos``.
    """
    is_pos = F.col(label) == F.lit(positive)
    columns = {**{f: F.col(f) for f in features}, _LABEL: F.col(label)}
    long = df.select(is_pos.alias("_pos"), F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), c.cast("string").alias("value")) for f, c in columns.items()
    ])).alias("_fv")).select("_pos", "_fv.feature", "_fv.value")
    counts = long.groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("_pos")).alias("n_pos"))
    if materialize:
        from daybook.sources.session import checkpoint_dir

        checkpoint_dir(df.sparkSession)
        counts = counts.checkpoint()
    # one row per feature: a broadcast whose size is the number of feature columns
    totals = F.broadcast(counts.groupBy("feature").agg(F.sum("n").alias("t"), F.sum("n_pos").alias("t_pos")))
    probs = counts.join(totals, "feature").select(
        "feature", "value",
        (F.col("n") / F.col("t")).alias("feature_prob"),
        F.try_divide(F.col("n_pos"), F.col("t_pos")).alias("cond_prob"))
    prior = probs.where(F.col("feature") == _LABEL).select(F.col("value").alias("label"), F.col("feature_prob").alias("label_prob"))
    return BayesModel(prior, probs.where(F.col("feature") != _LABEL), positive)


def bayes_score(model: BayesModel, df: DataFrame, id_col: str, features: list[str],
                broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """M2: ``P(pos) * prod P(v | pos) / prod P(v)`` per row, ``(id, probability)``.

    An unseen value contributes 1 to both products (J8); the result is not
    normalised and can exceed 1. One left join per feature against that feature's
    slice of the model; the model is broadcast only when its measured size is within
    ``broadcast_bytes`` (it grows with the number of distinct values). Beyond that
    the joins shuffle, and each feature's common values are salted across partitions
    (``salted_join``) so that a value held by a third of the rows does not land in
    one task. The products
    are evaluated in the reference's order, so values are bit-identical to it.
    """
    small = measured_bytes(model.features) <= broadcast_bytes
    # the class prior is a scalar subquery: evaluated once, no join
    prior = model.label_prior.where(F.col("label") == F.lit(model.positive)).select("label_prob").scalar()
    out = df.select(F.col(id_col).alias("_id"), *[F.col(f).cast("string").alias(f"_v{i}")
                                                  for i, f in enumerate(features)])
    for i, f in enumerate(features):
        part = model.features.where(F.col("feature") == F.lit(f)).select(
            F.col("value").alias(f"_v{i}"), F.col("cond_prob").alias(f"_c{i}"),
            F.col("feature_prob").alias(f"_p{i}"))
        if small:
            out = out.join(F.broadcast(part), f"_v{i}", "left")
        else:
            # a common value (a third of the rows) is a hot join key: salt it
            vals = df.select(F.col(f).cast("string").alias(f"_v{i}"))
            counts = vals.groupBy(f"_v{i}").agg(F.count(F.lit(1)).alias("_n"))
            out = salted_join(out, part, f"_v{i}", top_hot_keys(counts, [f"_v{i}"], "_n"))
    num = F.coalesce(prior, F.lit(1.0))
    den = None
    for i in range(len(features)):
        num = num * F.coalesce(F.col(f"_c{i}"), F.lit(1.0))
        p = F.coalesce(F.col(f"_p{i}"), F.lit(1.0))
        den = p if den is None else den * p
    return out.select(F.col("_id").alias(id_col), (num / den).alias("probability"))
