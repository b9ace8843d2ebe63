"""Graph operators (survey: X3-X5, A7, G2, G3).

A graph is two DataFrames: vertices ``(id long)`` and edges ``(src long, dst long)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.core import not_blank
from daybook.operators.joins import HOT_MAX_KEYS, HOT_MIN_ROWS, skew_join
from daybook.sources.session import checkpoint_dir


# --------------------------------------------------------------------------- X3, X4
def pairwise(arr: Column, max_width: int | None = None) -> Column:
    """All pairs ``(arr[i], arr[j])`` with ``i < j`` as ``array<struct<src,dst>>``.

    The arrays are the id fields of one record, so the pair count per row is bounded
    by ``width * (width - 1) / 2``. With ``max_width`` the pairs are unrolled into
    plain (code-generated) expressions for arrays up to that width; longer arrays
    still get every pair through the general lambda form.
    """
    n = F.size(arr)
    general = F.flatten(F.transform(
        F.sequence(F.lit(0), n - 2),
        lambda i: F.transform(F.slice(arr, i + 2, n - i - 1),
                              lambda y: F.struct(F.element_at(arr, i + 1).alias("src"), y.alias("dst")))))
    general = F.when(n >= 2, general)
    if not max_width:
        return general
    unrolled = F.array(*[
        F.when(n > j, F.struct(arr[i].alias("src"), arr[j].alias("dst")))
        for i in range(max_width) for j in range(i + 1, max_width)])
    return F.when(n <= max_width, unrolled).otherwise(general)


def chain(arr: Column, checked: bool = True) -> Column:
    """Consecutive pairs ``(arr[i], arr[i+1])``, skipped when ``arr[i]`` is blank
    (``arr[i+1]`` is not checked, so a blank successor links to the empty string). With
    ``checked=False`` the caller skips those itself, after an ``explode``: Spark compiles
    that, while it interprets the lambda here."""
    n = F.size(arr)
    pairs = F.when(n >= 2, F.arrays_zip(F.slice(arr, 1, n - 1).alias("src"), F.slice(arr, 2, n - 1).alias("dst")))
    return F.filter(pairs, lambda p: not_blank(p["src"])) if checked else pairs


# --------------------------------------------------------------------------- A7
def cooccurrence_edges(pairs: DataFrame, min_count: int = 3) -> DataFrame:
    """Directed ``(src, dst)`` pairs seen at least ``min_count`` times (the
    reference keeps ``count > 2``). Partial aggregation combines map-side, so a hot
    pair costs one row per task before the shuffle. Returns ``(src, dst, n)``."""
    return (pairs.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_count))


# --------------------------------------------------------------------------- G2, G3
def graph_vertices(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """The vertex set, including ids seen only as an edge endpoint."""
    return (vertices.select(F.col("id").cast("long").alias("id"))
            .unionByName(edges.select(F.col("src").cast("long").alias("id")))
            .unionByName(edges.select(F.col("dst").cast("long").alias("id")))
            .where(F.col("id").isNotNull())
            .distinct())


def _round_info(e: DataFrame, hot_min: int, max_keys: int = HOT_MAX_KEYS):
    """One job over the checkpointed canonical edge set ``(a > b)``. Returns
    ``(is_star, hot_a, hot_b)``:

    * ``is_star``: every node is either only a larger end with exactly one edge, or only
      a smaller end, i.e. the edges already form stars around each component's
      minimum and the contraction is done;
    * ``hot_a`` / ``hot_b``: nodes that hold at least ``hot_min`` edges and at least one
      ``max_keys``-th of all edges as the larger / smaller end. No more than ``max_keys``
      nodes can, so none is cut off and the driver's traffic is bounded.
    """
    sides = e.select(F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("a").alias("k")),
                                       F.struct(F.lit(1).alias("side"), F.col("b").alias("k")))).alias("s"))
    per_k = sides.groupBy(F.col("s.k").alias("k")).agg(
        F.count_if(F.col("s.side") == 0).alias("na"), F.count_if(F.col("s.side") == 1).alias("nb"))
    least = F.greatest(F.lit(hot_min), F.coalesce(e.agg(F.count(F.lit(1)) / max_keys).scalar(), F.lit(0.0)))
    hot = (per_k.where((F.col("na") >= least) | (F.col("nb") >= least))
           .select(F.lit(0).alias("kind"), "k", F.when(F.col("na") >= least, F.col("na")).alias("na"),
                   F.when(F.col("nb") >= least, F.col("nb")).alias("nb")))
    flags = per_k.agg(F.lit(1).alias("kind"), F.lit(None).cast("long").alias("k"),
                      F.coalesce(F.max("na"), F.lit(0)).alias("na"),
                      F.count_if((F.col("na") > 0) & (F.col("nb") > 0)).alias("nb"))
    rows = hot.unionByName(flags).collect()
    fl = next(r for r in rows if r.kind == 1)
    is_star = fl.na <= 1 and fl.nb == 0
    hot_a = [r.k for r in rows if r.kind == 0 and r.na]
    hot_b = [r.k for r in rows if r.kind == 0 and r.nb]
    return is_star, hot_a, hot_b


def _large_star(e: DataFrame, hot_b: list) -> DataFrame:
    # For every node u, m(u) = min(u, smaller neighbours). Each edge (a > b) is
    # re-emitted from its smaller end b as (a, m(b)). A node that is the smaller end of
    # very many edges (a hub, or the root of a giant star) is a hot join key: its rows
    # are joined map-side against a broadcast of the few hot ``mins`` rows. Duplicates
    # are left for the small-star step's de-duplication (at most one row per input edge).
    mins = e.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "b")
    j = skew_join(e, mins, "b", hot_b, "left")
    return j.select("a", F.coalesce("m", "b").alias("b"))


def _small_star(e: DataFrame, hot_a: list) -> DataFrame:
    # For every node u with smaller neighbours N(u), m = min N(u); link u and every
    # v in N(u) to m. Ordinary nodes get m from a window over their (fewer than
    # ``hot_min``) edges, one shuffle; hot nodes get it from a broadcast of their
    # aggregated minima, and their edges are dealt over many window groups, whose own
    # minima are not used. Large-star keeps every edge's larger end, so the hot ``a``
    # nodes measured before the round still cover this step. With hot nodes the edges are
    # read twice, so the large star is written first.
    per_a = Window.partitionBy("a")
    if hot_a:
        e = e.checkpoint()
        hot_m = F.broadcast(e.where(F.col("a").isin(hot_a)).groupBy("a").agg(F.min("b").alias("hot_m")))
        per_a = Window.partitionBy("a", F.when(F.col("hot_m").isNotNull(), F.pmod(F.xxhash64("b"), F.lit(HOT_MAX_KEYS))))
        j = e.join(hot_m, "a", "left").withColumn("m", F.coalesce("hot_m", F.min("b").over(per_a)))
    else:
        j = e.withColumn("m", F.min("b").over(per_a))
    out = j.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                     F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("p"))
    return out.select("p.a", "p.b").where(F.col("a") != F.col("b")).distinct()


def connected_components(vertices: DataFrame, edges: DataFrame, max_rounds: int = 100,
                         hot_min: int = HOT_MIN_ROWS, inputs_materialized: bool = False,
                         prepared: bool = False) -> DataFrame:
    """``(id, component)`` where ``component`` is the smallest vertex id of its
    connected component (signed comparison); isolated vertices are their own.

    Alternating large-star / small-star contraction (Kiveris et al., SoCC 2014) on a
    canonical edge set ``(a > b)``. Large-star is a partial ``min`` aggregate plus an
    equi-join on the smaller end; small-star is a ``min`` window on the larger end. No
    step collects a neighbour list, and rounds are O(log^2 n) for any diameter. Nodes
    with at least ``hot_min`` edges (hubs, roots of giant components) are found each
    round by one aggregate over the checkpointed edges (at most ``HOT_MAX_KEYS`` per
    side reach the driver); their edges never go into one task: they are joined
    map-side against a broadcast of their few ``min`` rows.

    Inputs are read once: the edge list and the vertex set are written with a
    reliable ``checkpoint`` (into ``spark.checkpoint.dir``) before the loop (skipped
    with ``inputs_materialized`` when the caller already wrote them), and each
    round's edge set is checkpointed too, so lineage stays one round long and a lost
    executor recomputes at most one round. Per round the driver reads one summary
    row (the star-forest test) and the bounded hot-node lists; the loop ends as soon
    as the edges form stars (which the contraction reaches; ``max_rounds`` guards).

    With ``prepared`` the caller has also done the rest: ``vertices`` are different and hold
    both ends of all edges, and ``edges`` are different ones with ``src > dst``. Further
    columns of ``vertices`` are then kept.
    """
    checkpoint_dir(vertices.sparkSession)
    if prepared:
        labels = _stars(edges.select(F.col("src").alias("a"), F.col("dst").alias("b")), max_rounds, hot_min)
        return vertices.join(labels, "id", "left").select(*vertices.columns, F.coalesce("component", "id").alias("component"))
    ed = (edges.select(F.col("src").cast("long").alias("src"), F.col("dst").cast("long").alias("dst"))
          .where(F.col("src").isNotNull() & F.col("dst").isNotNull()))
    vset = graph_vertices(vertices, ed)
    if not inputs_materialized:
        ed = ed.checkpoint()
        vset = graph_vertices(vertices, ed).checkpoint()
    # canonical form of the (materialized) edge list; every later round is checkpointed
    e = (ed.select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b"))
         .where(F.col("a") != F.col("b"))
         .distinct())
    labels = _stars(e, max_rounds, hot_min)
    return vset.join(labels, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def _stars(e: DataFrame, max_rounds: int, hot_min: int) -> DataFrame:
    """``(id, component)`` of every vertex that is not its component's smallest, by rounds
    over the different edges ``(a, b)``, ``a > b``."""
    for _ in range(max_rounds + 1):
        is_star, hot_a, hot_b = _round_info(e, hot_min)
        if is_star:  # stars around each component's minimum: done
            break
        e = _small_star(_large_star(e, hot_b), hot_a).checkpoint()
    else:
        raise RuntimeError(f"connected components did not converge in {max_rounds} rounds")
    # Converged: every non-root node has exactly one edge, to its component minimum.
    return e.select(F.col("a").alias("id"), F.col("b").alias("component"))
