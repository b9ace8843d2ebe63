"""Exact identity components over a dense-id dictionary (survey: G1, G3-G5, F7).

The 32-bit Java hash of an identifier is an output column here, never a vertex: unrelated
strings may share it (``Aa`` and ``BB`` do). Strings become vertices by a 64-bit hash, which
a count shows to be different for all of them, or else by their place in the sorted order
of all different strings. So components never merge by accident, and a dictionary row is
``(name, biaoshi_hashcode, guid)``.

A guid is the smallest hash of its component, as in the reference. Where several components
have the same smallest hash, they are numbered: ``guid = hash + k * 2**32``, with ``k = 0``
for the first by name. So nothing changes where nothing collides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.core import java_hash
from daybook.operators.graph import connected_components, pairwise
from daybook.operators.joins import BROADCAST_BYTES, HOT_MIN_ROWS, measured_bytes, salted_join, skew_join, top_hot_keys
from daybook.sources.session import checkpoint_dir

# Step between the guids of components with the same smallest hash.
_STEP = 1 << 32
_LOW = (1 << 31)


def dense_ids(values: DataFrame, col: str = "name") -> DataFrame:
    """``(col, id)``: the different non-null values of ``col`` with ids 0, 1, ... in their
    sorted order (binary, for strings).

    Values are range-partitioned and sorted; a partition's first id is the number of values
    in those before it. Only one count per partition passes through the driver. The sorted
    values are checkpointed, so their places are the same whenever they are read again.
    """
    spark = values.sparkSession
    checkpoint_dir(spark)
    placed = values.select(col).where(F.col(col).isNotNull()).distinct().repartitionByRange(col).sortWithinPartitions(col).checkpoint()
    # row numbers start at partition << 33
    placed = placed.select(col, F.monotonically_increasing_id().alias("_place")).withColumn("_part", F.shiftright("_place", 33))
    starts, at = [], 0
    for part, n in sorted(tuple(r) for r in placed.groupBy("_part").count().collect()):
        starts.append((part, at - (part << 33)))
        at += n
    if not starts:
        return placed.select(col, F.col("_place").alias("id"))
    first = spark.createDataFrame(starts, "_part long, _first long")
    return placed.join(F.broadcast(first), "_part").select(col, (F.col("_place") + F.col("_first")).alias("id"))


def _ends_of(edges: DataFrame, table: DataFrame, key: str, value: str, hot_min: int) -> DataFrame:
    """Both ends of ``(src, dst)`` replaced by ``table``'s ``value``; an end that very many
    edges share is salted."""
    for end in ("src", "dst"):
        counts = edges.groupBy(end).agg(F.count(F.lit(1)).alias("_n"))
        to = table.select(F.col(key).alias(end), F.col(value).alias("_to"))
        edges = salted_join(edges, to, end, top_hot_keys(counts, [end], "_n", hot_min), "inner").drop(end).withColumnRenamed("_to", end)
    return edges.select("src", "dst")


def _vertex(name: str) -> Column:
    return F.xxhash64(name)


def name_components(names: DataFrame | None, edges: DataFrame, hot_min: int = HOT_MIN_ROWS, whole: bool = False) -> DataFrame:
    """``(name, component)`` of the graph over strings: ``names (name)``, ``edges (src, dst)``
    of names. Names seen only as an end of an edge count too; with ``whole`` the caller says
    that there are none and that ``names`` are materialized, non-null and different.
    ``component`` is a number that the names of a component share. Checkpointed.

    The vertices are 64-bit hashes, so edges get theirs without a join. If any two names
    share a hash, dense ids are joined to the edges instead.
    """
    if whole:
        every = names.select("name")
    else:
        every = edges.select(F.explode(F.array("src", "dst")).alias("name"))
        if names is not None:
            every = names.select("name").unionByName(every)
        every = every.where(F.col("name").isNotNull()).distinct().checkpoint()
    ids = every.select("name", _vertex("name").alias("id"))
    linked = edges.where("src != dst")
    if ids.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        linked = linked.select(_vertex("src").alias("src"), _vertex("dst").alias("dst"))
    else:
        ids = dense_ids(every).checkpoint()
        linked = _ends_of(linked.distinct(), ids, "name", "id", hot_min)
    linked = linked.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct().checkpoint()
    return connected_components(ids, linked, hot_min=hot_min, prepared=True).select("name", "component").checkpoint()


def _numbered(candidates: DataFrame, order: Column, taken: Column | None = None) -> Column:
    """The guid of a component whose smallest hash is ``h``: the hash, plus a step for each
    component before it, by ``order``, that has the same one (and for those ``taken``)."""
    k = F.row_number().over(Window.partitionBy("h").orderBy(order)) - 1
    return F.col("h") + (k if taken is None else k + taken) * F.lit(_STEP)


def component_guids(comp: DataFrame) -> DataFrame:
    """``(component, guid, _n)`` of ``name_components`` rows."""
    per = comp.select("component", "name", java_hash("name").alias("h")).groupBy("component").agg(
        F.min("h").alias("h"), F.min("name").alias("_first"), F.count(F.lit(1)).alias("_n"))
    return per.select("component", _numbered(per, F.col("_first")).alias("guid"), "_n").checkpoint()


def name_graph(ids: DataFrame, ids_col: str, min_count: int, max_width: int) -> tuple[DataFrame, DataFrame]:
    """Names ``(name, n)`` and the directed pairs ``(src, dst)`` seen at least ``min_count``
    times, from one pass and one partial aggregate over the records."""
    checkpoint_dir(ids.sparkSession)
    a = F.col(ids_col)
    entries = F.concat(
        F.transform(a, lambda x: F.struct(x.alias("src"), F.lit(None).cast("string").alias("dst"))),
        F.coalesce(pairwise(a, max_width), F.array().cast("array<struct<src:string,dst:string>>")))
    g = (ids.select(F.explode_outer(entries).alias("p")).where(F.col("p.src").isNotNull())
         .groupBy("p.src", "p.dst").agg(F.count(F.lit(1)).alias("n")).checkpoint())
    names = g.where(F.col("dst").isNull()).select(F.col("src").alias("name"), "n")
    return names, g.where(F.col("dst").isNotNull() & (F.col("n") >= min_count)).select("src", "dst")


def build(names: DataFrame, edges: DataFrame, hot_min: int = HOT_MIN_ROWS) -> DataFrame:
    """A first dictionary ``(name, biaoshi_hashcode, guid)``."""
    comp = name_components(names, edges, hot_min, whole=True)
    guids = component_guids(comp)
    hot = top_hot_keys(guids, ["component"], "_n", hot_min)  # a giant component
    return (skew_join(comp, guids.drop("_n"), "component", hot, "inner")
            .select("name", java_hash("name").alias("biaoshi_hashcode"), "guid"))


def _low(guid: Column) -> Column:
    """The hash in a guid, without the steps above it."""
    return F.pmod(guid + _LOW, F.lit(_STEP)) - _LOW


def look_up(prev: DataFrame, names: DataFrame) -> DataFrame:
    """``(name, h, guid, taken)`` of today's names: the guid that ``prev`` has for the name
    (null for a new one), and for new names how many guids their hash ``h`` has already.

    One join by hash tells both; a ``prev`` bucketed by ``biaoshi_hashcode`` isn't shuffled.
    """
    of_hash = prev.select("biaoshi_hashcode", F.col("name").alias("_name"), F.col("guid").alias("_guid"))
    same = F.col("_name") == F.col("name")
    # a stranger's row with this hash: the hash may have been a guid even if it is none now
    taken = F.when(_low(F.col("_guid")) == F.col("h"), F.floor((F.col("_guid") - F.col("h")) / F.lit(_STEP)) + 1).otherwise(F.lit(1))
    taken = F.when(F.col("_guid").isNotNull() & ~same, taken)
    return (names.select("name", java_hash("name").alias("h")).join(of_hash, F.col("h") == F.col("biaoshi_hashcode"), "left").groupBy("name", "h")
            .agg(F.max(F.when(same, F.col("_guid"))).alias("guid"), F.coalesce(F.max(taken), F.lit(0)).cast("long").alias("taken")))


def roll(prev: DataFrame, names: DataFrame, edges: DataFrame, hot_min: int = HOT_MIN_ROWS) -> DataFrame:
    """Yesterday's dictionary ``prev`` with today's ``names`` and ``edges``, without
    recomputing it: the rows that a full computation over both days gives.

    Today's names are looked up in ``prev`` once. An edge between known names becomes an edge
    between their guids; only the contracted edges between different guids and new names go
    through the rounds. A component keeps the smallest of its guids (deviation D3). Guids
    that lost theirs to a smaller one are a table of their own, which ``prev`` is joined
    with once (broadcast where its measured size allows); all other rows pass unchanged.
    """
    seen = look_up(prev, names).withColumn(
        "node", F.when(F.col("guid").isNull(), F.concat(F.lit("~"), "name")).otherwise(F.concat(F.lit("="), F.col("guid").cast("string")))).checkpoint()
    contracted = _ends_of(edges.where("src != dst"), seen, "name", "node", hot_min).where("src != dst").distinct().checkpoint()
    comp = name_components(None, contracted, hot_min).withColumnRenamed("name", "node")

    known = F.when(F.col("node").startswith("="), F.col("node").substr(F.lit(2), F.length("node")).cast("long"))
    kept = comp.withColumn("_g", known).groupBy("component").agg(F.min("_g").alias("old"), F.count(F.lit(1)).alias("_n")).checkpoint()
    hot = top_hot_keys(kept, ["component"], "_n", hot_min)
    placed = salted_join(comp, kept.drop("_n"), "component", hot, "inner").checkpoint()  # node, component, old

    fresh = seen.where(F.col("guid").isNull()).join(placed, "node", "left")
    # a new component has only new names: one that no edge reaches is a component by itself
    fresh = fresh.withColumn("part", F.when(F.col("component").isNull(), F.col("node")).otherwise(F.col("component").cast("string"))).checkpoint()
    first = fresh.where(F.col("old").isNull()).groupBy("part").agg(
        F.min(F.struct("h", "taken")).alias("x"), F.min("name").alias("_first"), F.count(F.lit(1)).alias("_n"))
    first = first.select("part", F.col("x.h").alias("h"), F.col("x.taken").alias("taken"), "_first", "_n")
    first = first.select("part", _numbered(first, F.col("_first"), F.col("taken")).alias("made"), "_n").checkpoint()
    added = salted_join(fresh, first.drop("_n"), "part", top_hot_keys(first, ["part"], "_n", hot_min), "left")
    added = added.select("name", F.col("h").alias("biaoshi_hashcode"), F.coalesce("old", "made").alias("guid"))

    moved = placed.select(known.alias("guid"), "old").where(F.col("guid").isNotNull() & (F.col("guid") != F.col("old")))
    was = prev.select("name", "biaoshi_hashcode", "guid")
    if measured_bytes(moved) <= BROADCAST_BYTES:
        now = was.join(F.broadcast(moved), "guid", "left")
    else:
        counts = was.join(moved, "guid", "left_semi").groupBy("guid").agg(F.count(F.lit(1)).alias("_n"))
        now = salted_join(was, moved, "guid", top_hot_keys(counts, ["guid"], "_n", hot_min), "left")
    return now.select("name", "biaoshi_hashcode", F.coalesce("old", "guid").alias("guid")).unionByName(added)
