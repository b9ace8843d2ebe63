"""Identity mapping (survey: G1, G4, G5, J5, J6; jobs Q-IDM, Q-IDR, Q-LINK).

The reference keys every identifier by its 32-bit Java hash (F7). Here that hash is an
output: components are found over the strings themselves (``operators.identity``). The hashed
graph (``id_vertices``, ``id_edges``, ``id_graph``) is kept for its counts, and for rolling a
dictionary that was written without names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from daybook.functions.core import java_hash, not_blank, parse_once
from daybook.operators import identity
from daybook.operators.graph import chain, connected_components, cooccurrence_edges, pairwise
from daybook.operators.joins import HOT_MIN_ROWS, salted_join, skew_join, top_hot_keys
from daybook.sources.session import checkpoint_dir

# Identifier fields of a log record, in the reference's order.
ID_FIELDS = ("uid", "imei", "mac", "imsi", "androidId", "deviceId", "uuid")
# Device fields read from ``user.phone`` (falling back to ``user``).
PHONE_ID_FIELDS = ("imei", "mac", "imsi", "androidId", "deviceId", "uuid")

_ID_SCHEMA = StructType([
    StructField("user", StructType(
        [StructField("uid", StringType())]
        + [StructField(f, StringType()) for f in PHONE_ID_FIELDS]
        + [StructField("phone", StructType([StructField(f, StringType()) for f in PHONE_ID_FIELDS]))])),
])


# --------------------------------------------------------------------------- G1
def extract_ids(lines: DataFrame, value_col: str = "value", phone_first: bool = True) -> DataFrame:
    """G1: ``ids array<string>`` of the non-blank identifiers of each JSON log line,
    in ``ID_FIELDS`` order.

    Deviation D2: the reference reads the device ids from ``user.*`` here but from
    ``user.phone.*`` in the cleanse job; we take ``user.phone.f`` and fall back to
    ``user.f`` (``phone_first=False`` reverses that). Lines that are not JSON yield an
    empty array instead of failing the job.
    """
    parsed = lines.select(parse_once(F.from_json(F.col(value_col), _ID_SCHEMA, {"mode": "PERMISSIVE"})).alias("j"))
    cols: list[Column] = []
    for f in ID_FIELDS:
        if f == "uid":
            cols.append(F.col("j.user.uid"))
        elif phone_first:
            cols.append(F.coalesce(F.col(f"j.user.phone.{f}"), F.col(f"j.user.{f}")))
        else:
            cols.append(F.coalesce(F.col(f"j.user.{f}"), F.col(f"j.user.phone.{f}")))
    return parsed.select(F.filter(F.array(*cols), lambda x: not_blank(x)).alias("ids"))


# --------------------------------------------------------------------------- X5, X3+A7
def id_vertices(ids: DataFrame, ids_col: str = "ids") -> DataFrame:
    """Distinct ``(id, name)`` vertices: hash and the id string."""
    return (ids.select(F.explode(ids_col).alias("name"))
            .select(java_hash("name").alias("id"), "name")
            .dropDuplicates(["id"]))


def _hashed(ids: DataFrame, ids_col: str) -> Column:
    return F.transform(F.col(ids_col), lambda x: java_hash(x))


def id_edges(ids: DataFrame, ids_col: str = "ids", min_count: int = 3,
             max_width: int = len(ID_FIELDS)) -> DataFrame:
    """X3 + A7: directed hashed pairs (field order) seen at least ``min_count`` times.
    Ids are hashed once per record, then paired."""
    hashed = ids.select(_hashed(ids, ids_col).alias("h"))  # hashed once, referenced by column
    pairs = (hashed.select(F.explode_outer(pairwise(F.col("h"), max_width)).alias("p"))
             .where(F.col("p").isNotNull())
             .select("p.src", "p.dst"))
    return cooccurrence_edges(pairs, min_count)


def id_graph(ids: DataFrame, ids_col: str = "ids", min_count: int = 3,
             max_width: int = len(ID_FIELDS)) -> tuple[DataFrame, DataFrame]:
    """X5 + X3 + A7 in one pass over the records: each record emits its vertices as
    ``(id, null)`` and its pairs as ``(src, dst)``; one partial aggregate counts both,
    and the (much smaller) result is checkpointed. Returns ``(vertices, edges)``."""
    checkpoint_dir(ids.sparkSession)
    hashed = ids.select(_hashed(ids, ids_col).alias("h"))  # hashed once, referenced by column
    h = F.col("h")
    entries = F.concat(
        F.transform(h, lambda x: F.struct(x.alias("src"), F.lit(None).cast("long").alias("dst"))),
        F.coalesce(pairwise(h, max_width), F.array().cast("array<struct<src:bigint,dst:bigint>>")))
    g = (hashed.select(F.explode_outer(entries).alias("p"))
         .where(F.col("p").isNotNull())
         .groupBy("p.src", "p.dst").agg(F.count(F.lit(1)).alias("n"))
         .checkpoint())
    vertices = g.where(F.col("dst").isNull()).select(F.col("src").alias("id"))
    edges = g.where(F.col("dst").isNotNull() & (F.col("n") >= min_count)).select("src", "dst")
    return vertices, edges


# --------------------------------------------------------------------------- Q-IDM / Q-IDR
def identity_dictionary(ids: DataFrame, prev: DataFrame | None = None, ids_col: str = "ids", min_count: int = 3,
                        hot_min: int = HOT_MIN_ROWS, max_width: int = len(ID_FIELDS)) -> DataFrame:
    """Q-IDM (``prev=None``) and Q-IDR: ``(name, biaoshi_hashcode, guid)`` for every
    identifier string.

    ``guid`` is the smallest hash of the connected component; components that share it are
    numbered (``operators.identity``). With yesterday's dictionary ``prev`` (G4, G5/J6) only
    today's links are contracted over yesterday's guids; a component that contains ids
    known yesterday keeps the smallest of their guids (deviation D3: the reference takes
    whichever it meets first).
    """
    names, edges = identity.name_graph(ids, ids_col, min_count, max_width)
    return identity.build(names, edges, hot_min) if prev is None else identity.roll(prev, names, edges, hot_min)


def identity_map(ids: DataFrame, prev: DataFrame | None = None, ids_col: str = "ids",
                 min_count: int = 3, hot_min: int = HOT_MIN_ROWS) -> DataFrame:
    """The ``(biaoshi_hashcode, guid)`` columns of ``identity_dictionary``, a row for every
    identifier string.

    A ``prev`` without the column ``name`` was written by hash alone: it is rolled by hash
    too, each of its rows a vertex and an edge ``id -> guid`` (no threshold) of one
    computation over both days, and ids whose hashes collide merge, as in the reference.
    """
    if prev is None or "name" in prev.columns:
        return identity_dictionary(ids, prev, ids_col, min_count, hot_min).select("biaoshi_hashcode", "guid")
    vertices, edges = id_graph(ids, ids_col, min_count)
    vertices = vertices.unionByName(prev.select(F.col("biaoshi_hashcode").alias("id")))
    edges = edges.unionByName(prev.select(F.col("biaoshi_hashcode").alias("src"), F.col("guid").alias("dst")))
    return stabilise_guid(connected_components(vertices, edges, hot_min=hot_min), prev, hot_min)


def stabilise_guid(comp: DataFrame, prev: DataFrame, hot_min: int = HOT_MIN_ROWS) -> DataFrame:
    """Per component, the minimum previous guid of its members when any member
    was in yesterday's dictionary, else the component id.

    A left join on the id, a partial ``min`` per component and a join back on the
    component; nothing is collected per component. A giant component is combined
    map-side, and its join-back rows are salted over several partitions instead of
    being shuffled into one task.
    """
    p = prev.select(F.col("biaoshi_hashcode").alias("id"), F.col("guid").alias("prev_guid"))
    tagged = comp.join(p, "id", "left")
    per_comp = tagged.groupBy("component").agg(F.min("prev_guid").alias("old"),
                                                F.count(F.lit(1)).alias("_n"))
    hot = top_hot_keys(per_comp, ["component"], "_n", hot_min)  # giant components
    return (salted_join(comp, per_comp.select("component", "old"), "component", hot, "left")
            .select(F.col("id").alias("biaoshi_hashcode"),
                    F.coalesce("old", "component").alias("guid")))


# --------------------------------------------------------------------------- Q-LINK
def split_fields(value: Column, sep: str = ",") -> Column:
    """``String.split`` semantics (``sep`` is a regular expression, as there):
    trailing empty fields are dropped."""
    return F.split(F.regexp_replace(value, f"(?:{sep})+$", ""), sep)


def link_lines(lines: DataFrame, value_col: str = "value", sep: str = ",",
               hot_min: int = HOT_MIN_ROWS) -> DataFrame:
    """Q-LINK: tag each delimited line with the group id of the first non-blank field:
    ``(gid, line)``.

    Vertices are the non-blank fields; edges chain field i to field i+1 when field i
    is not blank (X4); groups are connected components over the field strings (G3), their id
    the smallest hash as in ``operators.identity``; the tag is an equi-join on the first
    non-blank field (J5). A line without any non-blank field gets a null ``gid`` (the
    reference fails the job). Equal lines are counted and joined once.
    """
    checkpoint_dir(lines.sparkSession)
    f = lines.select(F.col(value_col).alias("line"), split_fields(F.col(value_col), sep).alias("fields"))
    # one pass over the lines: vertices as (name, null), chained pairs as (src, dst)
    none = F.array().cast("array<string>")
    entries = F.concat(F.arrays_zip(F.col("fields").alias("src"), none.alias("dst")),
                       F.coalesce(chain(F.col("fields"), checked=False), F.array().cast("array<struct<src:string,dst:string>>")))
    g = (f.select(F.inline(entries)).where(not_blank("src"))
         .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("_n"))
         .checkpoint())
    names = g.where(F.col("dst").isNull()).select(F.col("src").alias("name"), "_n")
    edges = g.where(F.col("dst").isNotNull()).select("src", "dst")
    # of the ends of edges only blank ones are no vertices yet
    blanks = edges.where(~not_blank("dst")).select(F.col("dst").alias("name")).distinct().checkpoint()
    comp = identity.name_components(names.select("name").unionByName(blanks), edges, hot_min, whole=True)
    guids = identity.component_guids(comp)
    tagged = skew_join(comp, guids.drop("_n"), "component", top_hot_keys(guids, ["component"], "_n", hot_min), "inner")
    first = f.select("line", F.try_element_at(F.filter("fields", lambda x: not_blank(x)), F.lit(1)).alias("name"))
    # a field's count over all lines bounds its count as a first field: hot candidates
    # come from the checkpointed graph, without another pass over the lines
    hot = top_hot_keys(names, ["name"], "_n", hot_min)
    return (salted_join(first, tagged.select("name", "guid"), "name", hot, "left", repeats=True)
            .select(F.col("guid").alias("gid"), "line"))
