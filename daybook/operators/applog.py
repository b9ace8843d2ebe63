"""App-log cleansing and enrichment (survey: P6-P11, P17, F11-F14, J3, J4, J9; jobs
Q-GEO and Q-LOG)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType

from daybook.functions.core import geohash, has_identity, java_hash, not_blank, parse_once
from daybook.operators.joins import BROADCAST_BYTES, HOT_MIN_ROWS, measured_bytes, salted_join, skew_join, top_hot_keys

# Fixed value: the "unknown area" default of the reference's record type.
UNKNOWN = "未知"

# Leaf fields of the log record, in the reference's order.
PHONE_FIELDS = ("imei", "imsi", "mac", "osName", "osVer", "androidId", "resolution", "deviceType",
                "deviceId", "uuid")
APP_FIELDS = ("appid", "appVer", "release_ch", "promotion_ch")
LOC_FIELDS = ("longtitude", "latitude", "carrier", "ip", "cid_sn", "netType")
# Id fields that must not all be empty (P10), and the lookup priority.
IDENTITY_RULE_FIELDS = ("uid", "imei", "uuid", "mac", "androidId", "imsi")
GUID_PRIORITY = ("imei", "imsi", "mac", "uid", "androidId", "uuid")
# Output columns of the cleansed record, in the reference's order.
APP_LOG_COLUMNS = ("guid", "eventid", "event", "uid", "imei", "mac", "imsi", "osName", "osVer",
                   "androidId", "resolution", "deviceType", "deviceId", "uuid", "appid", "appVer",
                   "release_ch", "promotion_ch", "longtitude", "latitude", "carrier", "netType",
                   "cid_sn", "ip", "sessionId", "timestamp", "province", "city", "district")


def _struct(names) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


# Every leaf is read as text (a JSON number keeps its text) and converted with try_cast,
# so one bad value rejects only its record.
APP_LOG_SCHEMA = StructType([
    StructField("eventid", StringType()),
    StructField("timestamp", StringType()),
    StructField("event", MapType(StringType(), StringType())),
    StructField("user", StructType([
        StructField("uid", StringType()),
        StructField("sessionId", StringType()),
        StructField("phone", _struct(PHONE_FIELDS)),
        StructField("app", _struct(APP_FIELDS)),
        StructField("loc", _struct(LOC_FIELDS)),
    ])),
])

_INTEGER = r"^[+-]?[0-9]+$"


def _to_long(c: Column) -> Column:
    """``Long.parseLong`` semantics: optional sign and digits only, else null."""
    return F.when(c.rlike(_INTEGER), c.try_cast("long"))


# --------------------------------------------------------------------------- P17, F11-F14
def parse_app_log(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse JSON lines into the flat record; a record is dropped when it is not JSON,
    lacks the ``event``/``user``/``phone``/``app``/``loc`` objects, has a missing or
    non-integer ``timestamp`` or a missing or non-numeric coordinate (P17), has no
    identity (P10), or a blank ``eventid``/``sessionId`` (P11). An empty ``event``
    object is kept. The output has ``APP_LOG_COLUMNS`` minus ``guid`` and the area."""
    j = lines.select(parse_once(F.from_json(F.col(value_col), APP_LOG_SCHEMA, {"mode": "PERMISSIVE"})).alias("j"))
    u = "j.user"
    cols = {
        "eventid": F.col("j.eventid"),
        "event": F.col("j.event"),
        "uid": F.col(f"{u}.uid"),
        **{f: F.col(f"{u}.phone.{f}") for f in PHONE_FIELDS},
        **{f: F.col(f"{u}.app.{f}") for f in APP_FIELDS},
        "longtitude": F.col(f"{u}.loc.longtitude").try_cast("double"),
        "latitude": F.col(f"{u}.loc.latitude").try_cast("double"),
        **{f: F.col(f"{u}.loc.{f}") for f in ("carrier", "netType", "cid_sn", "ip")},
        "sessionId": F.col(f"{u}.sessionId"),
        "timestamp": _to_long(F.col("j.timestamp")),
    }
    present = (F.col(f"{u}.phone").isNotNull() & F.col(f"{u}.app").isNotNull()
               & F.col(f"{u}.loc").isNotNull())
    rec = j.where(present).select(*[c.alias(n) for n, c in cols.items()])
    return rec.where(
        F.col("event").isNotNull()
        & F.col("timestamp").isNotNull()
        & F.col("longtitude").isNotNull() & F.col("latitude").isNotNull()
        & has_identity(*IDENTITY_RULE_FIELDS)
        & not_blank("eventid") & not_blank("sessionId"))


def app_log_rejects(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """The lines that ``parse_app_log`` drops, with all their columns and a ``reason``: the
    first rule that the line breaks, of ``malformed`` (not JSON, or not of its shape),
    ``missing object``, ``timestamp``, ``coordinates`` (P17), ``identity`` (P10),
    ``eventid``, ``sessionId`` (P11). With ``parse_app_log`` it accounts for every line; null
    lines are malformed."""
    schema = StructType([*APP_LOG_SCHEMA.fields, StructField("bad", StringType())])
    parsed = F.from_json(F.col(value_col), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"})
    j = lines.select("*", parse_once(parsed).alias("__j"))
    ids = {f: F.col("__j.user.uid") if f == "uid" else F.col(f"__j.user.phone.{f}") for f in IDENTITY_RULE_FIELDS}
    objects = [F.col(f"__j.{f}") for f in ("event", "user.phone", "user.app", "user.loc")]
    place = [F.col(f"__j.user.loc.{f}").try_cast("double") for f in ("longtitude", "latitude")]
    rules = [("malformed", F.col(value_col).isNotNull() & F.col("__j").isNotNull() & F.col("__j.bad").isNull()),
             ("missing object", objects[0].isNotNull() & objects[1].isNotNull() & objects[2].isNotNull() & objects[3].isNotNull()),
             ("timestamp", _to_long(F.col("__j.timestamp")).isNotNull()),
             ("coordinates", place[0].isNotNull() & place[1].isNotNull()),
             ("identity", has_identity(*ids.values())),
             ("eventid", not_blank("__j.eventid")),
             ("sessionId", not_blank("__j.user.sessionId"))]
    reason = F.coalesce(*[F.when(~holds, F.lit(name)) for name, holds in rules])
    return j.withColumn("reason", reason).where("reason IS NOT NULL").drop("__j")


# --------------------------------------------------------------------------- Q-GEO, J3
def geo_dictionary(points: DataFrame, lat: str = "BD09_LAT", lng: str = "BD09_LNG",
                   area: tuple[str, str, str] = ("province", "city", "district"),
                   precision: int = 5, one_per_cell: bool = True) -> DataFrame:
    """Q-GEO: ``(geo, province, city, district)`` from coordinate points.

    ``one_per_cell=False`` keeps every point as the reference writes it. With the
    default (deviation D7) each cell keeps its most frequent area, ties broken
    alphabetically: one partial aggregate per (cell, area) and one ``min_by`` per cell,
    so the dictionary has exactly one row per key and cannot multiply joined rows.
    Points with out-of-range coordinates have no cell and are left out.
    """
    p, c, d = area
    cells = points.select(geohash(F.col(lat), F.col(lng), precision).alias("geo"),
                          F.col(p).alias("province"), F.col(c).alias("city"), F.col(d).alias("district")
                          ).where(F.col("geo").isNotNull())
    return one_area_per_cell(cells) if one_per_cell else cells


def one_area_per_cell(rows: DataFrame) -> DataFrame:
    """Reduce ``(geo, province, city, district)`` rows to one per cell, the most
    frequent area, ties alphabetical. Idempotent, so it also guards a dictionary that
    may hold a cell twice (the reference's map silently kept one of them)."""
    counted = rows.groupBy("geo", "province", "city", "district").agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy("geo").agg(F.min_by(
        F.struct("province", "city", "district"),
        F.struct((-F.col("n")).alias("k"), "province", "city", "district")).alias("a"))
    return best.select("geo", "a.province", "a.city", "a.district")


def enrich_area(df: DataFrame, geo_dict: DataFrame, lat: str = "latitude", lng: str = "longtitude",
                precision: int = 5, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Add ``province, city, district`` by the record's geohash cell, ``未知`` when
    the cell is unknown. The dictionary is first reduced to one row per cell (D7, a
    small aggregate), so rows never multiply; it is broadcast only when its measured
    size is within ``broadcast_bytes``, otherwise the
    join shuffles with busy cells salted over several partitions (``salted_join``)."""
    from daybook.sources.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    # written once: it is measured, then joined, and is often made from all points
    d = one_area_per_cell(geo_dict.select("geo", "province", "city", "district")).withColumnRenamed("geo", "_geo").checkpoint()
    cells = df.withColumn("_geo", geohash(F.col(lat), F.col(lng), precision))
    if measured_bytes(d) <= broadcast_bytes:
        j = cells.join(F.broadcast(d), "_geo", "left")
    else:
        # shuffle join; a busy cell (a city centre) is salted over several partitions
        counts = cells.groupBy("_geo").agg(F.count(F.lit(1)).alias("_n"))
        j = salted_join(cells, d, "_geo", top_hot_keys(counts, ["_geo"], "_n"), "left")
    j = j.drop("_geo")
    return j.withColumns({c: F.coalesce(F.col(c), F.lit(UNKNOWN)) for c in ("province", "city", "district")})


# --------------------------------------------------------------------------- J4
def guid_of_tuples(tuples: DataFrame, idmap: DataFrame, priority: tuple[str, ...] = GUID_PRIORITY,
                   hot_min: int = HOT_MIN_ROWS) -> DataFrame:
    """J4 for distinct id tuples (the ``priority`` columns, one row each): ``(_k, guid)``,
    ``_k`` the struct of the tuple, for those of which an id is in the dictionary. Ids are
    looked up by name where the dictionary has names, else by hash."""
    named = "name" in idmap.columns
    cand = tuples.select(*priority, F.explode(F.array(*[
        F.struct(F.lit(i).alias("prio"), F.col(c).alias("name")) for i, c in enumerate(priority)
    ])).alias("c")).where("c.name IS NOT NULL").select(*priority, "c.prio", "c.name", java_hash("c.name").alias("h"))
    # one id value can be shared by very many tuples (the empty string hashes to 0)
    cand = cand.checkpoint()
    h_counts = cand.groupBy("h").agg(F.count(F.lit(1)).alias("_n"))
    # one guid per id even if the dictionary repeats an id (the smallest). The join is by hash
    # alone, also where names decide: a table bucketed by the hash stays where it is
    keys = [F.col("biaoshi_hashcode").alias("h"), *([F.col("name").alias("_name")] if named else [])]
    dictionary = idmap.groupBy(*keys).agg(F.min("guid").alias("guid"))
    hits = skew_join(cand, dictionary, "h", top_hot_keys(h_counts, ["h"], "_n", hot_min), "inner")
    if named:
        hits = hits.where(F.col("name") == F.col("_name"))
    return hits.groupBy(F.struct(*priority).alias("_k")).agg(F.min_by("guid", "prio").alias("guid"))


def resolve_guid(df: DataFrame, idmap: DataFrame, priority: tuple[str, ...] = GUID_PRIORITY,
                 hot_min: int = HOT_MIN_ROWS) -> DataFrame:
    """``guid`` from the identity dictionary ``(name, biaoshi_hashcode, guid)``: the
    first of ``priority`` that is in the dictionary, by name, or by hash if it was written
    without names. Null ids are skipped (D6).

    Resolved once per distinct id tuple rather than per record: distinct tuples are
    counted in a pass that reads the id columns alone and written, unpivoted to ``(tuple,
    priority, id)``, equi-joined with the dictionary by hash (no
    broadcast: it grows with the user base; one that is bucketed by the hash is not
    shuffled either), reduced with ``min_by`` over priority,
    and joined back on the tuple (a struct key, so null fields match). The wide
    records shuffle once and are never written; a hot tuple (one device with a huge share
    of the log) is salted over several partitions (``salted_join``). Records without a hit
    get a null ``guid``.
    """
    from daybook.sources.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    counts = df.select(F.struct(*priority).alias("_k")).groupBy("_k").agg(F.count(F.lit(1)).alias("_n")).checkpoint()
    best = guid_of_tuples(counts.select("_k.*"), idmap, priority, hot_min)
    hot = top_hot_keys(counts, ["_k"], "_n", hot_min)  # devices with a huge share of records
    keyed = df.withColumn("_k", F.struct(*priority))  # struct equality matches null fields too
    return salted_join(keyed, best, "_k", hot, "left").drop("_k")


# --------------------------------------------------------------------------- Q-LOG
def cleanse_app_log(lines: DataFrame, geo_dict: DataFrame, idmap: DataFrame,
                    value_col: str = "value") -> DataFrame:
    """Q-LOG: parse, validate, add area and guid, keep records with a guid (P7) and a
    known area (P8). Returns ``APP_LOG_COLUMNS``.

    The log is read twice: once for the distinct id tuples, of which only the table of
    tuples is written, and once for the records, which are joined with their guid and then
    given their area where they lie."""
    rec = resolve_guid(parse_app_log(lines, value_col), idmap).where(F.col("guid").isNotNull())
    rec = enrich_area(rec, geo_dict)
    return rec.where(F.col("province") != F.lit(UNKNOWN)).select(*APP_LOG_COLUMNS)
