"""Driver queries for the geo dictionary and the app-log cleanse (F6, F7, F15, Q-GEO,
Q-LOG, U1).

The app log is rendered from ``events`` joined with ``customer``: one JSON line per
event. The event's ``value`` decides which defect, if any, a line carries, so every
reject rule of the cleanse is exercised by the whole table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook import sources
from daybook.functions.core import geohash, hash_bucket, java_hash
from daybook.operators import applog, idmap
from daybook.plans.registry import register
from daybook.plans.sqlutil import cc_sql, geohash_sql, jh
from daybook.plans.tables import table


# --------------------------------------------------------------------------- coordinates
def _cust_lat(c: str = "") -> Column:
    return F.col(f"{c}c_nationkey") * 6.5 - 80.0 + (F.col(f"{c}c_custkey") % 5) * 0.013


def _cust_lng(c: str = "") -> Column:
    return F.col(f"{c}c_nationkey") * 13.7 - 170.0 + (F.col(f"{c}c_custkey") % 3) * 0.021


_LAT_SQL = "(c_nationkey * CAST(6.5 AS DOUBLE) - CAST(80.0 AS DOUBLE) + (c_custkey % 5) * CAST(0.013 AS DOUBLE))"
_LNG_SQL = "(c_nationkey * CAST(13.7 AS DOUBLE) - CAST(170.0 AS DOUBLE) + (c_custkey % 3) * CAST(0.021 AS DOUBLE))"


def geo_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer points with area names: region -> province, nation -> city,
    market segment -> district."""
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    return (c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select(_cust_lat().alias("BD09_LAT"), _cust_lng().alias("BD09_LNG"),
                    F.col("r_name").alias("province"), F.col("n_name").alias("city"),
                    F.col("c_mktsegment").alias("district")))


_POINTS_SQL = f"""SELECT {_LAT_SQL} AS lat, {_LNG_SQL} AS lng, r_name AS province, n_name AS city,
       c_mktsegment AS district
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

_GEO_DICT_SQL = f"""WITH p AS ({_POINTS_SQL}),
c AS (SELECT {geohash_sql('lat', 'lng')} AS geo, province, city, district FROM p),
n AS (SELECT geo, province, city, district, count(*) AS n FROM c WHERE geo IS NOT NULL GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY geo ORDER BY n DESC, province, city, district) AS rn FROM n)
SELECT geo, province, city, district FROM r WHERE rn = 1"""


@register("q_geo_dict", _GEO_DICT_SQL)
def q_geo_dict(spark, sf_dir):
    """Q-GEO with one row per cell."""
    return applog.geo_dictionary(geo_points(spark, sf_dir))


@register("q_geo_points", f"""WITH p AS ({_POINTS_SQL})
SELECT {geohash_sql('lat', 'lng')} AS geo, province, city, district FROM p
WHERE {geohash_sql('lat', 'lng')} IS NOT NULL""")
def q_geo_points(spark, sf_dir):
    """Q-GEO as the reference writes it: every point, duplicates kept."""
    return applog.geo_dictionary(geo_points(spark, sf_dir), one_per_cell=False)


_GH_LAT = "(c_acctbal * CAST(0.0175 AS DOUBLE) - CAST(87.5 AS DOUBLE))"
_GH_LNG = "(CAST((c_custkey * 37) % 360 AS DOUBLE) - CAST(179.5 AS DOUBLE))"


@register("q_geohash", f"""SELECT c_custkey, {geohash_sql(_GH_LAT, _GH_LNG)} AS geo,
  {geohash_sql(_GH_LAT, _GH_LNG, 8)} AS geo8 FROM customer""")
def q_geohash(spark, sf_dir):
    """F6 over every customer; balances below about -143 put the point south of the
    pole, which gives a null cell (D6)."""
    c = table(spark, sf_dir, "customer")
    lat = F.col("c_acctbal") * 0.0175 - 87.5
    lng = ((F.col("c_custkey") * 37) % 360).cast("double") - 179.5
    return c.select("c_custkey", geohash(lat, lng).alias("geo"), geohash(lat, lng, 8).alias("geo8"))


@register("q_java_hash", f"""SELECT p_partkey, {jh('p_name')} AS h,
  CAST(({jh('p_name')} & 2147483647) % 20 AS INTEGER) AS bucket FROM part""")
def q_java_hash(spark, sf_dir):
    """F7 + F8 over every part name."""
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", java_hash("p_name").alias("h"), hash_bucket("p_name", 20).alias("bucket"))


@register("q_md5", "SELECT c_custkey, md5(c_name) AS digest FROM customer")
def q_md5(spark, sf_dir):
    """F15."""
    return table(spark, sf_dir, "customer").select("c_custkey", F.md5("c_name").alias("digest"))


# --------------------------------------------------------------------------- app log lines
def _q(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def _kv(k: str, v: Column) -> Column:
    return F.concat(F.lit(f'"{k}":'), v)


def app_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON line per event (``value``). Defects by ``floor(value)``: 0 blank
    eventid, 1 quoted timestamp (valid), 2 no ``event``, 3 empty ``event`` (valid), 4 only
    a deviceId and a full-width blank uid, 5 quoted latitude (valid), 6 latitude ``abc``, 7 not JSON, 8 latitude
    out of range, 9 shifted longitude (unknown cell), 10 no imei, 11 blank sessionId.
    Blanks are plain spaces or the
    empty string in one line, full-width or em spaces in the next. Users without a customer
    row have no ``loc`` object."""
    e = table(spark, sf_dir, "events")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = e.join(c, e.user_id == c.c_custkey, "left")
    cat = F.floor("value").cast("int")
    uid = F.col("user_id").cast("string")
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    millis = F.floor(micros / 1000).cast("long")
    lat, lng = _cust_lat(), _cust_lng()
    lat_txt = (F.when(cat == 5, _q(lat.cast("string"))).when(cat == 6, F.lit('"abc"'))
               .when(cat == 8, (lat + 200.0).cast("string")).otherwise(lat.cast("string")))
    lng_txt = F.when(cat == 9, (lng + 90.0).cast("string")).otherwise(lng.cast("string"))
    odd = F.col("event_id") % 2 == 1
    phone = F.concat_ws(",",
                        F.when(~cat.isin(4, 10), _kv("imei", _q(F.concat(F.lit("imei-"), uid)))),
                        F.when(cat != 4, _kv("mac", _q(F.concat(F.lit("mac-"), (F.col("user_id") / 2).cast("long").cast("string"))))),
                        _kv("osName", F.lit('"android"')),
                        _kv("deviceId", _q(F.concat(F.lit("dev-"), uid))))
    user = F.concat_ws(",",
                       _kv("uid", _q(F.when(cat == 4, F.lit("\u3000")).otherwise(F.concat(F.lit("u"), uid)))),
                       _kv("sessionId", _q(F.when((cat == 11) & odd, F.lit("\u2003")).when(cat == 11, F.lit("  ")).otherwise(
                           F.concat(F.lit("s"), uid, F.lit("-"), F.date_format("ts", "yyyyMMdd"))))),
                       _kv("phone", F.concat(F.lit("{"), phone, F.lit("}"))),
                       _kv("app", F.lit('{"appid":"cn.app","appVer":"2.1"}')),
                       F.when(F.col("c_custkey").isNotNull(), _kv("loc", F.concat(
                           F.lit("{"), _kv("longtitude", lng_txt), F.lit(","), _kv("latitude", lat_txt),
                           F.lit(',"carrier":"cm","netType":"wifi"}')))))
    body = F.concat_ws(",",
                       _kv("eventid", _q(F.when((cat == 0) & odd, F.lit("\u3000 ")).when(cat == 0, F.lit("")).otherwise(F.col("event_type")))),
                       _kv("timestamp", F.when(cat == 1, _q(millis.cast("string"))).otherwise(millis.cast("string"))),
                       F.when(cat == 3, _kv("event", F.lit("{}"))).when(cat != 2, _kv("event", F.col("props"))),
                       _kv("user", F.concat(F.lit("{"), user, F.lit("}"))))
    line = F.when(cat == 7, F.concat(F.lit("#corrupt "), F.col("event_id").cast("string"))).otherwise(
        F.concat(F.lit("{"), body, F.lit("}")))
    return j.select(line.alias("value"))


def written_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of ``app_log_lines``, written once: the log is read by several passes, and
    rendering a line costs as much as parsing it."""
    path = f"{sources.checkpoint_dir(spark).rstrip('/')}/daybook-applog-{uuid.uuid4().hex}"
    sources.write_parquet(app_log_lines(spark, sf_dir), path)
    return sources.read_parquet(spark, path)


# Oracle side: the same rules applied to the event columns directly.
_LOG_ROWS_SQL = f"""
ev AS (SELECT e.*, CAST(floor(value) AS INTEGER) AS cat, c.c_custkey, {_LAT_SQL} AS lat0, {_LNG_SQL} AS lng0
       FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey),
ids AS (SELECT CASE WHEN cat <> 4 THEN 'u' || user_id END AS uid,
               CASE WHEN cat NOT IN (4, 10) THEN 'imei-' || user_id END AS imei,
               CASE WHEN cat <> 4 THEN 'mac-' || (user_id // 2) END AS mac,
               'dev-' || user_id AS dev
        FROM ev WHERE cat <> 7),
lst AS (SELECT list_filter([uid, imei, mac, dev], lambda x: x IS NOT NULL) AS l FROM ids),
prs AS (SELECT l[i] AS a, l[j] AS b FROM lst, range(1, len(l) + 1) r1(i), range(i + 1, len(l) + 1) r2(j)),
vx AS (SELECT {jh('x')} AS id FROM (SELECT unnest(l) AS x FROM lst)),
ex AS (SELECT {jh('a')} AS src, {jh('b')} AS dst FROM prs GROUP BY 1, 2 HAVING count(*) >= 3),"""

_APPLOG_SQL = f"""WITH RECURSIVE {_LOG_ROWS_SQL}
{cc_sql('cc', 'SELECT id FROM vx', 'SELECT src, dst FROM ex')},
p AS ({_POINTS_SQL}),
gc AS (SELECT {geohash_sql('lat', 'lng')} AS geo, province, city, district FROM p),
gn AS (SELECT geo, province, city, district, count(*) AS n FROM gc WHERE geo IS NOT NULL GROUP BY ALL),
gd AS (SELECT geo, province, city, district FROM
        (SELECT *, row_number() OVER (PARTITION BY geo ORDER BY n DESC, province, city, district) AS rn FROM gn)
       WHERE rn = 1),
ok AS (SELECT *, CASE WHEN cat = 8 THEN lat0 + 200.0 ELSE lat0 END AS lat,
              CASE WHEN cat = 9 THEN lng0 + 90.0 ELSE lng0 END AS lng
       FROM ev WHERE c_custkey IS NOT NULL AND cat NOT IN (0, 2, 4, 6, 7, 11)),
rec AS (SELECT ok.*, {geohash_sql('lat', 'lng')} AS geo,
               'u' || user_id AS uid, CASE WHEN cat <> 10 THEN 'imei-' || user_id END AS imei,
               'mac-' || (user_id // 2) AS mac FROM ok)
SELECT coalesce(g1.comp, g2.comp, g3.comp) AS guid, event_type AS eventid,
       CASE WHEN cat = 3 THEN NULL ELSE json_extract_string(props, '$.k') END AS event_k,
       rec.uid, rec.imei, rec.mac, 'dev-' || user_id AS deviceId, lng AS longtitude, lat AS latitude,
       's' || user_id || '-' || strftime(ts, '%Y%m%d') AS sessionId, CAST(floor(epoch_us(ts) / 1000) AS BIGINT) AS timestamp,
       gd.province, gd.city, gd.district
FROM rec JOIN gd ON rec.geo = gd.geo
LEFT JOIN cc g1 ON g1.id = {jh('rec.imei')}
LEFT JOIN cc g2 ON g2.id = {jh('rec.mac')}
LEFT JOIN cc g3 ON g3.id = {jh('rec.uid')}
WHERE coalesce(g1.comp, g2.comp, g3.comp) IS NOT NULL"""


@register("q_applog", _APPLOG_SQL)
def q_applog(spark, sf_dir):
    """Q-LOG end to end: identity dictionary from the same day's lines (Q-IDM), geo
    dictionary from customer points (Q-GEO), then the cleanse."""
    lines = written_log(spark, sf_dir)
    ids = idmap.identity_dictionary(idmap.extract_ids(lines))
    geo = applog.geo_dictionary(geo_points(spark, sf_dir))
    out = applog.cleanse_app_log(lines, geo, ids)
    return out.select("guid", "eventid", F.col("event")["k"].alias("event_k"), "uid", "imei", "mac",
                      "deviceId", "longtitude", "latitude", "sessionId", "timestamp",
                      "province", "city", "district")


@register("q_rejects", f"""WITH ev AS (SELECT e.*, CAST(floor(value) AS INTEGER) AS cat, c.c_custkey FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey),
log AS (SELECT CASE WHEN cat = 7 THEN 'malformed' WHEN cat = 2 OR c_custkey IS NULL THEN 'missing object' WHEN cat = 6 THEN 'coordinates'
                    WHEN cat = 4 THEN 'identity' WHEN cat = 0 THEN 'eventid' WHEN cat = 11 THEN 'sessionId' END AS reason FROM ev),
csv AS (SELECT CASE o_orderkey % 7 WHEN 0 THEN 'short row' WHEN 1 THEN 'cell price' WHEN 2 THEN 'long row' WHEN 3 THEN 'cell day' END AS reason FROM orders)
SELECT 'log' AS source, reason, count(*) AS n FROM log WHERE reason IS NOT NULL GROUP BY reason
UNION ALL SELECT 'log', 'parsed', count(*) FROM log WHERE reason IS NULL
UNION ALL SELECT 'csv', reason, count(*) FROM csv WHERE reason IS NOT NULL GROUP BY reason
UNION ALL SELECT 'csv rows', 'all', count(*) FROM csv
UNION ALL SELECT 'csv rows', 'no price', count(*) FROM csv WHERE reason IN ('short row', 'cell price')
UNION ALL SELECT 'csv rows', 'no day', count(*) FROM csv WHERE reason IN ('short row', 'cell day')""")
def q_rejects(spark, sf_dir):
    """How many lines of a malformed CSV of all orders and of the app log are
    rejected, by reason, beside what the reads themselves return."""
    o = table(spark, sf_dir, "orders")
    turn = F.col("o_orderkey") % 7
    price = F.when(turn == 1, F.lit("abc")).otherwise(F.col("o_totalprice").cast("string"))
    day = F.when(turn == 3, F.lit("no day")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    line = F.when(turn == 0, F.concat_ws(",", "o_orderkey", "o_custkey")).when(turn == 2, F.concat_ws(",", "o_orderkey", "o_custkey", price, day, F.lit("more")))
    line = line.otherwise(F.concat_ws(",", "o_orderkey", "o_custkey", price, day))
    path = f"{sources.checkpoint_dir(spark).rstrip('/')}/daybook-rejects-{uuid.uuid4().hex}"
    o.select(line.alias("value")).write.text(path)
    schema = "order_id long, customer_id long, price double, day date"
    csv = sources.csv_rejects(spark, path, schema, header=False)
    rows = sources.read_csv(spark, path, schema, header=False)
    lines = app_log_lines(spark, sf_dir)

    def counted(df: DataFrame, source: str, reason: Column) -> DataFrame:
        return df.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(source).alias("source"), "reason", "n")

    return (counted(applog.app_log_rejects(lines), "log", F.col("reason"))
            .unionByName(counted(applog.parse_app_log(lines), "log", F.lit("parsed")))
            .unionByName(counted(csv, "csv", F.col("reason")))
            .unionByName(counted(rows, "csv rows", F.lit("all")))
            .unionByName(counted(rows.where("price IS NULL"), "csv rows", F.lit("no price")))
            .unionByName(counted(rows.where("day IS NULL"), "csv rows", F.lit("no day"))))


@register("q_union_logs", """SELECT event_id, user_id, event_type FROM events WHERE event_type IN ('view', 'click')
UNION ALL SELECT event_id, user_id, event_type FROM events WHERE event_type = 'purchase'
UNION ALL SELECT event_id, user_id, event_type FROM events WHERE event_type NOT IN ('view', 'click', 'purchase')""")
def q_union_logs(spark, sf_dir):
    """Bag union of three log sources (here three partitions of ``events`` by type)."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    a = e.where(F.col("event_type").isin("view", "click"))
    b = e.where(F.col("event_type") == "purchase")
    c = e.where(~F.col("event_type").isin("view", "click", "purchase"))
    return a.unionByName(b).unionByName(c)
