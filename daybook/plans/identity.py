"""Driver queries for identity mapping and linking (Q-IDM, Q-IDR, Q-LINK, A7).

Identifiers come from the driver tables: a ``lineitem`` row carries a part id, a
supplier id and a ship-month id; an ``orders`` row becomes a delimited text line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators import idmap
from daybook.plans.registry import register
from daybook.plans.sqlutil import NOT_BLANK, cc_sql, jh
from daybook.plans.tables import table

ROLL_CUT = "1998-01-01"


def lineitem_ids(spark: SparkSession, sf_dir: str, with_month: bool = False) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    cols = [F.concat(F.lit("P"), F.col("l_partkey").cast("string")),
            F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))]
    if with_month:
        cols.append(F.concat(F.lit("M"), F.date_format("l_shipdate", "yyyy-MM")))
    return li.select(F.filter(F.array(*cols), lambda x: x.isNotNull()).alias("ids"), "l_shipdate")


_EDGES_SQL = f"""
WITH ids AS (SELECT 'P' || l_partkey AS a, 'S' || l_suppkey AS b, 'M' || strftime(l_shipdate, '%Y-%m') AS c FROM lineitem),
p AS (SELECT {jh('a')} AS src, {jh('b')} AS dst FROM ids
      UNION ALL SELECT {jh('a')}, {jh('c')} FROM ids WHERE c IS NOT NULL
      UNION ALL SELECT {jh('b')}, {jh('c')} FROM ids WHERE c IS NOT NULL)
SELECT src, dst, count(*) AS n FROM p GROUP BY src, dst HAVING count(*) >= 3"""


@register("q_edges", _EDGES_SQL)
def q_edges(spark, sf_dir):
    """X3 + A7: hashed id pairs of each row counted, kept when seen 3+ times."""
    return idmap.id_edges(lineitem_ids(spark, sf_dir, with_month=True))


def _idm_sql_parts(pred: str, tag: str) -> tuple[str, str]:
    v = (f"SELECT {jh('a')} AS id FROM ids WHERE {pred} UNION SELECT {jh('b')} FROM ids WHERE {pred}")
    e = (f"SELECT {jh('a')} AS src, {jh('b')} AS dst FROM ids WHERE {pred} GROUP BY 1, 2 HAVING count(*) >= 3")
    return v, e


_IDS_CTE = ("ids AS (SELECT 'P' || l_partkey AS a, 'S' || l_suppkey AS b, "
            f"l_shipdate < TIMESTAMP '{ROLL_CUT} 00:00:00' AS y FROM lineitem)")
_V_ALL, _E_ALL = _idm_sql_parts("TRUE", "all")
_IDMAP_SQL = f"""WITH RECURSIVE {_IDS_CTE}, {cc_sql('cc', _V_ALL, _E_ALL)}
SELECT id AS biaoshi_hashcode, comp AS guid FROM cc"""

_V_Y, _E_Y = _idm_sql_parts("y", "y")
_V_T, _E_T = _idm_sql_parts("NOT y", "t")
_ROLL_SQL = f"""WITH RECURSIVE {_IDS_CTE}, {cc_sql('c1', _V_Y, _E_Y)},
prev AS (SELECT id AS bh, comp AS guid FROM c1),
{cc_sql('c2', _V_T + ' UNION SELECT bh FROM prev', _E_T + ' UNION ALL SELECT bh, guid FROM prev')},
t AS (SELECT c2.id, c2.comp, prev.guid AS pg FROM c2 LEFT JOIN prev ON c2.id = prev.bh),
pc AS (SELECT comp, min(pg) AS old FROM t GROUP BY comp)
SELECT t.id AS biaoshi_hashcode, coalesce(pc.old, t.comp) AS guid FROM t JOIN pc ON t.comp = pc.comp"""


@register("q_idmap", _IDMAP_SQL)
def q_idmap(spark, sf_dir):
    """Q-IDM: one day's identity dictionary over part and supplier ids."""
    return idmap.identity_map(lineitem_ids(spark, sf_dir).select("ids"))


@register("q_idmap_roll", _ROLL_SQL)
def q_idmap_roll(spark, sf_dir):
    """Q-IDR: rows shipped before the cut build yesterday's dictionary; the rest are
    today's logs, rolled onto it."""
    ids = lineitem_ids(spark, sf_dir)
    # a string parsed as a zone-less timestamp: independent of any session or OS time zone
    cut = F.lit(f"{ROLL_CUT} 00:00:00").cast("timestamp_ntz")
    yesterday = idmap.identity_dictionary(ids.where(F.col("l_shipdate") < cut).select("ids")).checkpoint()
    return idmap.identity_map(ids.where(F.col("l_shipdate") >= cut).select("ids"), prev=yesterday)


def colliding_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two identifiers of each line item, whose rows by turns carry the prefix ``Aa`` or
    ``BB``: the two have the same Java hash, so every id has a stranger with its hash."""
    li = table(spark, sf_dir, "lineitem")
    side = F.when(F.col("l_linenumber") % 2 == 0, F.lit("Aa")).otherwise(F.lit("BB"))
    return li.select(F.filter(F.array(F.concat(side, F.lit("P"), F.col("l_partkey").cast("string")),
                                      F.concat(side, F.lit("S"), F.col("l_suppkey").cast("string"))), lambda x: x.isNotNull()).alias("ids"), "l_shipdate")


_COLLIDE_IDS = """ids AS (SELECT (CASE WHEN l_linenumber % 2 = 0 THEN 'Aa' ELSE 'BB' END) || 'P' || l_partkey AS a,
  (CASE WHEN l_linenumber % 2 = 0 THEN 'Aa' ELSE 'BB' END) || 'S' || l_suppkey AS b FROM lineitem)"""
_COLLIDE_SQL = f"""WITH RECURSIVE {_COLLIDE_IDS},
nm AS (SELECT a AS name FROM ids UNION SELECT b FROM ids),
d AS (SELECT name, row_number() OVER (ORDER BY name) AS id FROM nm),
e AS (SELECT da.id AS src, db.id AS dst FROM (SELECT a, b FROM ids GROUP BY a, b HAVING count(*) >= 2) x JOIN d da ON da.name = x.a JOIN d db ON db.name = x.b),
{cc_sql('cc', 'SELECT id FROM d', 'SELECT src, dst FROM e')},
h AS (SELECT d.name, {jh('d.name')} AS h, cc.comp FROM d JOIN cc ON cc.id = d.id),
g AS (SELECT comp, min(h) AS h FROM h GROUP BY comp),
k AS (SELECT comp, h + 4294967296 * (row_number() OVER (PARTITION BY h ORDER BY comp) - 1) AS guid FROM g)
SELECT h.name, h.h AS biaoshi_hashcode, CAST(k.guid AS BIGINT) AS guid FROM h JOIN k ON k.comp = h.comp"""


@register("q_idmap_collide", _COLLIDE_SQL)
def q_idmap_collide(spark, sf_dir):
    """Q-IDM where every identifier shares its hash with a stranger (G1, G3, F7): the
    strangers stay apart, in guids too."""
    return idmap.identity_dictionary(colliding_ids(spark, sf_dir).select("ids"), min_count=2)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer,order,date`` text lines; a partially filled order has a blank order
    field, empty or one full-width space by turns, which links its customer to that blank's
    vertex as in the reference, but is no vertex of its own and no start of a link."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.concat_ws(
        ",",
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")),
        F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 2 == 1), F.lit("\u3000"))
        .when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(
            F.concat(F.lit("O"), F.col("o_orderkey").cast("string"))),
        F.date_format("o_orderdate", "yyyy-MM-dd")).alias("value"))


_LINK_SQL = f"""WITH RECURSIVE
lines AS (SELECT 'C' || o_custkey || ',' || (CASE WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 1 THEN chr(12288) WHEN o_orderstatus = 'P' THEN '' ELSE 'O' || o_orderkey END)
                 || ',' || coalesce(strftime(o_orderdate, '%Y-%m-%d'), '') AS line FROM orders),
f AS (SELECT line, string_split(regexp_replace(line, ',+$', ''), ',') AS fs FROM lines),
nb AS (SELECT line, list_filter(fs, lambda x: regexp_matches(x, '{NOT_BLANK}')) AS names, fs FROM f),
pr AS (SELECT fs[i] AS a, fs[i + 1] AS b FROM (SELECT fs, unnest(generate_series(1, len(fs) - 1)) AS i FROM f)
       WHERE regexp_matches(a, '{NOT_BLANK}')),
{cc_sql('cc', f"SELECT {jh('n')} AS id FROM (SELECT unnest(names) AS n FROM nb)", f"SELECT {jh('a')} AS src, {jh('b')} AS dst FROM pr")}
SELECT cc.comp AS gid, nb.line FROM nb LEFT JOIN cc ON cc.id = {jh('nb.names[1]')}"""


@register("q_link", _LINK_SQL)
def q_link(spark, sf_dir):
    """Q-LINK over all orders rendered as lines."""
    return idmap.link_lines(order_lines(spark, sf_dir))
