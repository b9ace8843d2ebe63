import json

import pytest

from daybook.functions import java_hash
from daybook.operators import applog


def rec(eid="e1", uid="u1", imei="i1", mac=None, lat=39.9, lng=116.4, ts=1704067200000, event=None,
        session="s1", drop=(), phone_extra=None):
    r = {"eventid": eid, "timestamp": ts, "event": {"k": "v"} if event is None else event,
         "user": {"uid": uid, "sessionId": session,
                  "phone": {"imei": imei, "mac": mac, **(phone_extra or {})},
                  "app": {"appid": "a"}, "loc": {"longtitude": lng, "latitude": lat}}}
    for d in drop:
        parts = d.split(".")
        o = r
        for p in parts[:-1]:
            o = o[p]
        o.pop(parts[-1])
    return json.dumps(r)


CASES = {
    "ok": rec(eid="ok"),
    "notjson": "{not json",
    "empty": "",
    "noevent": rec(eid="noevent", drop=["event"]),
    "emptyevent": rec(eid="emptyevent", event={}),
    "blankeid": rec(eid="  "),
    "blanksess": rec(eid="blanksess", session=" "),
    "noids": rec(eid="noids", uid="null", imei=""),
    "onlydevice": rec(eid="onlydevice", uid=None, imei=None, phone_extra={"deviceId": "d1"}),
    "noloc": rec(eid="noloc", drop=["user.loc"]),
    "badlat": rec(eid="badlat", lat="abc"),
    "strnum": rec(eid="strnum", lat="39.9", ts="1704067200000"),
    "unknowncell": rec(eid="unknowncell", lat=10.0, lng=10.0),
    "outofrange": rec(eid="outofrange", lat=123.0),
    "nodict": rec(eid="nodict", uid="zz", imei="zz"),
    "maconly": rec(eid="maconly", uid="q", imei=None, mac="m1"),
    "imeiwins": rec(eid="imeiwins", uid="q", imei="i2", mac="m1"),
    "badts": rec(eid="badts", ts="12.5"),
}
KEPT = {"ok", "emptyevent", "strnum", "maconly", "imeiwins"}


@pytest.mark.parametrize("hot_min", [100_000, 1])
def test_cleanse_cases(spark, hot_min):
    lines = spark.createDataFrame([(v,) for v in CASES.values()], "value string")
    geo = spark.createDataFrame([("wx4fb", "P", "C", "D"), ("wx4fb", "P", "C", "D"), ("wx4fb", "P2", "C", "D")],
                                "geo string, province string, city string, district string")
    # The cell is held three times; the most frequent area wins and rows do not multiply
    geo_dict = applog.geo_dictionary(geo.withColumnRenamed("geo", "g").selectExpr(
        "39.9 AS BD09_LAT", "116.4 AS BD09_LNG", "province", "city", "district"))
    ids = {"i1": 100, "m1": 200, "i2": 300, "u1": 100}
    idm = (spark.createDataFrame(list(ids.items()), "s string, guid long")
           .select(java_hash("s").alias("biaoshi_hashcode"), "guid"))
    rec = applog.parse_app_log(lines)
    out = applog.resolve_guid(applog.enrich_area(rec, geo_dict), idm, hot_min=hot_min)
    out = out.where("guid IS NOT NULL AND province != '未知'").collect()
    got = {r.eventid: r for r in out}
    assert set(got) == KEPT
    assert got["ok"].guid == 100 and got["ok"].province == "P" and got["ok"].event == {"k": "v"}
    assert got["emptyevent"].event == {}
    assert got["strnum"].latitude == 39.9 and got["strnum"].timestamp == 1704067200000
    assert got["maconly"].guid == 200 and got["imeiwins"].guid == 300
    full = applog.cleanse_app_log(lines, geo_dict, idm)
    assert list(full.columns) == list(applog.APP_LOG_COLUMNS) and full.count() == len(KEPT)


def test_enrich_area_without_broadcast(spark):
    df = spark.createDataFrame([(39.9, 116.4), (10.0, 10.0)], "latitude double, longtitude double")
    geo = spark.createDataFrame([("wx4fb", "P", "C", "D")], "geo string, province string, city string, district string")
    got = sorted(r.province for r in applog.enrich_area(df, geo, broadcast_bytes=0).collect())
    assert got == ["P", "未知"]


def test_dictionaries_with_repeated_keys_do_not_multiply_rows(spark):
    df = spark.createDataFrame([(39.9, 116.4, "i1")], "latitude double, longtitude double, imei string")
    geo = spark.createDataFrame([("wx4fb", "B", "C", "D"), ("wx4fb", "A", "C", "D"), ("wx4fb", "B", "C", "D")],
                                "geo string, province string, city string, district string")
    got = applog.enrich_area(df, geo).collect()
    assert len(got) == 1 and got[0].province == "B"  # most frequent area
    idm = spark.createDataFrame([(113568560, 5), (113568560, 3)], "biaoshi_hashcode long, guid long")
    df2 = spark.createDataFrame([("wx_hz",)], "imei string").selectExpr(
        "imei", *[f"CAST(NULL AS STRING) AS {c}" for c in ("imsi", "mac", "uid", "androidId", "uuid")])
    got = applog.resolve_guid(df2, idm).collect()
    assert len(got) == 1 and got[0].guid == 3


def test_identity_rule_and_id_fields(spark):
    from daybook.functions import has_identity, not_blank
    from daybook.operators import idmap
    df = spark.createDataFrame([("null", None, " ", "nu", "ll", None), (None, None, None, None, None, "x"),
                                ("", "", "", "", "", "")], "a string, b string, c string, d string, e string, f string")
    got = [r[0] for r in df.select(has_identity("a", "b", "c", "d", "e", "f")).collect()]
    # the text "null", blanks and a "null" spelled across two fields all count as no identity
    assert got == [False, True, False]
    assert [r[0] for r in df.select(not_blank("f")).collect()] == [False, True, False]
    line = json.dumps({"user": {"uid": "u", "imei": "top", "phone": {"imei": "phone"}}})
    lines = spark.createDataFrame([(line,)], "value string")
    assert idmap.extract_ids(lines).first().ids == ["u", "phone"]            # D2: user.phone first
    assert idmap.extract_ids(lines, phone_first=False).first().ids == ["u", "top"]


def test_app_log_is_written_once_and_the_area_dictionary_read_once(spark, sf_dir):
    from daybook.plans.applog import q_applog
    # before, each pass rendered the lines again from the events
    assert any("/daybook-applog-" in f for f in q_applog(spark, sf_dir).inputFiles())
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    geo = spark.createDataFrame([("wx4fb", "P", "C", "D")], "geo string, province string, city string, district string")
    df = spark.createDataFrame([(39.9, 116.4)], "latitude double, longtitude double")
    got = applog.enrich_area(df, geo.mapInArrow(counted, geo.schema)).collect()
    assert [r.province for r in got] == ["P"] and read.value == 1


def test_geohash_of_every_length(spark):
    from daybook.functions import geohash
    from tests.test_sources import _bisect_geohash
    points = [(39.9, 116.4), (-90.0, -180.0), (90.0, 180.0), (0.0, 0.0), (-33.9, 18.4), (89.999, -0.001), (-0.001, 179.999)]
    odd = [(90.1, 0.0), (0.0, -180.5), (None, 1.0), (float("nan"), 1.0), (1.0, float("inf"))]
    df = spark.createDataFrame(points + odd, "lat double, lng double").select("lat", "lng", *[geohash("lat", "lng", n).alias(f"g{n}") for n in range(1, 13)])
    for r in df.collect():
        for n in range(1, 13):
            assert r[f"g{n}"] == (_bisect_geohash(r.lat, r.lng, n) if (r.lat, r.lng) in points else None)
    # each axis stands once in the expression: before, once for each of its bits
    assert str(geohash("lat", "lng")).upper().count("FLOOR") == 2
