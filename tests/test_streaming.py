import json
import os

from daybook.streaming.applog_stream import start_applog_cleanse


def _line(uid, lat=39.9, lng=116.4, **extra):
    rec = {"eventid": "view", "timestamp": 1704067200000, "event": {"k": "1"},
           "user": {"uid": uid, "sessionId": "s1",
                    "phone": {"imei": "imei-" + uid, "mac": None},
                    "app": {"appid": "a"},
                    "loc": {"longtitude": lng, "latitude": lat}}}
    rec.update(extra)
    return json.dumps(rec)


def test_streaming_cleanse(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "part-0.txt").write_text("\n".join([_line("u1"), _line("u2", lat=91.0), "garbage",
                                               _line("u3", event=None)]) + "\n")
    geo = spark.createDataFrame([("wx4fb", "P", "C", "D")], "geo string, province string, city string, district string")
    from daybook.functions import java_hash
    idm = (spark.createDataFrame([("imei-u1",), ("imei-u2",), ("imei-u3",)], "s string")
           .select(java_hash("s").alias("biaoshi_hashcode"), java_hash("s").alias("guid")))
    q = start_applog_cleanse(spark, str(src), geo, idm, str(tmp_path / "out"), str(tmp_path / "ckpt"),
                             available_now=True)
    q.awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out"))
    rows = out.collect()
    assert [r.uid for r in rows] == ["u1"]
    assert rows[0].province == "P" and rows[0].timestamp == 1704067200000
    assert os.path.isdir(tmp_path / "out" / "batch_id=0")
