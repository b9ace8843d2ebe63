"""The path/table-driven jobs on the reference's sample shapes (values from FIXTURES.md)."""

import json

import pytest

from daybook.plans import jobs
from tests.test_activity import DEMO, RNG
from tests.test_ml import SAMPLE, TEST


def _write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_report_jobs(spark, tmp_path):
    rng_csv = _write(tmp_path / "rng.csv", "guid,first_dt,rng_start,rng_end\n" + "\n".join(
        ",".join(r) for r in RNG[:-1]) + "\n\nstray sentence without commas\n")
    got = [(r.act_days, r.users) for r in jobs.uca_report(spark, rng_csv, "2020-06-08").collect()]
    assert got == [(1, 3), (2, 3), (3, 2), (4, 2), (5, 2), (6, 2)]
    demo = _write(tmp_path / "demo.dat", "\n".join(",".join(map(str, r)) for r in DEMO) + "\n")
    itv = sorted(tuple(r) for r in jobs.interval_report(spark, demo, "2020-03-14").collect())
    assert itv == [(1, 0, 28), (1, 2, 1), (2, 0, 1), (2, 2, 1), (3, 0, 9), (3, 3, 1), (4, 0, 10), (5, 0, 1)]


def test_catalog_report_jobs(spark):
    for t in ("daybook_rng", "daybook_uch", "daybook_art"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    rows = [(str(g), f, s, e, "2020-03-14") for g, f, s, e in DEMO]
    spark.createDataFrame(rows, "guid string, first_dt string, rng_start string, rng_end string, dt string") \
        .write.partitionBy("dt").saveAsTable("daybook_rng")
    jobs.uca_report_table(spark, "daybook_rng", "daybook_uch", "2020-03-14", source_dt="2020-03-14")
    jobs.uca_report_table(spark, "daybook_rng", "daybook_uch", "2020-03-14", source_dt="2020-03-14")  # rerun
    uch = spark.table("daybook_uch")
    assert uch.where("dt = '2020-03-14'").count() == 11
    assert uch.where("act_days = 1").first().users == 3
    jobs.retention_table(spark, "daybook_rng", "daybook_art", "2020-03-14")
    art = {r.act_dt: r.rt_users for r in spark.table("daybook_art").collect()}
    assert art["2020-03-14"] == 3 and art["2020-03-04"] == 1 and len(art) == 11


def test_bayes_jobs(spark, tmp_path):
    sample = _write(tmp_path / "sample.csv", "name,job,income,age,sex,label\n" + SAMPLE + "\n")
    test = _write(tmp_path / "test.csv", "name,job,income,age,sex\n" + "\n".join(",".join(r) for r in TEST) + "\n")
    feats = ["job", "income", "age", "sex"]
    got = {r.name: r.probability for r in jobs.bayes_job(spark, sample, test, feats).collect()}
    assert got["t1"] == pytest.approx(0.6325489379425236, abs=1e-9)
    nb = {r.name: r.prediction for r in
          jobs.naive_bayes_job(spark, sample, test, feats, model_path=str(tmp_path / "m")).collect()}
    assert nb == {"t1": 0.0, "t2": 0.0, "t3": 1.0}
    vec = {r.name: list(r.vec) for r in jobs.vector_job(spark, sample, {
        "job": ({"老师": 0, "程序员": 1}, 2.0), "income": ({"低": 0, "中": 1}, 2.0),
        "age": ({"青年": 0, "中年": 1}, 2.0), "sex": ({"男": 0, "女": 1}, None)}).collect()}
    assert vec["r4"] == [0.0, 2.0, 2.0, 1.0]


def test_knn_and_similarity_jobs(spark, tmp_path):
    sample = _write(tmp_path / "s.csv", "label,f1,f2,f3,f4,f5\n" + "\n".join([
        "0,10.20,30,40,30", "0,12.22,29,42,35", "0,11.21,31，40，34", "0,13,22,30,42,32", "0,12,22,32,41,33",
        "0,10,21,33,45,35", "1,30,11,21,40,34", "1,33,16,20,43,30", "1,30,12,23,40,33", "1,32,10,20,42,33",
        "1,30,13,20,42,30", "1,30,09,22,41,32"]) + "\n")
    test = _write(tmp_path / "t.csv", "id,f1,f2,f3,f4,f5\n" + "\n".join([
        "1,11,21.31,44,32", "2,14,26,32,39,30", "3,32,14,21,42,32", "4,34,12,22,42,34", "5,34,12,22,42,34"]) + "\n")
    got = {int(r.id): r.predict for r in jobs.knn_job(spark, sample, test).collect()}
    assert got == {1: 0, 2: 0, 3: 1, 4: 1, 5: 1}
    demo = _write(tmp_path / "d.csv", "id,f1,f2,f3,f4,f5\n1,40,50,10,2,5\n2,80,100,20,4,10\n3,121,148,28,6,15\n"
                  "4,35,45,8,2,4\n5,70,92,16,4,7.9\n6,103,136,23,6.6,12.5\n")
    sim = {(r.id, r.other_id): r.eud for r in jobs.similarity_job(spark, demo, k=5).collect()}
    assert len(sim) == 30 and sim[(1, 2)] == pytest.approx(0.015144456469147692, abs=1e-9)


def test_text_jobs(spark, tmp_path):
    good = _write(tmp_path / "g.txt", "\n".join(["great fast delivery", "great quality, love it"] * 10))
    neutral = _write(tmp_path / "n.txt", "\n".join(["okay product average", "average delivery okay"] * 10))
    poor = _write(tmp_path / "p.txt", "\n".join(["terrible broken item", "broken and slow terrible"] * 10))
    stop = _write(tmp_path / "stop.txt", "，\n。\n!\n:\n,\n.\nand\n")
    _, pred, acc = jobs.comment_classify_job(spark, good, neutral, poor, stop, str(tmp_path / "model"))
    row = acc.first()
    assert row.total == pred.count() and row.accuracy > 0.9
    lines = _write(tmp_path / "lines.txt", "13866778899,n1,wx_hz,2000\n13877669988,n2,wx_hz,3000\n,n1,wx_ldh,5000\n")
    tagged = sorted(r.value for r in jobs.link_lines_job(spark, lines).collect())
    assert all(v.startswith("-1485777898,") for v in tagged)


def test_log_jobs(spark, tmp_path):
    def line(uid, imei):
        return json.dumps({"eventid": "e", "timestamp": 1, "event": {},
                           "user": {"uid": uid, "sessionId": "s", "phone": {"imei": imei}, "app": {},
                                    "loc": {"longtitude": 116.4, "latitude": 39.9}}})
    app = _write(tmp_path / "app.txt", "\n".join([line("u1", "i1")] * 3 + [line("u2", "i2")]))
    web = _write(tmp_path / "web.txt", line("u1", "i1"))
    jobs.identity_map_job(spark, [app, web], str(tmp_path / "ids"), files=1)
    ids = spark.read.parquet(str(tmp_path / "ids"))
    assert ids.count() == 4 and ids.select("guid").distinct().count() == 3
    jobs.identity_map_job(spark, [app], str(tmp_path / "ids2"), prev_path=str(tmp_path / "ids"))
    assert spark.read.parquet(str(tmp_path / "ids2")).count() == 4
    # geo dictionary from an in-process Derby database, then the cleanse
    url = "jdbc:derby:memory:daybook_jobs;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    spark.createDataFrame([(116.4, 39.9, "P", "C", "D")], "BD09_LNG double, BD09_LAT double, province string, "
                          "city string, district string").write.jdbc(url, "GEO", mode="overwrite", properties=props)
    jobs.geo_dictionary_from_jdbc(spark, url, "GEO", props, str(tmp_path / "geo"))
    jobs.app_log_job(spark, app, str(tmp_path / "geo"), str(tmp_path / "ids"), str(tmp_path / "out"))
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 4 and set(r.province for r in out.collect()) == {"P"}
