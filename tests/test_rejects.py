import json

from pyspark.sql import functions as F

from daybook import sources
from daybook.operators import applog


def test_csv_rejects_and_their_places(spark, tmp_path):
    schema = "id long, name string, price double, day date"
    (tmp_path / "a.csv").write_text("id,name,price,day\n1,x,2.5,2020-01-01\n2,y\n\n3,\"q,z\",abc,2020-01-02\n4,,,2020-01-03\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("id,name,price,day\nid,name,price,day\n5,é,1,2020-02-30\n6,a,1,2020-01-01,more\n7,\"\",,\n8,\"open,1,2020-01-01\n", encoding="utf-8")
    got = {(r.file.rsplit("/", 1)[1], r.block, r.line): (r.value, r.reason) for r in sources.csv_rejects(spark, str(tmp_path), schema).collect()}
    assert got == {("a.csv", 0, 3): ("2,y", "short row"), ("a.csv", 0, 5): ('3,"q,z",abc,2020-01-02', "cell price"),
                   ("b.csv", 0, 2): ("id,name,price,day", "cell id"), ("b.csv", 0, 3): ("5,é,1,2020-02-30", "cell day"),
                   ("b.csv", 0, 4): ("6,a,1,2020-01-01,more", "long row"), ("b.csv", 0, 6): ('8,"open,1,2020-01-01', got["b.csv", 0, 6][1])}
    assert got["b.csv", 0, 6][1] in ("short row", "open quote")
    rows = {r.id: tuple(r) for r in sources.read_csv(spark, str(tmp_path), schema).collect()}
    assert rows[2] == (2, "y", None, None) and rows[3][1:3] == ("q,z", None) and rows[6][1] == "a" and len(rows) == 9
    none = sources.csv_rejects(spark, str(tmp_path / "a.csv"), "id string", header=False, sep="|")
    assert none.count() == 0


def test_places_in_a_file_of_several_splits(spark, tmp_path):
    (tmp_path / "l.txt").write_text("".join(f"line {i}\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = sources.placed_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len({r.block for r in rows}) > 3 and len(rows) == 3000
    ordered = sorted(rows, key=lambda r: (r.block, r.line))
    assert [r.value for r in ordered] == [f"line {i}" for i in range(3000)]
    assert all(min(r.line for r in rows if r.block == b) == 1 for b in {r.block for r in rows})


def test_log_rejects_account_for_every_line(spark):
    def line(**change):
        rec = {"eventid": "e", "timestamp": 1, "event": {}, "user": {"uid": "u", "sessionId": "s", "phone": {"imei": "i"}, "app": {},
                                                                  "loc": {"longtitude": 1, "latitude": 2}}}
        for k, v in change.items():
            at = rec if k in rec else rec["user"]
            if v is None:
                del at[k]
            else:
                at[k] = v
        return json.dumps(rec)

    want = {"not json": "malformed", "[1]": "malformed", "": "malformed", line(event=None): "missing object", line(loc=None): "missing object",
            line(app=None): "missing object", line(timestamp="x"): "timestamp", line(timestamp=None): "timestamp",
            line(loc={"longtitude": "a", "latitude": 1}): "coordinates", line(loc={"latitude": 1}): "coordinates",
            line(uid=" ", phone={}): "identity", line(eventid=" "): "eventid", line(sessionId="　"): "sessionId", line(): None,
            line(timestamp="12"): None}
    df = spark.createDataFrame([(v, i) for i, v in enumerate(want)], "value string, n int")
    got = {r.value: r.reason for r in applog.app_log_rejects(df).collect()}
    assert got == {k: v for k, v in want.items() if v}
    assert applog.parse_app_log(df).count() == sum(v is None for v in want.values())
    null = spark.createDataFrame([(None,)], "value string")
    assert applog.app_log_rejects(null).first().reason == "malformed" and applog.parse_app_log(null).count() == 0


def test_sized_files(spark, tmp_path):
    # one day with most of the rows, small days, one without a name
    df = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x"),
                                    F.when(F.col("id") < 50_000, "big").when(F.col("id") < 59_990, F.concat(F.lit("d"), F.col("id") % 9)).alias("dt"))
    path = str(tmp_path / "sized")
    n = sources.write_sized(df.repartition(7), path, 400_000, ["dt"])
    sizes = sources.file_sizes(spark, path).collect()
    assert n == len(sizes) and sum(r["rows"] for r in sizes) == 60_000
    big = [r.bytes for r in sizes if "/dt=big/" in r.file]
    assert len(big) > 5 and all(200_000 < b < 800_000 for b in big)
    assert sorted(r.file.split("/dt=")[1].split("/")[0] for r in sizes if "/dt=big/" not in r.file) == sorted([f"d{i}" for i in range(9)] + ["__HIVE_DEFAULT_PARTITION__"])
    back = spark.read.parquet(path)
    assert back.select("id", "x", "dt").exceptAll(df).count() == 0 and back.count() == 60_000
    assert sources.write_sized(df, str(tmp_path / "whole"), 1 << 30) == 1
    assert sources.write_sized(df.where("false"), str(tmp_path / "none"), 1 << 20, ["dt"]) == 0


def test_the_sample_of_sized_files_is_read_by_all_tasks(spark, tmp_path):
    import glob

    from daybook.sources.session import checkpoint_dir
    probes = lambda: set(glob.glob(checkpoint_dir(spark).replace("file:", "") + "/daybook-probe-*"))
    before = probes()
    df = spark.range(4000, numPartitions=4).withColumn("task", F.spark_partition_id())
    sources.write_sized(df, str(tmp_path / "sized"), 1 << 20)
    probe, = probes() - before
    # before, one task read the whole table for its sample
    assert {r.task for r in spark.read.parquet(probe).select("task").distinct().collect()} == {0, 1, 2, 3}
    assert len(glob.glob(probe + "/*.parquet")) == 1
