import os

from pyspark.sql import functions as F

from daybook import sources
from daybook.functions import register_functions


def test_text_csv_parquet_round_trip(spark, tmp_path):
    p = str(tmp_path)
    lines = spark.createDataFrame([("a,1",), ("b,2",), ("",)], "value string")
    lines.write.text(os.path.join(p, "t"))
    assert sorted(r.value for r in sources.read_lines(spark, os.path.join(p, "t")).collect()) == ["", "a,1", "b,2"]
    with open(os.path.join(p, "c.csv"), "w") as f:
        f.write("guid,rng_end\nx,2020-01-01\ny\n")
    df = sources.read_csv(spark, os.path.join(p, "c.csv"))
    assert df.schema.simpleString() == "struct<guid:string,rng_end:string>"
    assert sorted((r.guid, r.rng_end) for r in df.collect()) == [("x", "2020-01-01"), ("y", None)]
    typed = sources.read_csv(spark, os.path.join(p, "c.csv"), "guid string, rng_end date", header=True)
    assert typed.where("guid = 'y'").first().rng_end is None
    sources.write_parquet(df, os.path.join(p, "pq"), files=1)
    assert sources.read_parquet(spark, os.path.join(p, "pq")).count() == 2
    # default mode refuses to overwrite
    try:
        sources.write_parquet(df, os.path.join(p, "pq"))
        raise AssertionError("expected failure")
    except Exception as e:  # noqa: BLE001
        assert "already exists" in str(e).lower() or "PATH_ALREADY_EXISTS" in str(e)


def test_jdbc_round_trip(spark):
    url = "jdbc:derby:memory:daybook_test;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    src = spark.createDataFrame([(1, 116.4, 39.9, "p", "c", "d"), (2, 0.0, 0.0, "p2", "c2", "d2")],
                                "id int, BD09_LNG double, BD09_LAT double, province string, city string, district string")
    src.write.jdbc(url, "GEO_POINTS", mode="overwrite", properties=props)
    back = sources.read_jdbc(spark, url, "GEO_POINTS", props, "ID", 0, 3, 2)
    assert back.count() == 2 and back.rdd.getNumPartitions() == 2
    from daybook.operators.applog import geo_dictionary
    got = {r.GEO if hasattr(r, "GEO") else r.geo for r in geo_dictionary(
        back.toDF(*[c.upper() if c.upper().startswith("BD09") else c.lower() for c in back.columns])).collect()}
    assert "wx4fb" in got


def test_append_table_and_partition_overwrite(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS daybook_uca")
    df = spark.createDataFrame([("2020-06-08", 1, 3)], "dt string, act_days int, users long")
    sources.append_table(df.select("act_days", "users", "dt"), "daybook_uca", partition_by=["dt"])
    sources.append_table(df.select("act_days", "users", "dt"), "daybook_uca", partition_by=["dt"])
    assert sources.read_table(spark, "daybook_uca", "dt = '2020-06-08'").count() == 2
    other = spark.createDataFrame([(1, 5, "2020-06-07")], "act_days int, users long, dt string")
    sources.append_table(other, "daybook_uca")
    sources.append_table(df.select("act_days", "users", "dt"), "daybook_uca", overwrite_partitions=True)
    assert sources.read_table(spark, "daybook_uca", "dt = '2020-06-08'").count() == 1
    assert sources.read_table(spark, "daybook_uca", "dt = '2020-06-07'").count() == 1  # untouched
    spark.sql("DROP TABLE IF EXISTS daybook_uca")


def test_sql_functions(spark):
    register_functions(spark)
    r = spark.sql("""SELECT java_hash('wx_hz') AS h, hash_bucket('老师', 20) AS b,
        euclidean_similarity(array(1D, 2D), array(1D, 2D)) AS e,
        cosine_similarity(array(1D, 0D), array(0D, 1D)) AS c,
        squared_distance(array(1D, NULL), array(0D, 2D)) AS s""").first()
    assert (r.h, r.e, r.c, r.s) == (113568560, 1.0, 0.0, 5.0)
    assert r.b == (1039911 & 0x7FFFFFFF) % 20


def test_geohash_values(spark):
    from daybook.functions import geohash
    df = spark.createDataFrame([(39.9, 116.4), (90.0, 180.0), (-90.0, -180.0), (0.0, 0.0), (91.0, 0.0), (None, 1.0)],
                               "lat double, lng double")
    got = [r.g for r in df.select(geohash("lat", "lng").alias("g")).collect()]
    assert got == ["wx4fb", "zzzzz", "00000", "s0000", None, None]


def test_spread_is_noop_for_split_inputs(spark):
    df = spark.range(0, 100, numPartitions=spark.sparkContext.defaultParallelism)
    assert sources.spread(df) is df
    one = spark.range(0, 10, numPartitions=1)
    assert sources.spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert F is not None


def _bisect_geohash(lat, lng, precision):
    alphabet = "0123456789bcdefghjkmnpqrstuvwxyz"
    lat_r, lng_r = [-90.0, 90.0], [-180.0, 180.0]
    bits, even, out, ch = 0, True, [], 0
    while len(out) < precision:
        rng, v = (lng_r, lng) if even else (lat_r, lat)
        mid = (rng[0] + rng[1]) / 2
        if v >= mid:
            ch = ch * 2 + 1
            rng[0] = mid
        else:
            ch = ch * 2
            rng[1] = mid
        even = not even
        bits += 1
        if bits == 5:
            out.append(alphabet[ch])
            bits, ch = 0, 0
    return "".join(out)


def test_geohash_matches_bisection(spark):
    import random
    from daybook.functions import geohash
    rnd = random.Random(3)
    pts = [(rnd.uniform(-89.999, 89.999), rnd.uniform(-179.999, 179.999)) for _ in range(2000)]
    df = spark.createDataFrame(pts, "lat double, lng double")
    got = df.select("lat", "lng", geohash("lat", "lng", 5).alias("g5"), geohash("lat", "lng", 9).alias("g9")).collect()
    for r in got:
        assert r.g5 == _bisect_geohash(r.lat, r.lng, 5)
        assert r.g9 == _bisect_geohash(r.lat, r.lng, 9)


def _java_string_hash(s):
    h = 0
    data = s.encode("utf-16-be")
    for i in range(0, len(data), 2):
        h = (31 * h + int.from_bytes(data[i:i + 2], "big")) & 0xFFFFFFFF
    return h - (1 << 32) if h >= (1 << 31) else h


def test_java_hash_matches_utf16_definition(spark):
    import random
    from daybook.functions import hash_bucket, java_hash
    rnd = random.Random(11)
    alphabet = "abcXYZ019 _-,老师程序员公务员中华é€😀\U0001F680"
    words = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30))) for _ in range(300)]
    df = spark.createDataFrame([(w,) for w in words], "s string")
    got = df.select("s", java_hash("s").alias("h"), hash_bucket("s", 20).alias("b")).collect()
    for r in got:
        assert r.h == _java_string_hash(r.s)
        assert r.b == (r.h & 0x7FFFFFFF) % 20


def test_sql_geohash_cell(spark):
    import random
    register_functions(spark)
    rnd = random.Random(9)
    pts = [(rnd.uniform(-89.99, 89.99), rnd.uniform(-179.99, 179.99)) for _ in range(300)] + [(90.0, 180.0), (91.0, 0.0)]
    spark.createDataFrame(pts, "lat double, lng double").createOrReplaceTempView("pts")
    rows = spark.sql("SELECT lat, lng, geohash_cell(lat, lng, 5) AS g5, geohash_cell(lat, lng, 12) AS g12 FROM pts").collect()
    for r in rows:
        if r.lat > 90:
            assert r.g5 is None
            continue
        assert r.g5 == _bisect_geohash(r.lat, r.lng, 5) and r.g12 == _bisect_geohash(r.lat, r.lng, 12)


def test_partitioned_parquet_and_pruning(spark, tmp_path):
    df = spark.createDataFrame([("2020-06-07", 1), ("2020-06-08", 2)], "dt string, v int")
    sources.write_parquet(df, str(tmp_path / "p"), partition_by=["dt"])
    back = sources.read_parquet(spark, str(tmp_path / "p")).where("dt = '2020-06-08'")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and [r.v for r in back.collect()] == [2]
