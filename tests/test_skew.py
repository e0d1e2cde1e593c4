"""The operators for hot keys give what the plain ones give."""

from pyspark.sql import functions as F

from ratebook.operators.ranking import row_numbers
from ratebook.operators.skew import hot_keys, hot_table, lookup_join, repeat_rows, salted_join
from ratebook.operators.storage import stored


def _lines(spark, rows=6000):
    """Key 'a' holds most rows, a third of them exact copies; NULLs in the order columns."""
    return spark.range(rows).selectExpr(
        "CASE WHEN id % 3 < 2 THEN 'a' ELSE concat('k', id % 50) END AS k",
        "CASE WHEN id % 3 = 0 THEN 'same' WHEN id % 11 = 0 THEN NULL ELSE string(id % 97) END AS c",
        "CASE WHEN id % 3 = 0 THEN 1 WHEN id % 13 = 0 THEN NULL ELSE id % 701 END AS d",
    )


def _counted(df):
    return {tuple(r): n for *r, n in df.groupBy(*df.columns).count().collect()}


def test_hot_keys_finds_the_heavy_key_only(spark):
    df = _lines(spark)
    found = hot_keys(df, "k", min_rows=500)
    assert found and (found.keys, found.rows) == (1, 4000)
    assert found.table.collect() == [("a", 4000)]
    assert not hot_keys(df, "k", min_rows=10_000)
    weighted = hot_keys(df, "k", weight=F.lit(10), min_rows=10_000)
    assert weighted.table.collect() == [("a", 40_000)]


def test_any_number_of_hot_keys_is_split(spark):
    """There is no list to be too short: 200,000 keys are hot, and all rows of each are salted."""
    df = spark.range(600_000).selectExpr("id % 200000 AS k", "id AS v")
    hot = hot_keys(df, "k", min_rows=2)
    assert (hot.keys, hot.rows) == (200_000, 600_000)
    marks = hot_table(df, "k", hot, per_slice=1)
    assert marks.where("_salts = 3").count() == 200_000
    right = spark.range(0, 200_000, 2).selectExpr("id AS k", "id + 1 AS w")
    joined = salted_join(df, right, "k", "left", hot, per_slice=1)
    assert joined.selectExpr("count(*)", "count(w)", "sum(w - k)").first() == (600_000, 300_000, 300_000)


def test_sliced_row_numbers_equal_the_window(spark):
    df = _lines(spark)
    plain = row_numbers(df, "k", ["c", "d"], "n")
    sliced = row_numbers(df, "k", ["c", "d"], "n", hot={"a": 4000, "k1": 50, "absent": 1}, slices=7)
    assert _counted(plain) == _counted(sliced)


def test_sliced_row_numbers_are_spread(spark):
    """No slice holds all rows of the hot key."""
    df = _lines(spark).where("k = 'a' AND c <> 'same'")
    ranged = df.distinct().repartitionByRange(7, "k", "c", "d")
    sizes = ranged.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 3


def test_salts_hold_after_a_shuffle_on_the_key(spark):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(8000).select(F.lit("a").alias("k"), "id").repartition(16, "k")
        right = spark.createDataFrame([("a", 1)], "k string, x int")
        once = salted_join(left, right, "k", "left", hot={"a": 8000}, per_slice=500)
        more = spark.createDataFrame([("a", 2)], "k string, y int")
        twice = salted_join(once, more, "k", "left", hot={"a": 8000}, per_slice=500)
        for joined in (once, twice):
            tasks = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
            assert sum(t["count"] for t in tasks) == 8000
            assert max(t["count"] for t in tasks) <= 4000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_salted_join_equals_the_join(spark):
    left = _lines(spark)
    right = spark.createDataFrame(
        [("a", 1), ("a", 2), ("k1", 3), ("zz", 4)], "k string, v int"
    )
    for how in ("inner", "left"):
        plain = left.join(right, "k", how).select("k", "c", "d", "v")
        salted = salted_join(left, right, "k", how, hot={"a": 4000, "k2": 40}, per_slice=500)
        assert salted.columns == ["k", "c", "d", "v"]
        assert _counted(plain) == _counted(salted)


def test_lookup_join_without_broadcast_equals_the_join(spark):
    left = _lines(spark).withColumn("k", F.when(F.col("c") != "5", F.col("k")))
    right = spark.createDataFrame([("a", 1), ("a", 2), ("k1", 3)], "k string, v int")
    right = stored(right, "right")
    for how in ("inner", "left"):
        plain = left.join(right, "k", how).select("k", "c", "d", "v")
        small = lookup_join(left, right, "k", how)
        large = lookup_join(left, right, "k", how, max_bytes=1, min_hot_rows=100)
        assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
        assert _counted(plain) == _counted(small.select("k", "c", "d", "v"))
        assert _counted(plain) == _counted(large.select("k", "c", "d", "v"))


def test_repeat_rows_cuts_large_counts(spark):
    df = spark.createDataFrame([("x", 200_000), ("y", 1), ("z", 0)], "k string, n bigint")
    for slices in (None, 4):
        out = repeat_rows(df, "n", "i", slices)
        got = out.groupBy("k").agg(F.count("*"), F.min("i"), F.max("i"), F.countDistinct("i"))
        assert sorted(map(tuple, got.collect())) == [
            ("x", 200_000, 1, 200_000, 200_000),
            ("y", 1, 1, 1, 1),
        ]
