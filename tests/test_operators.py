import random

import pytest
from conftest import plan, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfscout.operators import checks
from shelfscout.operators.joins import left_join_hollow_key, missing_from
from shelfscout.operators.latest import latest_attributes, latest_date, latest_per_key
from shelfscout.operators.ranking import number_rows
from shelfscout.session import materialise, shared_folder


def test_latest_per_key_breaks_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "z"), ("a", 2, "y"), ("b", 1, "q"), (None, 3, "n"), (None, 4, "m")],
        "k string, t int, v string",
    )
    assert rows(latest_per_key(df, ["k"], "t", [F.col("v")])) == rows(
        spark.createDataFrame([("a", 2, "y"), ("b", 1, "q"), (None, 4, "m")], "k string, t int, v string")
    )


def test_latest_per_key_shrinks_a_hot_key_before_the_shuffle(spark):
    df = spark.range(3000).select((F.col("id") % 3 == 0).alias("k"), "id")
    picked = latest_per_key(df, ["k"], "id", [])
    assert plan(picked).count("WindowGroupLimit") == 2
    assert rows(picked) == [(False, 2999), (True, 2997)]


def test_latest_attributes_come_from_one_line(spark):
    lines = [
        ("s", "2024-01-01", "old", "1"),
        ("s", "2024-02-01", "new", None),
        ("s", "2024-02-01", "new", "2"),
        ("t", "2024-01-01", None, "9"),
    ]
    df = spark.createDataFrame(lines, "store string, day string, name string, address string")
    found = latest_attributes(df, ["store"], "day", ["name", "address"])
    assert rows(found) == [("s", "2024-02-01", "new", "2"), ("t", "2024-01-01", None, "9")]


def test_latest_date_prunes_a_partitioned_feed(spark, tmp_path):
    path = str(tmp_path / "feed")
    nights = spark.range(20).select(
        "id", F.expr("date_add(date'2024-01-01', cast(id % 4 as int))").alias("snapshot_date")
    )
    nights.write.partitionBy("snapshot_date").parquet(path)
    feed = spark.read.parquet(path)
    tonight = feed.where(F.col("snapshot_date") == latest_date(feed))
    assert tonight.count() == 5
    filters = [p for p in plan(tonight).split("PartitionFilters: [") if p.startswith("isnotnull")]
    assert any("Subquery" in part.split("]")[0] for part in filters)


def hollow(spark):
    left = spark.createDataFrame(
        [("a", "1"), ("b", None), ("c", None), ("d", "2"), ("e", "1"), ("f", "9")],
        "id string, k string",
    )
    right = spark.createDataFrame([("1", 10), ("2", 20), (None, 99), ("\x1eb", 7)], "k string, v int")
    return left, right


def test_hollow_key_join_equals_a_plain_left_join(spark):
    left, right = hollow(spark)
    expected = left.join(right, "k", "left").select("id", "k", "v")
    found = left_join_hollow_key(left, right, "k", "id").select("id", "k", "v")
    assert rows(found) == rows(expected)


def test_hollow_keys_are_spread_over_tasks(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        left = spark.range(4000).select(
            F.col("id").cast("string").alias("id"),
            F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).alias("k"),
        )
        right = spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
        joined = left_join_hollow_key(left, right, "k", "id")
        assert "hashpartitioning(coalesce(k" in plan(joined)
        assert joined.where("v = 1").count() == 34
        assert joined.count() == 4000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_hot_real_key_is_split(spark):
    """Thresholds lowered to test size; a third of the rows share one store."""
    lowered = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    before = {name: spark.conf.get(name, None) for name in lowered}
    for name, value in lowered.items():
        spark.conf.set(name, value)
    try:
        number = F.col("id").cast("string")
        left = spark.range(200000).select(
            F.sha2(number, 256).alias("id"),
            F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, number).alias("k"),
        )
        right = spark.range(1000).select(
            F.when(F.col("id") == 0, "hot").otherwise(number).alias("k"), F.sha2(number, 256).alias("v")
        )
        joined = left_join_hollow_key(left, right, "k", "id")
        found = {r.k: r["count"] for r in joined.where("v is not null").groupBy("k").count().collect()}
        assert found["hot"] == 66667
        assert len(found) == 1 + 333
        joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_missing_from_ignores_missing_keys(spark):
    left, right = hollow(spark)
    assert rows(missing_from(left, "k", right, "k").select("id", "k")) == [("f", "9")]


@pytest.mark.parametrize("size", [0, 1, 5000])
def test_rank_equals_the_one_task_window(spark, size):
    random.seed(7)
    # Two thirds of the rows share every key but the last.
    data = [
        (f"id{i:05d}", 4 if i % 3 else random.randint(1, 3), 0.0 if i % 3 else random.random())
        for i in range(size)
    ]
    random.shuffle(data)
    df = spark.createDataFrame(data, "id string, tier int, measure double").repartition(7)
    order = [F.col("tier").asc(), F.col("measure").desc(), F.col("id").asc()]
    found = number_rows(df, order, "place")
    window = df.withColumn("place", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    assert rows(found.select("id", "place")) == rows(window.select("id", "place"))


def test_rank_splits_equal_leading_keys(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(20000).select(F.lit(4).alias("tier"), F.col("id").cast("string").alias("id"))
        spread = df.repartitionByRange("tier", "id").groupBy(F.spark_partition_id()).count().collect()
        assert len(spread) == 4
        assert max(r["count"] for r in spread) < 10000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_materialise_writes_to_the_named_folder(spark):
    df = materialise(spark.range(5), "numbers")
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert all(shared_folder(spark) in name for name in df.inputFiles())
    assert df.count() == 5


def dirty(spark):
    return spark.createDataFrame(
        [(1, "a", 5), (2, "a", -1), (3, None, None), (4, None, 11), (5, "z", 10)],
        "id int, kind string, n int",
    )


def test_row_checks(spark):
    df = dirty(spark)
    assert rows(checks.not_null(df, ["id", "kind", "n"])) == [("kind", 2), ("n", 1)]
    assert rows(checks.accepted_values(df, "kind", ["a"])) == [("z", 1)]
    assert rows(checks.accepted_range(df, "n", low=0, high=10).select("id")) == [(2,), (4,)]
    assert checks.accepted_range(df, "n", low=-1, high=11).count() == 0


def test_uniqueness_and_null(spark):
    df = dirty(spark)
    assert rows(checks.unique(df, "kind")) == [("a", 2)]
    assert rows(checks.unique_combination(df, ["kind"])) == [("a", 2), (None, 2)]


def test_integers_as_accepted_values(spark):
    assert rows(checks.accepted_values(dirty(spark), "id", [1, 2, 3])) == [(4, 1), (5, 1)]


def test_suite_reports_one_row_per_check(spark):
    df = dirty(spark)
    suite = checks.run_suite(
        [
            checks.ModelChecks("m", df)
            .not_null("id", "kind")
            .accepted_values("kind", ["a", "z"])
            .accepted_range("n", low=0)
            .unique("id")
            .unique_combination("kind", "n")
            .relationships("id", df.where("id < 5"), "id"),
            checks.ModelChecks("other", df).rows("custom", df.where("n > 10")),
        ]
    )
    assert rows(suite) == sorted(
        [
            ("m", "not_null", "id", 0, True),
            ("m", "not_null", "kind", 2, False),
            ("m", "accepted_values", "kind", 0, True),
            ("m", "accepted_range", "n", 1, False),
            ("m", "unique", "id", 0, True),
            ("m", "unique_combination", "kind,n", 0, True),
            ("m", "relationships", "id", 1, False),
            ("other", "custom", "", 1, False),
        ],
        key=repr,
    )


def test_ranking_computes_its_input_once(spark):
    computed = spark.sparkContext.accumulator(0)

    def count(parts):
        for part in parts:
            computed.add(part.num_rows)
            yield part

    made = spark.range(5000, numPartitions=4).mapInArrow(count, "id long").selectExpr("id", "id % 2 as tier")
    ranked = number_rows(made, [F.col("tier"), F.col("id").desc()], "place")
    want = [(i, i % 2, 2500 * (i % 2) + (4999 - i) // 2 + 1) for i in range(5000)]
    assert rows(ranked) == sorted(want, key=repr)
    assert computed.value == 5000
