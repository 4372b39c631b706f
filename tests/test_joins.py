import pytest
from pyspark.sql import functions as F

from gustledger.operators import joins


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, some NULL keys, some keys without a partner."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40)
    left = spark.range(3000, numPartitions=6).select(key.cast("int").alias("k"), (F.col("id") % 11).alias("v"))
    right = spark.createDataFrame(
        [(k, f"r{k}") for k in range(0, 40, 2)] + [(7, "a"), (7, "b"), (None, "null")], "k int, w string"
    )
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_join_equals_plain_join(skewed, rows, how, null_safe):
    left, right = skewed
    got = joins.salted_join(left, right, ["k"], how, null_safe, rows_per_task=60)
    want = joins.key_join(left, right, ["k"], how, null_safe)
    assert got.columns == want.columns
    assert rows(got) == rows(want)


@pytest.mark.parametrize(("a", "b"), [("int", "bigint"), ("bigint", "int"), ("int", "double"), ("double", "int"), ("date", "timestamp"), ("timestamp", "date")])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_of_different_key_types(spark, rows, a, b, how):
    def typed(n, kind):
        return n.cast(kind) if kind in ("int", "bigint", "double") else F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int")).cast(kind)

    left = spark.range(900, numPartitions=4).select(typed(F.col("id") % 5, a).alias("k"), "id")
    right = spark.range(2, 9).select(typed(F.col("id"), b).alias("k"), (F.col("id") * 2).alias("w"))
    got = joins.salted_join(left, right, ["k"], how, rows_per_task=10)
    want = joins.key_join(left, right, ["k"], how)
    assert got.schema == want.schema
    assert rows(got) == rows(want)


@pytest.mark.parametrize("how", ["right", "full", "outer", "cross"])
def test_salted_join_refuses_kinds_that_repeat_right_rows(skewed, how):
    with pytest.raises(ValueError, match="how must be"):
        joins.salted_join(*skewed, ["k"], how)


def test_hot_keys_have_as_many_salts_as_their_rows_need(spark, skewed):
    left, _ = skewed
    hot = {r["_key_hash"]: r["_salts"] for r in joins.hot_keys(left, ["k"], rows_per_task=100).collect()}
    heavy = spark.sql("select xxhash64(7) as h").first()["h"]
    n = left.filter("k = 7").count()
    assert hot == {heavy: -(-n // 100)}


def test_a_hot_key_among_many_is_found_by_a_small_sketch(spark, monkeypatch):
    """Fifty thousand keys, of which the sketch tracks 64; one holds a third of the rows, one a tenth."""
    monkeypatch.setattr(joins, "SKETCH_ITEMS", 64)
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit(-1)).when(n % 10 == 1, F.lit(-2)).otherwise(n)
    df = spark.range(0, 90_000, 1, 12).select(key.alias("k"))
    hot = {r["_key_hash"]: r["_salts"] for r in joins.hot_keys(df, ["k"], rows_per_task=2000).collect()}
    of = {r["k"]: r["h"] for r in spark.sql("select k, xxhash64(k) as h from values (-1L), (-2L) t(k)").collect()}
    counts = {k: df.filter(F.col("k") == k).count() for k in of}
    assert hot == {of[k]: -(-counts[k] // 2000) for k in of}


def test_exact_counts_decide_and_only_where_needed(spark, monkeypatch):
    """Proposals that are not hot are refused; without proposals nothing is counted."""
    staged = []
    monkeypatch.setattr(joins, "stage", lambda df, name: staged.append(name) or df)
    df = spark.range(0, 1000, 1, 4).select((F.col("id") % 100).alias("k"))
    assert joins.hot_keys(df, ["k"], rows_per_task=10).count() == 0 and staged == ["hot_proposals"]
    staged.clear()
    monkeypatch.setattr(joins, "proposed_keys", lambda hashes, most: hashes.distinct())
    assert joins.hot_keys(df, ["k"], rows_per_task=10).count() == 0 and staged == ["hot_keys"]


def test_salted_join_reads_the_left_side_once(spark, tmp_path, rows):
    """The join's plan has one scan of the left table; the keys were counted by a pass over the key column."""
    skew = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50)
    spark.range(0, 3000, 1, 4).select(skew.alias("k"), F.repeat(F.lit("x"), F.lit(20)).alias("wide")).write.parquet(str(tmp_path / "left"))
    left = spark.read.parquet(str(tmp_path / "left"))
    right = spark.range(50).withColumnRenamed("id", "k")
    out = joins.salted_join(left, right, ["k"], rows_per_task=100)
    assert rows(out) == rows(joins.key_join(left, right, ["k"], "inner"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [k#") == 1 and "wide#" in plan


def test_broadcasts_are_bounded_by_bytes(spark, monkeypatch):
    from gustledger.session import stage

    df = stage(spark.range(100).select("id", F.repeat(F.col("id").cast("string"), F.lit(500)).alias("wide")), "wide")
    assert joins.fits_broadcast(df)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 500)
    assert not joins.fits_broadcast(df)
    assert not joins.fits_broadcast(df, 1)


def test_salt_spreads_a_hot_key(spark):
    left = spark.range(0, 4000, 1, 8).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    right = spark.createDataFrame([(1, "x")], "k int, w string")
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = joins.salted_join(left, right, ["k"], rows_per_task=250)
        parts = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in parts) == 4000
    assert len(parts) > 1  # identical rows of one key, yet several partitions


@pytest.mark.parametrize("limit", [0, 1000])
def test_lookup_join_beyond_and_within_the_limit(skewed, rows, limit):
    left, right = skewed
    got = joins.lookup_join(left, right, ["k"], "left", max_rows=limit)
    assert rows(got) == rows(joins.key_join(left, right, ["k"], "left"))


def test_embedded_key_join(spark, rows):
    facts = spark.createDataFrame(
        [("EOL.CV.RN.037102-5.01", 1), ("EOL.037199-0", 2), ("-", 3), (None, 4)], "ceg string, n int"
    )
    registry = spark.createDataFrame([("037102-5", "A"), (None, "B"), ("", "C")], "code string, spe string")
    got = joins.embedded_key_join(facts, registry.filter("code <> ''"), "ceg", "code", r"\d{6}-\d")
    assert rows(got, "n", "spe") == [(1, "A")]


def test_repeated_registry_key_fans_out(spark, rows):
    facts = spark.createDataFrame([("x037102-5", 1)], "ceg string, n int")
    registry = spark.createDataFrame([("037102-5", "A"), ("037102-5", "B")], "code string, spe string")
    got = joins.embedded_key_join(facts, registry, "ceg", "code", r"\d{6}-\d")
    assert rows(got, "n", "spe") == [(1, "A"), (1, "B")]


def test_semi_filter_ignores_case_and_null(spark, rows):
    df = spark.createDataFrame([("Abc", 1), ("x", 2), (None, 3)], "k string, n int")
    wanted = spark.createDataFrame([("aBC",), ("aBC",), (None,)], "w string")
    assert rows(joins.semi_filter(df, F.col("k"), wanted, F.col("w")), "n") == [(1,)]


def test_case_insensitive_left_join(spark, rows):
    left = spark.createDataFrame([("Ab", 1), ("zz", 1), (None, 1), ("ab", 2)], "a string, t int")
    right = spark.createDataFrame([("AB", 1, "hit"), (None, 1, "never")], "b string, t int, w string")
    got = joins.case_insensitive_left_join(left, right, F.col("a"), F.col("b"), ["t"])
    assert rows(got, "a", "t", "w") == sorted(
        [("Ab", 1, "hit"), ("zz", 1, None), (None, 1, None), ("ab", 2, None)], key=repr
    )


def test_missing_keys(spark, rows):
    registry = spark.createDataFrame([("p", "a"), ("p", "b")], "projeto string, spe string")
    facts = spark.createDataFrame([("a",), ("a",)], "s string")
    assert rows(joins.missing_keys(registry, facts, "spe", "s"), "spe") == [("b",)]


def test_key_difference_treats_null_as_equal(spark, rows):
    df = spark.createDataFrame([(None, 1), (2, 2)], "k int, n int")
    keys = spark.createDataFrame([(None,)], "k int")
    assert rows(joins.key_difference(df, keys, ["k"]), "n") == [(2,)]
    assert rows(joins.key_intersection(df, keys, ["k"]), "n") == [(1,)]
