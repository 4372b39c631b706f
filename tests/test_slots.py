"""Slot bitmaps: counts and gaps from bits, against instants in plain Python."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gustledger.operators import completeness, joins
from gustledger.session import stage

START = dt.datetime(2024, 1, 30)


def brute(rows, gap):
    """(asset, distinct instants, valid ones, gaps) of (asset, instant, ok) rows."""
    seen, valid = defaultdict(set), defaultdict(set)
    for a, t, ok in rows:
        if t is not None:
            seen[a].add(t)
            if ok:
                valid[a].add(t)
    out = []
    for a, ts in seen.items():
        o = sorted(ts)
        out.append((a, len(o), len(valid[a]), sum((y - x) > dt.timedelta(minutes=gap) for x, y in zip(o, o[1:]))))
    return sorted(out, key=repr)


def series(seed, assets, off=()):
    rng, rows = random.Random(seed), []
    for a in assets:
        slots = rng.sample(range(-40, 900), rng.randint(1, 300)) + rng.sample(range(4000, 9000), rng.randint(0, 9))
        for s in slots:
            t = START + dt.timedelta(minutes=30 * s, seconds=rng.choice([0, 0, 17]) if a in off else 0)
            rows += [(a, t, rng.choice([True, False, None]))] * rng.choice([1, 1, 2])
    return [*rows, ("none", None, True), (assets[0], None, True)]


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
@pytest.mark.parametrize("gap", [10, 30, 45, 60, 95, 200, 1440, 1770, 1800, 1830, 5000])
def test_bits_equal_instants(spark, rows, kind, gap):
    data = series(gap, ["a", "b", "c", None])
    df = spark.createDataFrame(data, f"k string, t {kind}, ok boolean")
    words = completeness.slot_words(df, ["k"], "t", F.col("ok"))
    assert rows(completeness.words_per_asset(words, ["k"], gap)) == brute(data, gap)


@pytest.mark.parametrize("off", [(), ("b", None), ("a", "b", "c", None)])
def test_assets_off_the_grid_take_the_boxes(spark, rows, off):
    data = series(5, ["a", "b", "c", None], off)
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, ok boolean")
    assert rows(completeness.instants_per_asset(df, ["k"], "t", 45, F.col("ok"))) == brute(data, 45)
    assert rows(completeness.gaps(df, "k", "t")) == [(a, g) for a, _, _, g in brute(data, 45)]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-200, 400), min_size=1, max_size=50), st.sampled_from([5, 15, 30, 60, 7]), st.integers(1, 700))
def test_any_step_and_gap(spark, rows, slots, step, gap):
    data = [("a", dt.datetime(1970, 1, 2) + dt.timedelta(minutes=step * s), True) for s in slots]
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, ok boolean")
    assert rows(completeness.instants_per_asset(df, ["k"], "t", gap, step_minutes=step)) == brute(data, gap)


def test_a_probe_that_sees_no_grid_changes_nothing(spark, rows, monkeypatch):
    data = [("x", START + dt.timedelta(seconds=1), True), *series(9, ["a", "b"])]
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, ok boolean").coalesce(1)
    monkeypatch.setattr(completeness, "PROBE_ROWS", 1)
    assert rows(completeness.instants_per_asset(df, ["k"], "t", 45, F.col("ok"))) == brute(data, 45)


def test_months_merge(spark, rows):
    data = series(3, ["a", "b"])
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, ok boolean")
    parts = [completeness.slot_words(df.filter(F.month("t") == m), ["k"], "t", F.col("ok")) for m in range(1, 13)]
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p)
    merged = completeness.merge_words(merged, ["k"])
    assert rows(completeness.words_per_asset(merged, ["k"])) == brute(data, 45)


def test_words_travel_not_instants(spark, tmp_path):
    """One row for each asset, task and word crosses the exchange, and nothing is put in a window."""
    every = spark.range(20 * 6000).select((F.col("id") % 20).alias("k"), F.timestamp_micros(F.floor(F.col("id") / 20) * 1_800_000_000).alias("t"))
    every.repartition(2, "k").write.parquet(str(tmp_path / "t"))
    words = completeness.slot_words(spark.read.parquet(str(tmp_path / "t")), ["k"], "t")
    assert words.count() == 20 * 100
    stored = stage(words, "words")
    plan = completeness.words_per_asset(stored, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("Exchange") == 1
    made = words._jdf.queryExecution().executedPlan().toString()
    assert made.count("HashAggregate") == 2 and "SortAggregate" not in made and "ObjectHashAggregate" not in made
    got = completeness.words_per_asset(stored, ["k"]).collect()
    assert {(r["received"], r["gaps"]) for r in got} == {(6000, 0)}


def test_empty_and_beyond_the_broadcast_limit(spark, rows, monkeypatch):
    data = series(8, ["a", "b", None], ("b",))
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, ok boolean")
    assert completeness.instants_per_asset(df.limit(0), ["k"], "t").count() == 0
    monkeypatch.setattr(joins, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(joins, "HOT_ROWS", 1)
    assert rows(completeness.instants_per_asset(df, ["k"], "t", 45, F.col("ok"))) == brute(data, 45)
