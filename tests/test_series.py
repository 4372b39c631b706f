import datetime as dt

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gustledger.operators import completeness, distribution, profile

START = dt.datetime(2024, 1, 3)


def at(*minutes):
    return [START + dt.timedelta(minutes=m) for m in minutes]


def test_gaps_are_steps_above_the_limit(spark, rows):
    stamps = at(0, 30, 75, 121, 421, 421)  # steps of 30, 45, 46, 300 and 0 minutes
    df = spark.createDataFrame([("a", t) for t in stamps] + [("b", START)], "k string, t timestamp_ntz")
    assert rows(completeness.gaps(df, "k", "t")) == [("a", 2), ("b", 0)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 2000), min_size=1, max_size=40))
def test_gaps_equal_brute_force(spark, rows, minutes):
    df = spark.createDataFrame([("a", t) for t in at(*minutes)], "k string, t timestamp_ntz")
    ordered = sorted(minutes)
    assert rows(completeness.gaps(df, "k", "t")) == [("a", sum(b - a > 45 for a, b in zip(ordered, ordered[1:])))]


@pytest.fixture(scope="module")
def month(spark):
    """One asset with every slot of January but one, one registered asset without data."""
    slots = [dt.datetime(2024, 1, 1) + dt.timedelta(minutes=30 * i) for i in range(31 * 48)]
    data = [("a", t, None if i < 100 else 1.0) for i, t in enumerate(slots) if i != 700]
    df = spark.createDataFrame([*data, data[0]], "asset string, ts timestamp_ntz, v double")
    registry = spark.createDataFrame([("P", "a"), ("P", "b"), ("Q", "c")], "project string, asset string")
    return df, registry


def test_completeness(spark, month):
    df, registry = month
    assets = completeness.asset_completeness(df, registry, "asset", "project", "ts", F.col("v").isNotNull())
    p, q = completeness.project_completeness(assets, "project").orderBy("project").collect()
    slots = 31 * 48
    assert (p["spes_esperadas"], p["spes_sem_dado"], p["n_periodos_fixo_por_spe"]) == (2, 1, slots)
    assert (p["esperado_total"], p["recebido_total"], p["recebido_valido"]) == (2 * slots, slots - 1, slots - 101)
    assert (p["pct_envio"], p["pct_dados_validos"], p["gaps_detectados"]) == (50.0, 46.6, 1)
    assert p["alerta"] and q["alerta"] and q["pct_envio"] == 0.0
    problems = completeness.problem_assets(assets, "project", "asset").collect()
    assert [tuple(r) for r in problems] == [("P", "a", slots - 1, slots, 99.9, 1)]
    absent = completeness.assets_without_data(assets, "project", "asset").collect()
    assert sorted(tuple(r) for r in absent) == [("P", "b"), ("Q", "c")]


def test_unique_shortcut_gives_the_same(month, rows):
    df, registry = month
    args = (registry, "asset", "project", "ts", F.col("v").isNotNull())
    exact = completeness.asset_completeness(df.distinct(), *args, unique=True)
    assert rows(exact) == rows(completeness.asset_completeness(df, *args))


def test_explicit_period(month):
    df, registry = month
    assets = completeness.asset_completeness(df, registry, "asset", "project", "ts", slots=F.lit(2000).cast("long"))
    assert {r["expected"] for r in assets.collect()} == {2000}


@pytest.mark.parametrize(
    "last, status, ok, message",
    [
        (dt.datetime(2023, 12, 31, 23, 30), "OK", True, "Último registro: 31/12/2023 23:30"),
        (dt.datetime(2024, 1, 1), "ALERTA", False, "Base contém dados do mês atual (01/2024)"),
        (dt.datetime(2023, 11, 30), "FALHA", False, "Dados desatualizados. Último: 30/11/2023 00:00"),
        (None, "FALHA", False, "Sem dados"),
    ],
)
def test_freshness_in_january(spark, last, status, ok, message):
    df = spark.createDataFrame([(last,)], "t timestamp_ntz")
    got = completeness.freshness(df, "t", F.lit("2024-01-15").cast("date")).first()
    assert (got["status"], got["ok"], got["mensagem"]) == (status, ok, message)
    assert got["ultimo_mes_esperado"] == ("N/A" if last is None else "12/2023")


def quartiles(values):
    v = np.array(values, dtype=float)
    return [round(float(x), 4) for x in (v.min(), *np.quantile(v, [0.25, 0.5, 0.75]), v.max(), v.mean())]


def check(got, values):
    assert [got[c] for c in ("min", "p25", "p50", "p75", "max", "media")] == pytest.approx(quartiles(values), abs=2e-4)


def test_distribution_of_groups(spark):
    """One group with a third of the rows in one value, one tiny group, a NULL group, no values."""
    rng = np.random.default_rng(7)
    data = [("big", float(x)) for x in rng.normal(0, 1e3, 4000)] + [("big", 12.5)] * 2000
    data += [("one", 3.25), ("two", -1.0), ("two", 2.0), (None, 5.0), (None, 7.0), ("none", None), ("none", float("nan"))]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r["g"]: r for r in distribution.distribution(df, ["v", "absent"], ["g"]).collect()}
    assert set(got) == {"big", "one", "two", None}
    for g, r in got.items():
        check(r, [v for k, v in data if k == g])


def test_distribution_of_columns(spark):
    rng = np.random.default_rng(8)
    data = [(float(a), float(b)) for a, b in zip(rng.integers(0, 40, 3000), rng.exponential(1, 3000))]
    df = spark.createDataFrame(data, "a double, b double").withColumn("empty", F.lit(None).cast("double"))
    got = {r["coluna"]: r for r in distribution.distribution(df, ["a", "b", "empty"]).collect()}
    assert set(got) == {"a", "b"}
    check(got["a"], [x[0] for x in data])
    check(got["b"], [x[1] for x in data])


def test_distribution_does_not_depend_on_the_sketch(spark, monkeypatch):
    """Bands in the wrong place only make more rows to order."""
    monkeypatch.setattr(distribution, "_margins", lambda probs: [0.9, 0.91, 0.92, 0.93, 0.94, 0.95])
    data = [float(x * x % 997) for x in range(2000)]
    df = spark.createDataFrame([(v,) for v in data], "v double")
    check(distribution.distribution(df, ["v"]).first(), data)


@pytest.mark.parametrize("by", [None, ["g"]])
def test_bands_that_are_too_large_are_banded_again(spark, monkeypatch, by):
    """With a few rows a task, bands are parted over and over; heavy, infinite and equal values among them."""
    monkeypatch.setattr(distribution, "BAND_ROWS", 3)
    monkeypatch.setattr(distribution, "ACCURACY", 50)
    rng = np.random.default_rng(11)
    values = [*map(float, rng.normal(0, 5, 1500)), *[1.25] * 700, *map(float, rng.exponential(1e6, 300))]
    data = [("a" if i % 3 else "b", v) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r["g"] if by else None: r for r in distribution.distribution(df, ["v"], by).collect()}
    for g, r in got.items():
        check(r, [v for k, v in data if g in (k, None)])
    assert len(got) == (2 if by else 1)


def test_bands_are_numbers_of_generated_code(spark):
    """No array is built for a value, and no text is a key but the metric's name."""
    df = spark.range(100).select(F.col("id").cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"))
    banded = distribution._banded(df, ["a", "b"], [], [0.2, 0.3, 0.7])
    plan = banded.groupBy("coluna", "_band").count()._jdf.queryExecution().executedPlan().toString()
    assert "transform(" not in plan and "lambda" not in plan and dict(banded.dtypes)["_band"] == "bigint"
    assert {r["_band"] for r in banded.collect()} <= set(range(7))


@pytest.mark.parametrize("low", [-5.0, 1.2499])
def test_a_value_that_fills_a_band_is_parted_from_the_rest(spark, monkeypatch, low):
    """All ranks of the grid are the heavy value; the one below it must leave the band all the same."""
    monkeypatch.setattr(distribution, "BAND_ROWS", 3)
    monkeypatch.setattr(distribution, "_margins", lambda probs: [1.0])
    data = [low] + [1.25] * 700 + [2.0]
    check(distribution.distribution(spark.createDataFrame([(v,) for v in data], "v double"), ["v"]).first(), data)


def test_null_profile(spark, rows):
    before = spark.createDataFrame([(1.0, None), (None, None), (3.0, 1.0)], "a double, b double")
    after = before.filter("a is not null")
    assert rows(profile.null_profile(before, after, ["a", "b", "zzz"])) == [("a", 33.33, 0.0), ("b", 66.67, 50.0)]


def test_health_reports_each_state(spark, tmp_path, rows):
    spark.range(3).write.parquet(str(tmp_path / "full"))
    spark.range(0).write.parquet(str(tmp_path / "empty"))
    paths = {n: str(tmp_path / n) for n in ("full", "empty", "absent")}
    got = {r["table"]: (r["status"], r["n"]) for r in profile.health(spark, paths).collect()}
    assert got == {"full": ("UP", 3), "empty": ("DEGRADED", 0), "absent": ("DOWN", None)}


def test_trace_and_describe(spark, rows):
    df = spark.createDataFrame([("ab50017-8", 1), ("x", 2)], "ceg string, n int")
    got = profile.trace({"raw": (df, F.col("ceg").like("%50017%")), "final": (df, F.col("n") > 0)})
    assert rows(got) == [("final", 2), ("raw", 1)]
    assert rows(profile.describe(df)) == [("ceg", "string"), ("n", "int")]


def test_coverage(spark):
    dim = spark.createDataFrame([("a", "g"), ("b", None)], "spe string, grp string")
    fact = spark.createDataFrame([("a",), ("a",)], "spe string")
    assert tuple(profile.coverage(fact, dim, "spe", "spe", "grp").first()) == (2, 1, 1, 1)
