"""Counters that come with a write."""

import pytest
from pyspark.sql import functions as F

from gustledger.operators import profile
from gustledger.plans import domain as D
from gustledger.plans import report
from gustledger.sources.snapshots import Store


def metrics():
    return {"rows": F.count("*"), "odd": F.count_if(F.col("id") % 2 == 1), "top": F.max("id"), "nulls": F.count_if(F.col("v").isNull())}


def frame(spark, n):
    return spark.range(n, numPartitions=5).selectExpr("id", "if(id % 10 = 3, null, id) as v", "concat('m', id % 3) as m")


@pytest.mark.parametrize("how", [{}, {"partition_by": "m"}, {"key": ("id",)}, {"partition_by": "m", "key": ("id",)}])
def test_counters_equal_an_aggregate(spark, tmp_path, how):
    df, counter = frame(spark, 1000), profile.Counter(metrics())
    written = Store(spark, str(tmp_path)).write(df, "t", **how, counter=counter)
    want = df.agg(*[c.alias(n) for n, c in metrics().items()]).first()
    assert counter.row(spark).first() == want
    assert written.count() == 1000 and sorted(written.columns) == sorted(df.columns)


@pytest.mark.parametrize("df", ["no rows", "nothing left"])
def test_counters_of_an_empty_table(spark, df):
    df = frame(spark, 0) if df == "no rows" else frame(spark, 50).filter("id < 0")
    stored, row = profile.stage_counted(df, "counted", {n: c for n, c in metrics().items() if n != "top"})
    assert stored.count() == 0 and tuple(row.first()) == (0, 0, 0)


def test_counters_behind_a_shuffle_and_a_join(spark):
    df = frame(spark, 1000).join(frame(spark, 500).select("id"), "id").repartition(7, "m")
    stored, row = profile.stage_counted(df, "counted", metrics())
    assert tuple(row.first()) == tuple(stored.agg(*metrics().values()).first())


def test_sections_read_counters_only(spark):
    names = [f"nulls_{m}" for m in D.METRICS]
    row = lambda *counters: spark.createDataFrame([(4,) * (len(counters) + len(names))], ", ".join(f"{n} long" for n in [*counters, *names]))
    counts = report.Counts(
        row("rows", "vento_soft_drop", "aud_geracao_negativa", "aud_vento_fora_faixa", "aud_vento_flag"),
        row("rows", "alertas", "vento_nulo", "geracao_nula", "sem_conjunto", "flag_1", "flag_null"),
        spark.createDataFrame([(7, 3)], "rows long, hard_drops long"),
    )
    duplicates = spark.createDataFrame([(1, 2)], "identical_removed long, conflicting long")
    sections = [report.volumetry(counts, duplicates), report.wind_states(counts), report.business_rules(counts), report.null_profile(counts)]
    for section in sections:
        assert "Scan parquet" not in section._jdf.queryExecution().executedPlan().toString()
    assert tuple(sections[0].first()) == (4, 1, 2, 3, 7, 4, 4, 4, 4, 4)
    assert sections[1].first()[0] == -4
    assert {r.regra: r.acao for r in sections[2].collect()} == report.RULE_ACTIONS
    assert {tuple(r) for r in sections[3].collect()} == {(m, 100.0, 100.0) for m in D.METRICS}
