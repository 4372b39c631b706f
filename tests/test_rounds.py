"""Cases where ordinary data would hide a fault: extreme values, broken keys, damaged tables, drifting folders."""

import glob
import json
import math
import os

import pytest
from pyspark.sql import functions as F

from gustledger import session
from gustledger.operators import distribution, profile
from gustledger.operators.keys import KeyViolation
from gustledger.plans import analytics, medallion, silver, star
from gustledger.sources import files, sinks

INF = float("inf")
FACT = "spe string, din_instante timestamp_ntz, val_geracaoverificada double, val_geracaoestimada double, val_ventoverificado double"


def test_extreme_measurements_show_in_the_energy(spark):
    import datetime as dt

    at = dt.datetime(2024, 1, 1)
    day = lambda n: at + dt.timedelta(days=n)
    facts = spark.createDataFrame(
        [("a", day(0), INF, 4e-9, 1.0), ("a", day(0), 2.0, 4e-9, INF), ("a", day(1), 1e21, 1.0, 3.0), ("a", day(1), 1.0, None, None),
         ("a", day(2), 0.5, 0.25, 2.0)], FACT)
    dim = spark.createDataFrame([("a", "P")], "spe string, projeto_cv string")
    got = {r["periodo"].day: r for r in analytics.generation(facts, dim, "P").collect()}
    assert got[1]["total_mwh_verificado"] == INF and got[1]["vento_medio_ms"] == INF and got[1]["total_mwh_estimado"] == 0.0
    assert got[2]["total_mwh_verificado"] == pytest.approx(5e20) and got[2]["vento_medio_ms"] == 3.0
    assert got[3]["total_mwh_verificado"] == 0.25


def test_small_measurements_add_up(spark):
    facts = spark.range(1_000_000).select(
        F.lit("a").alias("spe"), F.lit("2024-01-01").cast("timestamp_ntz").alias("din_instante"), F.lit(4e-9).alias("val_geracaoverificada"),
        F.lit(None).cast("double").alias("val_geracaoestimada"), F.lit(None).cast("double").alias("val_ventoverificado"))
    dim = spark.createDataFrame([("a", "P")], "spe string, projeto_cv string")
    r = analytics.generation(facts, dim, "P", interval_hours=5.0).first()
    assert r["total_mwh_verificado"] == 0.02 and r["total_mwh_estimado"] is None


def test_extreme_restrictions(spark):
    rows = [("g", "2024-01-01", "R", "O", "t", 1.0, INF, None), ("h", "2024-01-01", "R", "O", "t", 1.0, 1e21, None), ("k", "2024-01-01", "R", "O", "t", 1.0, 4.0, 3.0)]
    facts = spark.createDataFrame(rows, "id_ons_conjunto string, din_instante string, cod_razaorestricao string, cod_origemrestricao string, dsc_restricao string,"
                                  "val_geracaolimitada double, val_geracaoreferencia double, val_geracaoreferenciafinal double")
    facts = facts.withColumn("din_instante", F.col("din_instante").cast("timestamp_ntz"))
    groups = spark.createDataFrame([(g, g) for g in "ghk"], "id_ons_conjunto string, nom_conjunto string")
    assets = spark.createDataFrame([(g, "P") for g in "ghk"] + [("k", "Q")], "id_ons_conjunto string, projeto_cv string")
    got = {r["nome_conjunto"]: r["total_mwh_cortado"] for r in analytics.restrictions(facts, groups, assets, star.dim_restricao(spark), "P").collect()}
    assert got == {"g": INF, "h": pytest.approx(1e21), "k": 2.0}
    assert analytics.shared_groups(assets).collect() == [("k", 2)]


def test_distribution_of_extreme_values(spark):
    df = spark.createDataFrame([(INF, 1e21, 4e-9), (1.0, 2.0, 4e-9), (2.0, None, None)], "a double, b double, c double")
    got = {r["coluna"]: r for r in distribution.distribution(df, ["a", "b", "c"], digits=10).collect()}
    assert (got["a"]["min"], got["a"]["p50"], got["a"]["max"], got["a"]["media"]) == (1.0, 2.0, INF, INF)
    assert got["b"]["max"] == 1e21 and got["b"]["media"] == pytest.approx(5e20)
    assert got["c"]["min"] == got["c"]["media"] == 4e-9


@pytest.mark.parametrize("by", [None, ["g"]])
def test_bands_narrow_until_a_task_can_order_them(spark, monkeypatch, by):
    monkeypatch.setattr(distribution, "BAND_ROWS", 20)
    monkeypatch.setattr(distribution, "_margins", lambda probs: [0.1, 0.9])
    df = spark.range(3000).select((F.col("id") % 2).alias("g"), F.pmod(F.xxhash64("id"), F.lit(700)).cast("double").alias("v"))
    probs = {"p25": 0.25, "p50": 0.5, "p99": 0.99}
    for r in distribution.distribution(df, ["v"], by, probs).collect():
        own = df.filter(F.col("g") == r["g"]) if by else df
        want = own.agg(F.percentile("v", [0.25, 0.5, 0.99])).first()[0]
        assert [r[p] for p in probs] == pytest.approx([round(w, 4) for w in want])


# --- files --------------------------------------------------------------------------------------

def test_drifting_files_of_a_folder_or_glob(spark, rows, tmp_path):
    base = str(tmp_path)
    spark.createDataFrame([(1,)], "id long").coalesce(1).write.parquet(f"{base}/set/a")
    spark.createDataFrame([(2, 2.5)], "id long, val_x double").coalesce(1).write.parquet(f"{base}/set/b")
    spark.createDataFrame([(3, "3,5", "t"), (4, "4.5", None)], "id int, val_x string, more string").coalesce(1).write.parquet(f"{base}/set/c")
    for paths in ([f"{base}/set"], [f"{base}/set/*"], [f"{base}/set/a", f"{base}/set/b", f"{base}/set/c"]):
        got = files.read_union(spark, paths, {"id": "bigint", "val_x": "double"}, file_column=None)
        assert rows(got, "id", "val_x", "more") == [(1, None, None), (2, 2.5, None), (3, None, "t"), (4, 4.5, None)]
    untyped = files.read_union(spark, [f"{base}/set"], file_column="f")
    assert rows(untyped, "id", "val_x")[1] == ("2", "2.5") and untyped.filter("f IS NULL").count() == 0


def test_month_folders_stay_columns(spark, rows, tmp_path):
    spark.range(4).select("id", (F.col("id") % 2).alias("mes")).write.partitionBy("mes").parquet(f"{tmp_path}/t")
    assert rows(files.read_union(spark, [f"{tmp_path}/t"], file_column=None), "id", "mes") == [(0, 0), (1, 1), (2, 0), (3, 1)]


def test_named_tables_are_replaced(spark, rows):
    try:
        sinks.save_named(spark.range(3).toDF("a"), "rounds_named")
        assert rows(sinks.save_named(spark.range(2).toDF("b"), "rounds_named")) == [(0,), (1,)]
    finally:
        spark.sql("DROP TABLE IF EXISTS rounds_named")


# --- Gold ---------------------------------------------------------------------------------------

def _silver(spark, names=("a", "b")):
    row = "id_ons_conjunto string, id_subsistema string, nom_subsistema string, id_estado string, nom_modalidadeoperacao string, nom_conjuntousina string," \
          "nom_usina string, nome_spe_cv string, id_ons_spe string, din_instante timestamp_ntz, val_ventoverificado double, flg_dadoventoinvalido double," \
          "val_geracaoestimada double, val_geracaoverificada double, flg_estimada_por_historico int, val_geracao_conjunto double, val_geracaolimitada_conjunto double," \
          "val_disponibilidade_conjunto double, val_geracaoreferencia_conjunto double, val_geracaoreferenciafinal_conjunto double, flg_alerta_limitada int," \
          "cod_razaorestricao string, cod_origemrestricao string, dsc_restricao string"
    import datetime as dt

    at, texts = dt.datetime(2024, 1, 1), [("Z", "A", "z"), ("A", "Z", None)]
    return spark.createDataFrame(
        [("G", "S", "Sul", "RS", "Tipo II-C", "c", "u", n, n, at, 1.0, 0.0, 1.0, 1.0, 0, 1.0, 1.0, 1.0, 1.0, 1.0, 0, *texts[i % 2]) for i, n in enumerate(names)], row)


def _content(out):
    return {f: open(f, "rb").read() for f in glob.glob(f"{out}/**/part-*", recursive=True)}


def test_a_broken_key_leaves_the_old_gold(spark, tmp_path):
    out, registry = str(tmp_path), spark.createDataFrame([("a", "P", "1"), ("b", "P", "2")], "spe string, projeto string, ceg string")
    gold = medallion.gold_layer(_silver(spark), registry, out)
    fact = gold["fato_geracao_conjunto"].first()
    assert (fact["cod_razaorestricao"], fact["cod_origemrestricao"], fact["dsc_restricao"]) == ("A", "Z", None)  # of one row
    checks = [json.loads(line) for f in glob.glob(f"{out}/checks_gold/part-*") for line in open(f)]
    assert {"check": "coverage", "item": "assets", "n": 2} in checks and {"check": "rows", "item": "dim_spe", "n": 2} in checks
    before = _content(out)
    assert len({os.path.dirname(f).removeprefix(out).split("/")[1] for f in before}) == 7
    for broken in (_silver(spark, ["a", "a"]), _silver(spark).withColumn("din_instante", F.lit(None).cast("timestamp_ntz"))):
        with pytest.raises(KeyViolation):
            medallion.gold_layer(broken, registry, out)
        assert _content(out) == before


def test_groups_that_report_twice_are_found(spark):
    rows = [("Conj", "2024-01-01 00:00:00"), ("CONJ", "2024-01-01 00:00:00"), ("Conj", "2024-01-01 00:30:00"), (None, "2024-01-01 00:00:00")]
    found = silver.repeated_groups(spark.createDataFrame(rows, "nom_usina string, din_instante string")).collect()
    assert [(r["nom_usina"], r["n"]) for r in found] == [("CONJ", 2)]


# --- health and staging -------------------------------------------------------------------------

def test_a_damaged_table_is_degraded(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/good")
    spark.range(0).write.parquet(f"{tmp_path}/empty")
    os.makedirs(f"{tmp_path}/bad")
    with open(f"{tmp_path}/bad/part-0.parquet", "wb") as f:
        f.write(b"PAR1 no table PAR1")
    paths = {n: f"{tmp_path}/{n}" for n in ("good", "empty", "bad", "absent")}
    got = {r["table"]: (r["status"], r["n"], r["detail"]) for r in profile.health(spark, paths).collect()}
    assert got["good"] == ("UP", 3, None) and got["empty"] == ("DEGRADED", 0, None)
    assert got["bad"][0] == "DEGRADED" and got["bad"][2] and got["absent"] == ("DOWN", None, "PATH_NOT_FOUND")


def test_a_scope_drops_what_it_staged(spark):
    outer = session.stage(spark.range(2), "outer")
    with pytest.raises(RuntimeError), session.staging_scope(spark):
        inner = session._staged and session.stage(spark.range(3), "inner")
        path = session._staged[-1]
        assert inner.count() == 3
        raise RuntimeError
    assert path not in session._staged and not os.path.exists(path.removeprefix("file://"))
    assert outer.count() == 2


@pytest.mark.parametrize("master", ["local-cluster[2,1,1024]", "spark://host:7077", "yarn"])
def test_only_local_mode_gets_a_machine_local_folder(master):
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            pass

    Cluster.sparkContext.master = master
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.staging_root(Cluster)


def test_rounding_passes_extremes(spark):
    from gustledger.functions import columns as C

    got = spark.createDataFrame([(INF,), (-INF,), (float("nan"),), (1e30,), (2.345,), (None,)], "v double").select(C.round_half_up(F.col("v"), 2)).collect()
    assert [g[0] for g in got[:2]] == [INF, -INF] and math.isnan(got[2][0]) and got[3][0] == 1e30 and got[4][0] == 2.35 and got[5][0] is None
