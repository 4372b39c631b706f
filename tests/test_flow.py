"""The wind flow end to end on a generated two-month fixture."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from gustledger.functions import columns as C
from gustledger.operators import duplicates, keys
from gustledger.plans import analytics, domain as D, medallion, silver, star

JAN = [dt.datetime(2024, 1, 1) + dt.timedelta(minutes=30 * i) for i in range(31 * 48)]
FEB = [dt.datetime(2024, 2, 1) + dt.timedelta(minutes=30 * i) for i in range(29 * 48)]

# asset, project, plant code, mode, group, own name
ASSETS = [
    ("AAA01", "P1", "100001-1", "Tipo II-C", "Conj. Um", "Usina A1"),
    ("AAA02", "P1", "100002-2", "Tipo II-C", "conj. um", "Usina A2"),
    ("BBB01", "P2", "100003-3", "Tipo I", "Ignored", "Usina Dois"),
]
GROUPS = [("G1", "CONJ. UM"), ("G2", "usina dois"), ("G9", "Alheio")]

DETAIL = ("id_subsistema string, id_estado string, nom_estado string, nom_modalidadeoperacao string, "
          "nom_conjuntousina string, nom_usina string, id_ons string, ceg string, din_instante {t}, "
          "val_ventoverificado {n}, flg_dadoventoinvalido {n}, val_geracaoestimada {n}, val_geracaoverificada {n}")
GROUP = ("id_subsistema string, nom_subsistema string, id_estado string, nom_usina string, id_ons string, ceg string, "
         "din_instante timestamp_ntz, val_geracao double, cod_razaorestricao string, cod_origemrestricao string, "
         "dsc_restricao string, val_geracaolimitada double, val_disponibilidade double, val_geracaoreferencia double, "
         "val_geracaoreferenciafinal double")


def detail_row(asset, t, wind=10.0, flag=0.0, estimated=2.0, verified=2.0):
    name, _, code, mode, group, own = asset
    return ("NE", "BA", "Bahia", mode, group, own, f"ID{name}", f"EOL.CV.BA.{code}.01", t, wind, flag, estimated, verified)


def group_row(group, t, generation=100.0, reason=None, origin=None, limit=None, initial=50.0, final=None):
    return ("NE", "Nordeste", "BA", group[1], group[0], "-", t, generation, reason, origin, reason and "texto próprio",
            limit, 120.0, initial, final)


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """January as numbers, February as text; both with known defects."""
    base = tmp_path_factory.mktemp("raw")
    jan, feb = [], []
    for asset in ASSETS:
        jan += [detail_row(asset, t) for t in JAN]
        feb += [detail_row(asset, t) for t in FEB if not (asset[0] == "BBB01" and t.day in (10, 11))]
    jan += [detail_row(("ZZZ99", "-", "999999-9", "Tipo I", "x", "Estranha"), t) for t in JAN[:10]]  # not registered
    jan[0] = detail_row(ASSETS[0], JAN[0], wind=40.1)
    jan[1] = detail_row(ASSETS[0], JAN[1], flag=1.0)
    jan[2] = detail_row(ASSETS[0], JAN[2], flag=None, wind=None)
    jan[3] = detail_row(ASSETS[0], JAN[3], estimated=-1.0, flag=7.0)  # two contract failures
    jan += [jan[10], jan[11], detail_row(ASSETS[0], JAN[11], verified=3.0)]  # identical; conflicting
    text = [tuple(str(x) if isinstance(x, (float, dt.datetime)) else x for x in r) for r in feb]
    text[0] = (*text[0][:9], "abc", "1.0", *text[0][11:])
    text.append((*text[1][:8], "not a date", *text[1][9:]))
    numbers = spark.createDataFrame(jan, DETAIL.format(t="timestamp_ntz", n="double"))
    drift = spark.createDataFrame(text, DETAIL.format(t="string", n="string")).withColumn("nova", F.lit("x"))
    details = [str(base / "detail_2024_01"), str(base / "detail_2024_02")]
    numbers.coalesce(1).write.parquet(details[0])
    drift.coalesce(1).write.parquet(details[1])

    rows = []
    for group in GROUPS:
        for i, t in enumerate(JAN + FEB):
            kind = {0: ("REL", "LOC"), 1: ("XXX", "LOC"), 2: ("ENE", None)}.get(i % 10, (None, None))
            rows.append(group_row(group, t, reason=kind[0], origin=kind[1], limit=20.0 if kind[0] else None))
    rows[5] = group_row(GROUPS[0], JAN[5], generation=-5.0)  # nulled, then rejected
    rows[6] = group_row(GROUPS[0], JAN[6], reason="CNF", origin="SIS", limit=80.0, final=60.0)  # limit above
    groups = str(base / "group")
    spark.createDataFrame(rows, GROUP).coalesce(2).write.parquet(groups)

    seed = base / "seed.csv"
    seed.write_text("projeto,spe,ceg\n" + "".join(f"{a[1]},{a[0]},{a[2]}\n" for a in ASSETS) + "P2,CCC01,100009-9\n")
    return details, [groups], str(seed)


SLOTS = len(JAN) + len(FEB)


@pytest.fixture(scope="module")
def flow(spark, raw, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    return medallion.run(spark, *raw, out, as_of=F.lit("2024-03-05 06:00:00").cast("timestamp_ntz")), out


def read_json(path):
    import glob

    return [json.loads(line) for f in sorted(glob.glob(f"{path}/part-*")) for line in open(f, encoding="utf-8")]


def test_rows_are_kept_once(flow):
    tables, _ = flow
    joined, clean, quarantine = (tables[n].count() for n in ("joined", "silver", "quarantine"))
    assert joined == 3 * SLOTS - 96 + 4
    stages = {r["etapa_rejeicao"]: r["count"] for r in tables["quarantine"].groupBy("etapa_rejeicao").count().collect()}
    # JAN[3] twice broken, JAN[5] of two assets without group generation, one bad date
    assert stages == {D.CONFLICT_STAGE: 3, D.CONTRACT_STAGE: 4}
    assert joined == clean + quarantine + 1  # one identical copy


def test_soft_drops_and_flags(flow, rows):
    silver_rows = flow[0]["silver"].filter("nome_spe_cv = 'AAA01'")
    got = {r["din_instante"]: r for r in silver_rows.filter(F.col("din_instante") < JAN[8]).collect()}
    assert got[JAN[0]]["val_ventoverificado"] is None and got[JAN[0]]["flg_estimada_por_historico"] == 0
    assert got[JAN[1]]["val_ventoverificado"] is None and got[JAN[1]]["flg_estimada_por_historico"] == 1
    assert got[JAN[2]]["flg_dadoventoinvalido"] is None
    assert got[JAN[6]]["flg_alerta_limitada"] == 1 and got[JAN[7]]["flg_alerta_limitada"] == 0
    assert JAN[3] not in got and JAN[5] not in got
    first = silver_rows.filter(F.col("din_instante") == FEB[0]).first()
    assert first["val_ventoverificado"] is None and first["flg_estimada_por_historico"] == 1
    assert first["nova"] == "x" and got[JAN[0]]["nova"] is None


def test_quarantine_reasons(flow, rows):
    rejected = flow[0]["quarantine"].filter(F.col(D.STAGE) == D.CONTRACT_STAGE)
    reasons = sorted(r[D.REASON] for r in rejected.collect())
    assert reasons == sorted([
        "val_geracaoestimada:greater_than_or_equal_to(0); flg_dadoventoinvalido:isin([0, 1])",
        "val_geracao_conjunto:not_nullable",
        "val_geracao_conjunto:not_nullable",
        "nom_subsistema:not_nullable; id_ons_conjunto:not_nullable; din_instante:not_nullable; "
        "val_geracao_conjunto:not_nullable",
    ])
    assert flow[0]["quarantine"].columns[-2:] == [D.REASON, D.STAGE]


def test_group_is_chosen_by_mode(flow, rows):
    got = rows(flow[0]["silver"].select("nome_spe_cv", "id_ons_conjunto").distinct())
    assert got == [("AAA01", "G1"), ("AAA02", "G1"), ("BBB01", "G2")]


def test_gold_tables(flow, rows):
    tables, _ = flow
    assert rows(tables["dim_spe"], "spe", "projeto_cv", "id_ons_conjunto") == [
        ("AAA01", "P1", "G1"), ("AAA02", "P1", "G1"), ("BBB01", "P2", "G2"), ("CCC01", "P2", None)
    ]
    assert tables["dim_tempo"].count() == SLOTS and tables["dim_restricao"].count() == 8
    assert tables["dim_conjunto"].count() == 2
    # both assets of G1 are gone at JAN[5], so the group's instant is gone as well
    assert rows(tables["fato_geracao_conjunto"].groupBy("id_ons_conjunto").count()) == [("G1", SLOTS - 1), ("G2", SLOTS - 96)]
    total = tables["fato_geracao_conjunto"].filter("id_ons_conjunto = 'G1'").agg(F.sum("val_geracao")).first()[0]
    assert total == 100.0 * (SLOTS - 1)  # not once per asset


def test_report(flow):
    tables, out = flow
    (report,) = read_json(f"{out}/report")
    volume = report["volumetria"]
    assert volume["total_registros_brutos"] == tables["joined"].count()
    assert volume["duplicatas_identicas_removidas"] == 1
    assert volume["duplicatas_conflitantes_para_quarentena"] == 3 and volume["hard_drops_pandera"] == 4
    assert volume["total_em_quarentena"] == report["quarentena"]["total"] == 7
    assert volume["vento_anulado_soft_drop"] == 4 and volume["alertas_limitada_flag"] == 2
    assert report["integridade_referencial"] == {
        "spes_esperadas": 4, "spes_com_dados": 3, "registros_sem_conjunto_apos_join": 0
    }
    rules = report["regras_negocio"]
    assert rules["vento_fora_faixa_0_40ms"] == {"falhas": 1, "acao": "campo_nullificado"}
    assert rules["geracao_negativa_bruta"]["falhas"] == 2 and rules["vento_flag_invalido"]["falhas"] == 2
    assert report["freshness"]["status"] == "OK" and report["freshness"]["ultimo_mes_esperado"] == "02/2024"
    assert report["periodo_dados"] == {"inicio": "2024-01-01", "fim": "2024-02-29"}
    assert report["distribuicao_numerica"]["val_geracao_conjunto"]["p50"] == 100.0
    assert report["data_processamento"] == "05/03/2024 06:00:00"


def test_report_tables(flow):
    _, out = flow
    projects = {r["projeto_cv"]: r for r in read_json(f"{out}/completeness_projects")}
    assert projects["P2"]["spes_sem_dado"] == 1 and projects["P2"]["alerta"]
    assert projects["P2"]["gaps_detectados"] == 1 and not projects["P1"]["alerta"]
    assert [r["nome_spe_cv"] for r in read_json(f"{out}/assets_without_data")] == ["CCC01"]
    problems = {r["nome_spe_cv"]: r for r in read_json(f"{out}/completeness_assets")}
    assert problems["BBB01"]["esperado"] == SLOTS and problems["BBB01"]["recebido"] == SLOTS - 96
    texts = [r["justificativa"] for r in read_json(f"{out}/anomalies")]
    assert sum(t.startswith("QUARENTENA: ") for t in texts) == 4
    assert (
        "QUARENTENA: Coluna [val_geracaoestimada] violou [greater_than_or_equal_to(0)] | "
        "Coluna [flg_dadoventoinvalido] violou [isin([0, 1])]" in texts
    )
    assert sum(D.WIND_NULLED in t for t in texts) == 4 and sum(D.LIMIT_ABOVE in t for t in texts) == 2


def test_rerun_gives_the_same(spark, raw, flow, rows, tmp_path):
    again = medallion.run(spark, *raw, str(tmp_path / "out"), as_of=F.lit("2024-03-05").cast("date"))
    for name in ("silver", "quarantine", *D.GOLD_KEYS):
        assert rows(again[name]) == rows(flow[0][name]), name


def test_reference_policy_loses_the_copies(spark, raw, flow):
    joined = flow[0]["joined"]
    treated = silver.treat(joined, duplicates.REFERENCE)
    counts = treated.duplicate_counts().first()
    # with the file name as part of the row nothing changes here: all copies sit in one file
    assert (counts["identical_removed"], counts["conflicting"]) == (1, 1)


def test_generation(flow):
    tables, _ = flow
    daily = analytics.generation(tables["fato_geracao_spe"], tables["dim_spe"], "P2").collect()
    assert len(daily) == 60 - 2 and daily[0]["total_mwh_verificado"] == 48.0
    assert daily[0]["vento_medio_ms"] == 10.0 and daily[0]["qtd_spes_ativas"] == 1
    monthly = analytics.generation(tables["fato_geracao_spe"], tables["dim_spe"], "P2", C.MONTHLY).collect()
    assert [r["periodo"] for r in monthly] == [dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)]
    last = analytics.generation(tables["fato_geracao_spe"], tables["dim_spe"], "P2", C.DAILY, "2024-01-02", "2024-01-03")
    assert [r["total_mwh_verificado"] for r in last.collect()] == [48.0, 1.0]  # only 00:00 of the end day
    assert analytics.generation(tables["fato_geracao_spe"], tables["dim_spe"], "nope").count() == 0
    with pytest.raises(ValueError):
        analytics.generation(tables["fato_geracao_spe"], tables["dim_spe"], "P2", "semanal")


def test_months_outside_are_not_read(flow):
    tables, _ = flow
    fact = analytics.in_period(tables["fato_geracao_spe"], dt.date(2024, 2, 1), "2024-02-29 23:30:00")
    assert len(fact.inputFiles()) and fact.count() == 3 * len(FEB) - 96
    scan = next(x for x in fact._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in x)
    filters = scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "mes_ref" in filters and "2024_02" in filters


def test_gold_views_answer_sql(spark, flow):
    got = spark.sql("""
        SELECT d.projeto_cv, COUNT(DISTINCT f.spe) AS n FROM fato_geracao_spe f JOIN dim_spe d ON f.spe = d.spe
        GROUP BY d.projeto_cv ORDER BY 1""").collect()
    assert [tuple(r) for r in got] == [("P1", 2), ("P2", 1)]


def test_restrictions(flow):
    tables, _ = flow
    args = [tables[n] for n in ("fato_geracao_conjunto", "dim_conjunto", "dim_spe", "dim_restricao")]
    got = analytics.restrictions(*args).collect()
    by_key = {(r["projeto"], r["razao_restricao"], r["origem"]): r for r in got}
    known = by_key["P1", "REL", "LOC"]
    n = sum(i % 10 == 0 for i in range(SLOTS))
    assert known["descricao"] == "Indisponibilidade externa elétrica local"
    assert (known["total_horas_com_restricao"], known["total_mwh_cortado"]) == (n * 0.5, n * 30.0)
    assert known["energia_cortada_mwh"] == n * 15.0
    assert by_key["P1", "XXX", "LOC"]["descricao"] == "texto próprio"
    assert by_key["P1", "ENE", None]["descricao"] == "texto próprio"
    above = by_key["P1", "CNF", "SIS"]
    assert above["total_mwh_cortado"] == -20.0 and got[-1] == above
    assert {r["projeto"] for r in analytics.restrictions(*args, project="P2").collect()} == {"P2"}


def test_restriction_totals_with_nulls(spark):
    t = dt.datetime(2024, 1, 1)
    facts = spark.createDataFrame(
        [("G", t, "REL", "LOC", "x", 8.0, None, 3.0), ("G", t, "REL", "LOC", "x", 8.0, 10.0, None),
         ("H", t, "REL", "LOC", "x", 8.0, None, None), ("G", t, None, "LOC", "x", 1.0, 1.0, 1.0)],
        "id_ons_conjunto string, din_instante timestamp_ntz, cod_razaorestricao string, cod_origemrestricao string, "
        "dsc_restricao string, val_geracaoreferencia double, val_geracaoreferenciafinal double, val_geracaolimitada double",
    )
    groups = spark.createDataFrame([("G", "Um"), ("H", "Dois")], "id_ons_conjunto string, nom_conjunto string")
    assets = spark.createDataFrame(
        [("a", "P", "G"), ("b", "P", "G"), ("c", "P", "H")], "spe string, projeto_cv string, id_ons_conjunto string"
    )
    got = analytics.restrictions(facts, groups, assets, star.dim_restricao(spark)).collect()
    assert [(r["nome_conjunto"], r["total_horas_com_restricao"], r["total_mwh_cortado"]) for r in got] == [
        ("Um", 1.0, 5.0), ("Dois", 0.5, None)  # NULL total sorts last
    ]


def test_projects(flow, rows):
    tables, _ = flow
    got = rows(analytics.projects(tables["dim_spe"], tables["dim_conjunto"]), "id_projeto", "subsistema", "qtd_spes")
    assert got == [("P1", "Nordeste", 2), ("P2", "Nordeste", 1)]


def test_group_dimension_takes_known_values(spark):
    df = spark.createDataFrame(
        [("G", "Tipo I", "c", None, "1", None, "BA"), ("G", "Tipo I", "c", "Nome", None, "S", "BA")],
        "id_ons_conjunto string, nom_modalidadeoperacao string, nom_conjuntousina string, nom_usina string, "
        "id_subsistema string, nom_subsistema string, id_estado string",
    )
    assert tuple(star.dim_conjunto(df).first()) == ("G", "Nome", "1", "S", "BA")


def test_asset_with_two_groups_breaks_the_key(spark, flow):
    tables, _ = flow
    moved = tables["silver"].filter("nome_spe_cv = 'AAA01'").limit(1).withColumn("id_ons_conjunto", F.lit("G2"))
    dim = star.dim_spe(tables["silver"].unionByName(moved), tables["registry"])
    with pytest.raises(keys.KeyViolation, match="AAA01"):
        keys.assert_key(dim, ["spe"], "dim_spe")


def test_repeated_group_rows_surface_as_conflicts(spark, raw, flow):
    """A group that reports twice for an instant fans out and ends in quarantine."""
    tables, _ = flow
    t = JAN[20]
    detail = spark.createDataFrame([detail_row(ASSETS[2], t)], DETAIL.format(t="timestamp_ntz", n="double"))
    groups = spark.createDataFrame([group_row(GROUPS[1], t, 1.0), group_row(GROUPS[1], t, 2.0)], GROUP)
    joined = silver.build(detail, groups, tables["registry"])
    treated = silver.treat(joined)
    assert (treated.silver().count(), treated.quarantine().count()) == (0, 2)


def test_first_rows_through_the_whole_run(spark, raw, tmp_path, rows):
    """The places of detail rows are carried to the split and are in no table of the result."""
    tables = {p: medallion.silver_layer(spark, *raw, str(tmp_path / p), policy=p) for p in (duplicates.REFERENCE, duplicates.FIRST)}
    reference, first = tables[duplicates.REFERENCE], tables[duplicates.FIRST]
    assert silver.ADDRESS in first["joined"].columns and silver.ADDRESS not in reference["joined"].columns
    for name in ("silver", "quarantine"):
        assert first[name].columns == reference[name].columns and silver.ADDRESS not in first[name].columns
        key = ["nome_spe_cv", "din_instante", "val_geracaoverificada"]
        assert rows(first[name], *key) == rows(reference[name], *key)
    placed = first["joined"].select(f"{silver.ADDRESS}.*")
    assert placed.filter("file IS NULL OR row IS NULL").count() == 0
