"""The whole wind flow on raw tables derived from the benchmark tables.

Every event is a reading of its user's asset; eight neighbouring assets form a group, whose
rows are derived from the same half hours. The raw tables hold text in number columns, null
tokens, values out of range, unknown codes, repeated keys, and half hours without group rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gustledger.operators import completeness, duplicates, profile
from gustledger.plans import analytics, medallion, report, silver, star
from gustledger.plans import domain as D
from gustledger.queries.registry import exact, folder, query, rounded, table
from gustledger.session import stage
from gustledger.sources import sinks
from gustledger.sources.snapshots import read_table

PATTERN = r"\d{9}-\d"


def _text(prefix: str, c):
    return F.concat(F.lit(prefix), c.cast("string"))


def _slot():
    return F.window("ts", "30 minutes")["start"]


def registry(spark, d):
    key = F.col("c_custkey")
    code = F.concat(F.regexp_extract("c_name", r"\d{9}", 0), F.lit("-"), (key % 10).cast("string"))
    return table(spark, d, "customer").select(
        _text("P", F.floor(key / 8) % 5).alias("projeto"), _text("SPE", key).alias("spe"), code.alias("ceg")
    )


def detail(spark, d):
    user, kind, value = F.col("user_id"), F.col("event_type"), F.col("value")
    in_group_mode = user % 3 == 0
    group = F.floor(user / 8)
    return table(spark, d, "events").select(
        (user % 4).cast("string").alias("id_subsistema"),
        _text("UF", user % 9).alias("id_estado"),
        F.when((user % 11 == 0) & (kind == "view"), "N/A").otherwise(_text("Estado ", user % 9)).alias("nom_estado"),
        F.when(in_group_mode, "Tipo II-C").otherwise("Tipo I").alias("nom_modalidadeoperacao"),
        _text("conj ", group).alias("nom_conjuntousina"),
        F.when(in_group_mode, _text("usina ", user)).otherwise(_text("Conj ", group)).alias("nom_usina"),
        _text("A", user).alias("id_ons"),
        F.concat(
            F.lit("EOL.XX."), F.lpad(user.cast("string"), 9, "0"), F.lit("-"), (user % 10).cast("string"), F.lit(".01")
        ).alias("ceg"),
        _slot().alias("din_instante"),
        F.when(kind == "signup", "abc").otherwise(value.cast("string")).alias("val_ventoverificado"),
        F.when(kind == "error", "1.0").when(kind != "view", "0.0").alias("flg_dadoventoinvalido"),
        (value - 1).alias("val_geracaoestimada"),
        value.alias("val_geracaoverificada"),
    )


def groups(spark, d):
    group, kind = F.floor(F.col("user_id") / 8), F.col("kind")
    slots = (
        table(spark, d, "events")
        .filter(F.col("event_type") != "signup")
        .groupBy(group.alias("g"), _slot().alias("din_instante"))
        .agg(F.min("event_type").alias("kind"), F.min("value").alias("low"), F.max("value").alias("high"))
    )
    g, low, high = F.col("g"), F.col("low"), F.col("high")
    return slots.select(
        (g % 4).cast("string").alias("id_subsistema"),
        _text("Sub ", g % 4).alias("nom_subsistema"),
        _text("UF", g % 9).alias("id_estado"),
        _text("CONJ ", g).alias("nom_usina"),
        _text("G", g).alias("id_ons"),
        F.lit("-").alias("ceg"),
        "din_instante",
        (high - 5).alias("val_geracao"),
        F.when(kind == "click", "REL").when(kind == "error", "CNF").when(kind == "purchase", "XXX").alias(
            "cod_razaorestricao"
        ),
        F.when(high > 50, "LOC").when(high > 10, "SIS").alias("cod_origemrestricao"),
        _text("texto ", kind).alias("dsc_restricao"),
        low.alias("val_geracaolimitada"),
        high.alias("val_disponibilidade"),
        (high * 0.5).alias("val_geracaoreferencia"),
        F.when(kind != "error", high * 2).alias("val_geracaoreferenciafinal"),
    )


def _joined(spark, d):
    return stage(silver.build(detail(spark, d), groups(spark, d), registry(spark, d), PATTERN), "joined")


def _treated(spark, d, policy=duplicates.DOCUMENTED):
    joined = _joined(spark, d)
    return joined, silver.treat(joined, policy)


def _counted(spark, d):
    """Silver, the counters of all three tables as they were written, and the split."""
    rows = silver.build(detail(spark, d), groups(spark, d), registry(spark, d), PATTERN)
    joined, raw = profile.stage_counted(rows, "joined", report.raw_counters(rows))
    treated = silver.treat(joined)
    kept = treated.silver()
    clean, good = profile.stage_counted(kept, "silver", report.clean_counters(kept))
    _, rejected = profile.stage_counted(treated.quarantine(), "quarantine", report.rejected_counters())
    return clean, report.Counts(raw, good, rejected), treated


def _silver(spark, d):
    return stage(_treated(spark, d)[1].silver(), "silver")


# --- SQL of the same flow -------------------------------------------------------------------

_BRONZE = r"""
    WITH seed AS (
        SELECT 'P' || ((c_custkey // 8) % 5) AS projeto, 'SPE' || c_custkey AS spe,
               regexp_extract(c_name, '\d{9}') || '-' || (c_custkey % 10) AS ceg FROM customer),
    detail AS (
        SELECT CAST(user_id % 4 AS VARCHAR) AS id_subsistema, 'UF' || (user_id % 9) AS id_estado,
               CASE WHEN user_id % 11 = 0 AND event_type = 'view' THEN 'N/A'
                    ELSE 'Estado ' || (user_id % 9) END AS nom_estado,
               CASE WHEN user_id % 3 = 0 THEN 'Tipo II-C' ELSE 'Tipo I' END AS nom_modalidadeoperacao,
               'conj ' || (user_id // 8) AS nom_conjuntousina,
               CASE WHEN user_id % 3 = 0 THEN 'usina ' || user_id ELSE 'Conj ' || (user_id // 8) END AS nom_usina,
               'A' || user_id AS id_ons,
               'EOL.XX.' || lpad(CAST(user_id AS VARCHAR), 9, '0') || '-' || (user_id % 10) || '.01' AS ceg,
               time_bucket(INTERVAL 30 MINUTE, ts) AS din_instante,
               CASE WHEN event_type = 'signup' THEN 'abc' ELSE CAST(value AS VARCHAR) END AS val_ventoverificado,
               CASE event_type WHEN 'error' THEN '1.0' WHEN 'view' THEN NULL ELSE '0.0' END AS flg_dadoventoinvalido,
               value - 1 AS val_geracaoestimada, value AS val_geracaoverificada
        FROM events),
    slots AS (
        SELECT user_id // 8 AS g, time_bucket(INTERVAL 30 MINUTE, ts) AS din_instante,
               MIN(event_type) AS kind, MIN(value) AS low, MAX(value) AS high
        FROM events WHERE event_type <> 'signup' GROUP BY 1, 2),
    conj AS (
        SELECT 'Sub ' || (g % 4) AS nom_subsistema, 'CONJ ' || g AS nom_usina, 'G' || g AS id_ons, din_instante,
               high - 5 AS val_geracao,
               CASE kind WHEN 'click' THEN 'REL' WHEN 'error' THEN 'CNF' WHEN 'purchase' THEN 'XXX' END
                   AS cod_razaorestricao,
               CASE WHEN high > 50 THEN 'LOC' WHEN high > 10 THEN 'SIS' END AS cod_origemrestricao,
               'texto ' || kind AS dsc_restricao, low AS val_geracaolimitada, high AS val_disponibilidade,
               high * 0.5 AS val_geracaoreferencia,
               CASE WHEN kind <> 'error' THEN high * 2 END AS val_geracaoreferenciafinal
        FROM slots),"""

_JOINED = _BRONZE + r"""
    typed AS (
        SELECT d.*, s.projeto AS projeto_cv, s.spe AS nome_spe_cv,
               TRY_CAST(val_ventoverificado AS DOUBLE) AS wind, TRY_CAST(flg_dadoventoinvalido AS DOUBLE) AS bad,
               CASE WHEN nom_modalidadeoperacao = 'Tipo II-C' THEN nom_conjuntousina ELSE nom_usina END AS grp
        FROM detail d JOIN seed s ON regexp_extract(d.ceg, '\d{9}-\d') = s.ceg),
    joined AS (
        SELECT t.id_subsistema, t.id_estado,
               CASE WHEN t.nom_estado IN ('N/A', 'n/a', '-') THEN NULL ELSE t.nom_estado END AS nom_estado,
               t.nom_modalidadeoperacao, t.nom_conjuntousina, t.nom_usina, t.id_ons AS id_ons_spe, t.ceg,
               t.din_instante, t.bad AS flg_dadoventoinvalido, t.val_geracaoestimada, t.val_geracaoverificada,
               t.projeto_cv, t.nome_spe_cv,
               CASE WHEN wind < 0 OR wind > 40 THEN NULL WHEN bad = 1 THEN NULL ELSE wind END AS val_ventoverificado,
               c.id_ons AS id_ons_conjunto, c.nom_subsistema,
               CASE WHEN c.val_geracao < 0 THEN NULL ELSE c.val_geracao END AS val_geracao_conjunto,
               c.cod_razaorestricao, c.cod_origemrestricao, c.dsc_restricao,
               c.val_geracaolimitada AS val_geracaolimitada_conjunto,
               c.val_disponibilidade AS val_disponibilidade_conjunto,
               c.val_geracaoreferencia AS val_geracaoreferencia_conjunto,
               c.val_geracaoreferenciafinal AS val_geracaoreferenciafinal_conjunto,
               CASE WHEN c.val_geracaolimitada > COALESCE(c.val_geracaoreferenciafinal, c.val_geracaoreferencia)
                    THEN 1 ELSE 0 END AS flg_alerta_limitada,
               CASE WHEN bad = 1 THEN 1 ELSE 0 END AS flg_estimada_por_historico,
               CASE WHEN wind < 0 OR wind > 40 THEN 1 ELSE 0 END AS aud_vento_fora_faixa,
               CASE WHEN bad = 1 THEN 1 ELSE 0 END AS aud_vento_flag,
               CASE WHEN c.val_geracao < 0 THEN 1 ELSE 0 END AS aud_geracao_negativa
        FROM typed t LEFT JOIN conj c ON UPPER(t.grp) = UPPER(c.nom_usina) AND t.din_instante = c.din_instante),"""

# Rows of one asset and half hour differ unless all the event's values agree.
_SPLIT = _JOINED + """
    counted AS (
        SELECT *, COUNT(*) OVER (PARTITION BY nome_spe_cv, din_instante) AS kn,
               COUNT(*) OVER (PARTITION BY nome_spe_cv, din_instante, nom_estado, flg_dadoventoinvalido,
                              val_geracaoestimada, val_geracaoverificada, val_ventoverificado) AS fn
        FROM joined),
    unique_rows AS (SELECT DISTINCT * EXCLUDE (kn, fn, aud_vento_fora_faixa, aud_vento_flag, aud_geracao_negativa)
                    FROM counted WHERE kn = fn),
    checked AS (
        SELECT *, list_filter([
            CASE WHEN nom_subsistema IS NULL THEN 'nom_subsistema:not_nullable' END,
            CASE WHEN nom_estado IS NULL THEN 'nom_estado:not_nullable' END,
            CASE WHEN id_ons_conjunto IS NULL THEN 'id_ons_conjunto:not_nullable' END,
            CASE WHEN val_geracao_conjunto IS NULL THEN 'val_geracao_conjunto:not_nullable' END,
            CASE WHEN val_geracaoestimada < 0 THEN 'val_geracaoestimada:greater_than_or_equal_to(0)' END
            ], lambda x: x IS NOT NULL) AS reasons
        FROM unique_rows),
    silver AS (SELECT * EXCLUDE (reasons) FROM checked WHERE len(reasons) = 0),
    quarantine AS (
        SELECT * EXCLUDE (kn, fn, aud_vento_fora_faixa, aud_vento_flag, aud_geracao_negativa),
               'Duplicata conflitante: mesma chave (spe, din_instante) com valores divergentes' AS motivo_rejeicao,
               'deduplicacao' AS etapa_rejeicao
        FROM counted WHERE kn <> fn
        UNION ALL BY NAME
        SELECT * EXCLUDE (reasons), array_to_string(reasons, '; ') AS motivo_rejeicao,
               'pandera_schema' AS etapa_rejeicao
        FROM checked WHERE len(reasons) > 0),"""

_GOLD = _SPLIT + """
    dim_conjunto AS (
        SELECT id_ons_conjunto,
               MIN(CASE WHEN nom_modalidadeoperacao = 'Tipo II-C' THEN nom_conjuntousina ELSE nom_usina END)
                   AS nom_conjunto,
               MIN(id_subsistema) AS id_subsistema, MIN(nom_subsistema) AS nom_subsistema,
               MIN(id_estado) AS id_estado
        FROM silver WHERE id_ons_conjunto IS NOT NULL GROUP BY id_ons_conjunto),
    dim_spe AS (
        SELECT s.spe, s.projeto AS projeto_cv, s.ceg, d.nom_usina, d.nom_modalidadeoperacao, d.id_ons_spe,
               d.id_ons_conjunto
        FROM seed s LEFT JOIN (SELECT DISTINCT nome_spe_cv, nom_usina, nom_modalidadeoperacao, id_ons_spe,
                                      id_ons_conjunto FROM silver) d ON UPPER(s.spe) = UPPER(d.nome_spe_cv)),
    dim_restricao(reason, origin, txt) AS (VALUES {codes}),
    fato_textos AS (
        SELECT id_ons_conjunto, din_instante, MAX(val_geracao_conjunto) AS val_geracao,
               MAX(val_geracaolimitada_conjunto) AS val_geracaolimitada,
               MAX(val_disponibilidade_conjunto) AS val_disponibilidade,
               MAX(val_geracaoreferencia_conjunto) AS val_geracaoreferencia,
               MAX(val_geracaoreferenciafinal_conjunto) AS val_geracaoreferenciafinal,
               MIN(struct_pack(a := cod_razaorestricao IS NULL, b := cod_razaorestricao, c := cod_origemrestricao IS NULL,
                               d := cod_origemrestricao, e := dsc_restricao IS NULL, f := dsc_restricao)) AS texts,
               MAX(flg_alerta_limitada) AS flg_alerta_limitada
        FROM silver WHERE id_ons_conjunto IS NOT NULL GROUP BY 1, 2),
    fato_conjunto AS (
        SELECT * EXCLUDE (texts), texts.b AS cod_razaorestricao, texts.d AS cod_origemrestricao, texts.f AS dsc_restricao
        FROM fato_textos)
    """.replace("{codes}", ", ".join(map(str, D.RESTRICTIONS)))


def _pick(ctes: str, last: str) -> str:
    """The shared CTEs followed by the final SELECT or by further CTEs."""
    ctes = ctes.rstrip().rstrip(",")
    return f"{ctes}\n    {last}" if last.lstrip().startswith("SELECT") else f"{ctes},\n    {last}"


@query(
    "null_join_keys",
    _pick(
        _BRONZE,
        """
    SELECT 'nom_usina' AS coluna, COUNT(*) FILTER (nom_usina IS NULL) AS nulos FROM conj
    UNION ALL SELECT 'cod_razaorestricao', COUNT(*) FILTER (cod_razaorestricao IS NULL) FROM conj
    UNION ALL SELECT 'cod_origemrestricao', COUNT(*) FILTER (cod_origemrestricao IS NULL) FROM conj""",
    ),
)
def null_join_keys(spark, d):
    return profile.null_counts(groups(spark, d), ["nom_usina", "cod_razaorestricao", "cod_origemrestricao"])


# --- Silver ---------------------------------------------------------------------------------

@query("silver_joined", _pick(_JOINED, "SELECT * FROM joined"))
def silver_joined(spark, d):
    return _joined(spark, d)


@query("silver_clean", _pick(_SPLIT, "SELECT * FROM silver"))
def silver_clean(spark, d):
    return _treated(spark, d)[1].silver()


@query("silver_quarantine", _pick(_SPLIT, "SELECT * FROM quarantine"))
def silver_quarantine(spark, d):
    return _treated(spark, d)[1].quarantine()


@query(
    "anomaly_list",
    _pick(
        _SPLIT,
        """
    SELECT nome_spe_cv AS nome, id_estado AS estado, nom_subsistema AS subsistema,
           strftime(din_instante, '%d/%m/%Y %H:%M') AS din_instante,
           CASE WHEN len(reasons) > 0 THEN 'QUARENTENA: ' || array_to_string(list_transform(reasons,
                    lambda r: 'Coluna [' || split_part(r, ':', 1) || '] violou [' || split_part(r, ':', 2) || ']'), ' | ')
                ELSE 'SOFT DROP/FLAG: ' || concat_ws(' ; ',
                    CASE WHEN val_ventoverificado IS NULL
                         THEN 'Vento anulado (inválido, fora de 0–40 m/s ou flag de telemetria ativa)' END,
                    CASE WHEN flg_alerta_limitada = 1
                         THEN 'Geração limitada excede a geração de referência' END) END AS justificativa
    FROM checked WHERE len(reasons) > 0 OR val_ventoverificado IS NULL OR flg_alerta_limitada = 1""",
    ),
)
def anomaly_list(spark, d):
    return _treated(spark, d)[1].anomalies()


# --- report ---------------------------------------------------------------------------------

_VOLUMETRY = """
    SELECT (SELECT COUNT(*) FROM joined) AS total_registros_brutos,
           (SELECT COUNT(*) FROM counted WHERE kn = fn) - (SELECT COUNT(*) FROM unique_rows)
               AS duplicatas_identicas_removidas,
           (SELECT COUNT(*) FROM counted WHERE kn <> fn) AS duplicatas_conflitantes_para_quarentena,
           (SELECT COUNT(*) FROM checked WHERE len(reasons) > 0) AS hard_drops_pandera,
           (SELECT COUNT(*) FROM quarantine) AS total_em_quarentena,
           COUNT(*) AS registros_limpos,
           COUNT(*) FILTER (val_ventoverificado IS NULL) AS vento_anulado_soft_drop,
           (SELECT COUNT(*) FROM joined WHERE aud_vento_fora_faixa = 1 OR aud_vento_flag = 1)
               AS vento_anulado_na_origem_bruta,
           COUNT(*) FILTER (val_geracao_conjunto IS NULL) AS geracao_conj_anulada_soft_drop,
           COUNT(*) FILTER (flg_alerta_limitada = 1) AS alertas_limitada_flag
    FROM silver"""


@query("volumetry", _pick(_SPLIT, _VOLUMETRY))
def volumetry(spark, d):
    _, counts, treated = _counted(spark, d)
    return report.volumetry(counts, treated.duplicate_counts())


_INTEGRITY = """
    SELECT (SELECT COUNT(*) FROM seed) AS spes_esperadas, COUNT(DISTINCT nome_spe_cv) AS spes_com_dados,
           COUNT(*) FILTER (id_ons_conjunto IS NULL) AS registros_sem_conjunto_apos_join FROM silver"""


@query("integrity", _pick(_SPLIT, _INTEGRITY))
def integrity(spark, d):
    clean, counts, _ = _counted(spark, d)
    return report.integrity(clean, counts, registry(spark, d))


_STATES = """
    SELECT COUNT(*) FILTER (flg_dadoventoinvalido = 0) AS valido_flag_0,
           COUNT(*) FILTER (flg_dadoventoinvalido = 1) AS invalido_flag_1_estimativa_por_historico,
           COUNT(*) FILTER (flg_dadoventoinvalido IS NULL) AS sem_dado_flag_null FROM silver"""


@query("wind_states", _pick(_SPLIT, _STATES))
def wind_states(spark, d):
    return report.wind_states(_counted(spark, d)[1])


_RULES = """
    SELECT 'geracao_negativa_bruta' AS regra, COUNT(*) FILTER (aud_geracao_negativa = 1) AS falhas,
           'campo_nullificado' AS acao FROM joined
    UNION ALL SELECT 'vento_fora_faixa_0_40ms', COUNT(*) FILTER (aud_vento_fora_faixa = 1),
           'campo_nullificado' FROM joined
    UNION ALL SELECT 'vento_flag_invalido', COUNT(*) FILTER (aud_vento_flag = 1),
           'campo_nullificado_flg_historico=1' FROM joined
    UNION ALL SELECT 'limitada_maior_referencia', COUNT(*) FILTER (flg_alerta_limitada = 1),
           'flg_alerta_limitada=1' FROM silver
    UNION ALL SELECT 'geracao_conj_nula_pos_join', COUNT(*) FILTER (val_geracao_conjunto IS NULL),
           'alerta_join_incompleto' FROM silver"""


@query("business_rules", _pick(_SPLIT, _RULES))
def business_rules(spark, d):
    return report.business_rules(_counted(spark, d)[1])


_PERIOD = """
    SELECT COALESCE(strftime(MIN(din_instante), '%Y-%m-%d'), 'N/A') AS inicio,
           COALESCE(strftime(MAX(din_instante), '%Y-%m-%d'), 'N/A') AS fim FROM silver"""

_FRESHNESS = """
    SELECT CASE WHEN last = want THEN 'OK' WHEN last > want THEN 'ALERTA' ELSE 'FALHA' END AS status,
           COALESCE(last = want, FALSE) AS ok, strftime(want, '%m/%Y') AS ultimo_mes_esperado,
           CASE WHEN last = want THEN 'Último registro: ' || strftime(ts, '%d/%m/%Y %H:%M')
                WHEN last > want THEN 'Base contém dados do mês atual (' || strftime(ts, '%m/%Y') || ')'
                ELSE 'Dados desatualizados. Último: ' || strftime(ts, '%d/%m/%Y %H:%M') END AS mensagem
    FROM (SELECT MAX(din_instante) AS ts, DATE_TRUNC('month', MAX(din_instante)) AS last,
                 DATE '2024-01-01' AS want FROM silver)"""

_REJECTED = "SELECT COUNT(*) AS total, CASE WHEN COUNT(*) > 0 THEN 'quarantine' END AS arquivo FROM quarantine"


def _nulls_sql(c: str) -> str:
    part = lambda t: rounded(f"(SELECT 100.0::DOUBLE * COUNT(*) FILTER ({c} IS NULL) / GREATEST(COUNT(*), 1) FROM {t})", 2)
    return f"SELECT '{c}' AS coluna, {part('joined')} AS antes_pct, {part('silver')} AS depois_pct"


def _distribution_sql(c: str) -> str:
    quantiles = ", ".join(f"{rounded(f'quantile_cont({c}, {q})', 4)} AS p{round(100 * q)}" for q in (0.25, 0.5, 0.75))
    return f"""
    SELECT '{c}' AS coluna, {rounded(f"MIN({c})", 4)} AS min, {quantiles}, {rounded(f"MAX({c})", 4)} AS max,
           {rounded(f"CAST(SUM({exact(c)}) AS DOUBLE) / COUNT({c})", 4)} AS media
    FROM silver HAVING COUNT({c}) > 0"""


# The nine sections of the report: one row each, or a row for each name.
_SECTIONS = {
    "periodo_dados": _PERIOD, "volumetria": _VOLUMETRY, "integridade_referencial": _INTEGRITY, "estados_vento": _STATES,
    "freshness": _FRESHNESS, "quarentena": _REJECTED,
}
_NAMED = {
    "regras_negocio": ("regra", _RULES),
    "nulos_por_coluna": ("coluna", " UNION ALL ".join(map(_nulls_sql, D.METRICS))),
    "distribuicao_numerica": ("coluna", " UNION ALL ".join(map(_distribution_sql, D.METRICS))),
}


def _report_sql() -> str:
    one = [
        f"SELECT '{name}' AS section, key, value FROM (SELECT COLUMNS(*)::VARCHAR FROM ({sql})) UNPIVOT INCLUDE NULLS (value FOR key IN (COLUMNS(*)))"
        for name, sql in _SECTIONS.items()
    ]
    named = [
        f"""SELECT '{name}', {label} || '.' || key, value
            FROM (SELECT COLUMNS(*)::VARCHAR FROM ({sql})) UNPIVOT INCLUDE NULLS (value FOR key IN (COLUMNS(* EXCLUDE ({label}))))"""
        for name, (label, sql) in _NAMED.items()
    ]
    return _pick(_SPLIT, " UNION ALL ".join(one + named))


def _sections(text):
    """The JSON document as (section, key, value); a key of a named entry is name.field."""
    def parsed(section, kind):
        return F.from_json(F.get_json_object("json", f"$.{section}"), kind)

    flat = [F.struct(F.lit(s).alias("section"), parsed(s, "map<string,string>").alias("m")) for s in _SECTIONS]
    whole = text.select(F.explode(F.array(*flat)).alias("s")).select("s.section", F.explode("s.m").alias("key", "value"))
    deep = [F.struct(F.lit(s).alias("section"), parsed(s, "map<string,map<string,string>>").alias("m")) for s in _NAMED]
    names = text.select(F.explode(F.array(*deep)).alias("s")).select("s.section", F.explode("s.m").alias("name", "fields"))
    fields = names.select("section", "name", F.explode("fields").alias("key", "value"))
    return whole.unionByName(fields.select("section", F.concat_ws(".", "name", "key").alias("key"), "value"))


def _report(spark, d):
    clean, counts, treated = _counted(spark, d)
    as_of = F.lit("2024-02-15 00:00:00").cast("timestamp_ntz")
    return report.quality_report(clean, counts, treated.duplicate_counts(), registry(spark, d), as_of, "quarantine")


@query("quality_report", _report_sql())
def quality_report(spark, d):
    """All nine sections of the JSON report as (section, key, value)."""
    return _sections(stage(_report(spark, d), "report"))


@query("report_file", _report_sql())
def report_file(spark, d):
    """The report written as a JSON file and read back."""
    path = folder(spark, "report")
    _report(spark, d).write.mode("overwrite").text(path)
    return _sections(spark.read.text(path).withColumnRenamed("value", "json"))


@query("quarantine_sink", _pick(_SPLIT, "SELECT * FROM quarantine"))
def quarantine_sink(spark, d):
    """The quarantine table as published and read back, after a first version without rows."""
    path, rejected = folder(spark, "quarantine"), _treated(spark, d)[1].quarantine()
    sinks.write_table(rejected.limit(0), path)
    sinks.write_table(rejected, path)
    return read_table(spark, path)


# --- Gold -----------------------------------------------------------------------------------

@query("dim_group", _pick(_GOLD, "SELECT * FROM dim_conjunto"))
def dim_group(spark, d):
    return star.dim_conjunto(_silver(spark, d))


@query("dim_asset", _pick(_GOLD, "SELECT * FROM dim_spe"))
def dim_asset(spark, d):
    return star.dim_spe(_silver(spark, d), registry(spark, d))


@query(
    "dim_code",
    _pick(
        _GOLD,
        """
    SELECT reason AS cod_razaorestricao, origin AS cod_origemrestricao, txt AS dsc_restricao_completa,
           COUNT(id_ons_conjunto) AS intervalos
    FROM dim_restricao LEFT JOIN fato_conjunto ON reason = cod_razaorestricao AND origin = cod_origemrestricao
    GROUP BY 1, 2, 3""",
    ),
)
def dim_code(spark, d):
    """The fixed codes with the number of group intervals that use each."""
    codes = ["cod_razaorestricao", "cod_origemrestricao"]
    used = star.fato_geracao_conjunto(_silver(spark, d)).groupBy(*codes).agg(F.count("*").alias("intervalos"))
    return star.dim_restricao(spark).join(used, codes, "left").withColumn(
        "intervalos", F.coalesce("intervalos", F.lit(0))
    )


@query(
    "dim_time",
    _pick(
        _SPLIT,
        """
    SELECT DISTINCT din_instante, EXTRACT(year FROM din_instante) AS ano, EXTRACT(month FROM din_instante) AS mes,
           EXTRACT(day FROM din_instante) AS dia, EXTRACT(hour FROM din_instante) AS hora,
           EXTRACT(minute FROM din_instante) AS minuto,
           CASE WHEN EXTRACT(dow FROM din_instante) IN (0, 6) THEN 1 ELSE 0 END AS flg_fim_semana
    FROM silver WHERE din_instante IS NOT NULL""",
    ),
)
def dim_time(spark, d):
    return star.dim_tempo(_silver(spark, d))


@query(
    "fact_asset",
    _pick(
        _SPLIT,
        """
    SELECT nome_spe_cv AS spe, din_instante, val_ventoverificado, flg_dadoventoinvalido, val_geracaoestimada,
           val_geracaoverificada, flg_estimada_por_historico FROM silver""",
    ),
)
def fact_asset(spark, d):
    return star.fato_geracao_spe(_treated(spark, d)[1].silver())


@query("fact_group", _pick(_GOLD, "SELECT * FROM fato_conjunto"))
def fact_group(spark, d):
    return star.fato_geracao_conjunto(_treated(spark, d)[1].silver())


_EXPORT = {
    "dim_conjunto": ("id_ons_conjunto", "nom_conjunto", "NULL"),
    "dim_spe": ("spe", "id_ons_conjunto", "NULL"),
    "dim_restricao": ("cod_razaorestricao", "cod_origemrestricao", "NULL"),
    "dim_tempo": ("strftime(din_instante, '%Y-%m-%d %H:%M')", "CAST(ano AS VARCHAR)", "minuto"),
    "fato_geracao_spe": ("spe", "strftime(din_instante, '%Y-%m-%d %H:%M')", "val_geracaoverificada"),
    "fato_geracao_conjunto": ("id_ons_conjunto", "strftime(din_instante, '%Y-%m-%d %H:%M')", "val_geracao"),
}
_EXPORTED = {
    "dim_restricao": "(SELECT reason AS cod_razaorestricao, origin AS cod_origemrestricao FROM dim_restricao)",
    "dim_tempo": """(SELECT DISTINCT din_instante, EXTRACT(year FROM din_instante) AS ano, EXTRACT(minute FROM din_instante) AS minuto
                     FROM silver WHERE din_instante IS NOT NULL)""",
    "fato_geracao_spe": "(SELECT nome_spe_cv AS spe, din_instante, val_geracaoverificada FROM silver)",
    "fato_geracao_conjunto": "fato_conjunto",
}


@query(
    "gold_export",
    _pick(
        _GOLD,
        " UNION ALL ".join(
            f"SELECT '{t}' AS tabela, {a} AS chave, {b} AS atributo, CAST({v} AS DOUBLE) AS valor FROM {_EXPORTED.get(t, t)}"
            for t, (a, b, v) in _EXPORT.items()
        ),
    ),
)
def gold_export(spark, d):
    """All rows of the six published Gold tables: their keys and one value each, read from the manifest."""
    out, clean = folder(spark, "gold"), _silver(spark, d)
    medallion.gold_layer(clean, registry(spark, d), out)
    tables = medallion.current(spark, out)

    def text(sql):
        return sql.replace("strftime", "date_format").replace("%Y-%m-%d %H:%M", "yyyy-MM-dd HH:mm").replace("VARCHAR", "STRING")

    return profile.union_all(
        [
            tables[t].select(F.lit(t).alias("tabela"), F.expr(text(a)).alias("chave"), F.expr(text(b)).alias("atributo"), F.expr(v).cast("double").alias("valor"))
            for t, (a, b, v) in _EXPORT.items()
        ]
    )


@query(
    "wind_projects",
    _pick(
        _GOLD,
        """
    SELECT projeto_cv AS id_projeto, nom_conjunto AS nome_conjunto, nom_subsistema AS subsistema,
           c.id_estado AS estado, COUNT(spe) AS qtd_spes
    FROM dim_spe d JOIN dim_conjunto c ON d.id_ons_conjunto = c.id_ons_conjunto GROUP BY 1, 2, 3, 4 ORDER BY 1""",
    ),
)
def wind_projects(spark, d):
    clean = _silver(spark, d)
    return analytics.projects(star.dim_spe(clean, registry(spark, d)), star.dim_conjunto(clean))


@query(
    "wind_generation",
    _pick(
        _GOLD,
        f"""
    SELECT CAST(din_instante AS DATE) AS periodo,
           {rounded(f"SUM({exact('val_geracaoverificada')} * 0.5)", 2)} AS total_mwh_verificado,
           {rounded(f"SUM({exact('val_geracaoestimada')} * 0.5)", 2)} AS total_mwh_estimado,
           {rounded(f"CAST(SUM({exact('val_ventoverificado')}) AS DOUBLE) / NULLIF(COUNT(val_ventoverificado), 0)", 2)}
               AS vento_medio_ms,
           COUNT(DISTINCT d.spe) AS qtd_spes_ativas
    FROM silver f JOIN dim_spe d ON f.nome_spe_cv = d.spe WHERE d.projeto_cv = 'P1' GROUP BY 1 ORDER BY 1""",
    ),
)
def wind_generation(spark, d):
    clean = _silver(spark, d)
    return analytics.generation(star.fato_geracao_spe(clean), star.dim_spe(clean, registry(spark, d)), "P1")


@query(
    "wind_restrictions",
    _pick(
        _GOLD,
        f"""
    SELECT ds.projeto_cv AS projeto, dc.nom_conjunto AS nome_conjunto, fc.cod_razaorestricao AS razao_restricao,
           fc.cod_origemrestricao AS origem, COALESCE(MIN(txt), MIN(fc.dsc_restricao)) AS descricao,
           {rounded("COUNT(*) * 0.5", 1)} AS total_horas_com_restricao,
           {rounded(f"SUM({exact('COALESCE(val_geracaoreferenciafinal, val_geracaoreferencia)')} - {exact('val_geracaolimitada')})", 2)}
               AS total_mwh_cortado,
           {rounded(f"SUM({exact('COALESCE(val_geracaoreferenciafinal, val_geracaoreferencia)')} - {exact('val_geracaolimitada')}) * 0.5", 2)}
               AS energia_cortada_mwh
    FROM fato_conjunto fc JOIN dim_conjunto dc ON fc.id_ons_conjunto = dc.id_ons_conjunto
    JOIN (SELECT DISTINCT id_ons_conjunto, projeto_cv FROM dim_spe) ds ON ds.id_ons_conjunto = fc.id_ons_conjunto
    LEFT JOIN dim_restricao ON fc.cod_razaorestricao = reason AND fc.cod_origemrestricao = origin
    WHERE fc.cod_razaorestricao IS NOT NULL GROUP BY 1, 2, 3, 4 ORDER BY total_mwh_cortado DESC NULLS LAST""",
    ),
)
def wind_restrictions(spark, d):
    clean = _silver(spark, d)
    return analytics.restrictions(
        star.fato_geracao_conjunto(clean),
        star.dim_conjunto(clean),
        star.dim_spe(clean, registry(spark, d)),
        star.dim_restricao(spark),
    )


@query(
    "wind_completeness",
    _pick(
        _SPLIT,
        f"""
    p AS (SELECT CAST((date_diff('day', DATE_TRUNC('month', MIN(din_instante)), LAST_DAY(MAX(din_instante))) + 1) * 48
                      AS BIGINT) AS slots FROM silver),
    steps AS (SELECT nome_spe_cv, din_instante, val_geracao_conjunto, din_instante
                     - LAG(din_instante) OVER (PARTITION BY nome_spe_cv ORDER BY din_instante) AS step FROM silver),
    a AS (SELECT nome_spe_cv AS spe, COUNT(DISTINCT din_instante) AS received,
                 COUNT(val_geracao_conjunto) AS valid, COUNT(*) FILTER (step > INTERVAL 45 MINUTE) AS gaps
          FROM steps GROUP BY 1)
    SELECT seed.spe AS nome_spe_cv, projeto AS projeto_cv, COALESCE(received, 0) AS received,
           COALESCE(valid, 0) AS valid, COALESCE(gaps, 0) AS gaps, received IS NOT NULL AS has_data,
           (SELECT slots FROM p) AS expected,
           {rounded("100.0::DOUBLE * COALESCE(received, 0) / (SELECT slots FROM p)", 1)} AS pct
    FROM seed LEFT JOIN a ON seed.spe = a.spe""",
    ),
)
def wind_completeness(spark, d):
    return report.asset_completeness(_silver(spark, d), registry(spark, d))


@query(
    "completeness_records",
    _pick(
        _SPLIT,
        """
    a AS (SELECT DISTINCT nome_spe_cv FROM silver)
    SELECT '{"projeto_cv":"' || projeto || '","nome_spe_cv":"' || spe || '"}' AS json
    FROM seed WHERE spe NOT IN (SELECT nome_spe_cv FROM a)""",
    ),
)
def completeness_records(spark, d):
    """Registered assets without data as JSON records."""
    assets = report.asset_completeness(_silver(spark, d), registry(spark, d))
    return sinks.json_records(completeness.assets_without_data(assets, "projeto_cv", "nome_spe_cv"))
