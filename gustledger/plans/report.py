"""Quality report: sections as small frames, assembled into one JSON row.

What grows with the data (anomalies, completeness per project, assets with problems) stays in
tables of its own; the JSON holds the sections whose size is fixed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustledger.functions import columns as C
from gustledger.operators import completeness, distribution
from gustledger.operators.cleaning import present
from gustledger.plans import domain as D
from gustledger.sources.sinks import json_records

# Counters of NULL cells: this and the metric's name.
_NULLS = "nulls_"


def _missing(c: str) -> Column:
    return F.count_if(F.col(c).isNull())


def _equals(c: str, value) -> Column:
    return F.count_if(F.col(c) == value)


def _scalar(df: DataFrame, c: str) -> Column:
    return df.select(c).scalar()


def raw_counters(joined: DataFrame) -> dict[str, Column]:
    """What the report counts in the joined rows."""
    return {
        "rows": F.count("*"),
        "vento_soft_drop": F.count_if((F.col("aud_vento_fora_faixa") == 1) | (F.col("aud_vento_flag") == 1)),
        **{c: _equals(c, 1) for c in ("aud_geracao_negativa", "aud_vento_fora_faixa", "aud_vento_flag")},
        **{f"{_NULLS}{m}": _missing(m) for m in present(joined, D.METRICS)},
    }


def clean_counters(silver: DataFrame) -> dict[str, Column]:
    """What the report counts in Silver."""
    flag = "flg_dadoventoinvalido"
    return {
        "rows": F.count("*"),
        "alertas": _equals("flg_alerta_limitada", 1),
        "vento_nulo": _missing("val_ventoverificado"),
        "geracao_nula": _missing("val_geracao_conjunto"),
        "sem_conjunto": _missing("id_ons_conjunto"),
        "flag_1": _equals(flag, 1),
        "flag_null": _missing(flag),
        **{f"{_NULLS}{m}": _missing(m) for m in present(silver, D.METRICS)},
    }


def rejected_counters() -> dict[str, Column]:
    """What the report counts in the quarantine."""
    return {"rows": F.count("*"), "hard_drops": _equals(D.STAGE, D.CONTRACT_STAGE)}


@dataclass(frozen=True)
class Counts:
    """The counters of the three tables, one row each; taken as the tables are written."""

    raw: DataFrame
    clean: DataFrame
    rejected: DataFrame


def volumetry(counts: Counts, duplicate_counts: DataFrame) -> DataFrame:
    """One row of counters."""
    raw, rejected = counts.raw, counts.rejected
    return counts.clean.select(
        _scalar(raw, "rows").alias("total_registros_brutos"),
        _scalar(duplicate_counts, "identical_removed").alias("duplicatas_identicas_removidas"),
        _scalar(duplicate_counts, "conflicting").alias("duplicatas_conflitantes_para_quarentena"),
        _scalar(rejected, "hard_drops").alias("hard_drops_pandera"),
        _scalar(rejected, "rows").alias("total_em_quarentena"),
        F.col("rows").alias("registros_limpos"),
        F.col("vento_nulo").alias("vento_anulado_soft_drop"),
        _scalar(raw, "vento_soft_drop").alias("vento_anulado_na_origem_bruta"),
        F.col("geracao_nula").alias("geracao_conj_anulada_soft_drop"),
        F.col("alertas").alias("alertas_limitada_flag"),
    )


def integrity(silver: DataFrame, counts: Counts, registry: DataFrame) -> DataFrame:
    return silver.agg(F.count_distinct("nome_spe_cv").alias("spes_com_dados")).select(
        _scalar(registry.agg(F.count("*").alias("n")), "n").alias("spes_esperadas"),
        "spes_com_dados",
        _scalar(counts.clean, "sem_conjunto").alias("registros_sem_conjunto_apos_join"),
    )


def wind_states(counts: Counts) -> DataFrame:
    return counts.clean.select(
        (F.col("rows") - F.col("flag_1") - F.col("flag_null")).alias("valido_flag_0"),
        F.col("flag_1").alias("invalido_flag_1_estimativa_por_historico"),
        F.col("flag_null").alias("sem_dado_flag_null"),
    )


# Rules of the report and what is done about each.
RULE_ACTIONS = {
    "geracao_negativa_bruta": "campo_nullificado",
    "vento_fora_faixa_0_40ms": "campo_nullificado",
    "vento_flag_invalido": "campo_nullificado_flg_historico=1",
    "limitada_maior_referencia": "flg_alerta_limitada=1",
    "geracao_conj_nula_pos_join": "alerta_join_incompleto",
}


def _as_rows(row: DataFrame, names: dict[str, str]) -> DataFrame:
    """(regra, falhas) from the counters of a row; ``names`` are rules and their counters."""
    return row.select(*[F.col(c).alias(rule) for rule, c in names.items()]).unpivot([], list(names), "regra", "falhas")


def business_rules(counts: Counts) -> DataFrame:
    """(regra, falhas, acao): raw violations from the audit columns, the others from Silver."""
    raw = {
        "geracao_negativa_bruta": "aud_geracao_negativa",
        "vento_fora_faixa_0_40ms": "aud_vento_fora_faixa",
        "vento_flag_invalido": "aud_vento_flag",
    }
    treated = {"limitada_maior_referencia": "alertas", "geracao_conj_nula_pos_join": "geracao_nula"}
    actions = F.create_map(*[F.lit(x) for pair in RULE_ACTIONS.items() for x in pair])
    rules = _as_rows(counts.raw, raw).unionByName(_as_rows(counts.clean, treated))
    return rules.withColumn("acao", actions[F.col("regra")])


def null_profile(counts: Counts) -> DataFrame:
    """(coluna, antes_pct, depois_pct) of the metrics that Silver has."""

    def shares(row: DataFrame, name: str) -> DataFrame:
        metrics = [c.removeprefix(_NULLS) for c in row.columns if c.startswith(_NULLS)]
        cells = [C.percent(F.col(f"{_NULLS}{m}"), F.col("rows"), 2).alias(m) for m in metrics]
        return row.select(*cells).unpivot([], metrics, "coluna", name)

    both = shares(counts.clean, "depois_pct").join(shares(counts.raw, "antes_pct"), "coluna", "left")
    return both.select("coluna", F.coalesce("antes_pct", F.lit(0.0)).alias("antes_pct"), "depois_pct")


def metric_distribution(silver: DataFrame) -> DataFrame:
    return distribution.distribution(silver, D.METRICS)


def asset_completeness(silver: DataFrame, registry: DataFrame) -> DataFrame:
    """Per registered asset; an instant is valid if the group's generation is known."""
    return completeness.asset_completeness(
        silver,
        registry.select(F.col("projeto").alias("projeto_cv"), F.col("spe").alias("nome_spe_cv")),
        "nome_spe_cv",
        "projeto_cv",
        "din_instante",
        F.col("val_geracao_conjunto").isNotNull(),
        unique=True,
    )


def _by_name(df: DataFrame, key: str) -> DataFrame:
    """Rows keyed by one of a fixed set of names as a single map."""
    rest = F.struct(*[c for c in df.columns if c != key])
    return df.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(key), rest)))).alias("m"))


def _one_row(df: DataFrame) -> DataFrame:
    return df.select(F.struct("*").alias("s"))


def quality_report(
    silver: DataFrame,
    counts: Counts,
    duplicate_counts: DataFrame,
    registry: DataFrame,
    as_of: Column,
    quarantine_path: str | None = None,
) -> DataFrame:
    """One row, one column ``json``. ``silver`` should be a stored table; the others are small."""
    spark = silver.sparkSession
    period = completeness.data_period(silver, "din_instante").select(
        F.coalesce("inicio", F.lit("N/A")).alias("inicio"), F.coalesce("fim", F.lit("N/A")).alias("fim")
    )
    total = F.col("rows").alias("total")
    rejected = counts.rejected.select(total, F.when(F.col("rows") > 0, F.lit(quarantine_path)).alias("arquivo"))
    one_row = {
        "periodo_dados": period,
        "volumetria": volumetry(counts, duplicate_counts),
        "integridade_referencial": integrity(silver, counts, registry),
        "estados_vento": wind_states(counts),
        "freshness": completeness.freshness(silver, "din_instante", as_of),
        "quarentena": rejected,
    }
    by_name = {
        "regras_negocio": (business_rules(counts), "regra"),
        "nulos_por_coluna": (null_profile(counts), "coluna"),
        "distribuicao_numerica": (metric_distribution(silver), "coluna"),
    }
    report = spark.range(1).select(
        F.date_format(as_of, "dd/MM/yyyy HH:mm:ss").alias("data_processamento"),
        *[_one_row(df).scalar().alias(name) for name, df in one_row.items()],
        *[_by_name(df, key).scalar().alias(name) for name, (df, key) in by_name.items()],
    )
    return json_records(report)
