"""Gold: four dimensions and two facts, one per grain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustledger.functions import columns as C
from gustledger.plans import domain as D
from gustledger.plans.silver import group_name
from gustledger.sources.files import constants


def dim_conjunto(silver: DataFrame) -> DataFrame:
    """One row per group; the lowest known value of each attribute, so a rerun gives the same.

    The distinct hash-aggregates the large side. The repartition keeps the optimizer from
    merging it into the aggregate on text below, which sorts its input.
    """
    known = silver.filter(F.col("id_ons_conjunto").isNotNull())
    attributes = known.select(
        "id_ons_conjunto", group_name().alias("nom_conjunto"), "id_subsistema", "nom_subsistema", "id_estado"
    ).distinct().repartition("id_ons_conjunto")
    return attributes.groupBy("id_ons_conjunto").agg(
        *[F.min(c).alias(c) for c in attributes.columns if c != "id_ons_conjunto"]
    )


def dim_spe(silver: DataFrame, registry: DataFrame) -> DataFrame:
    """One row per registered asset, also those without data; current attributes only."""
    attributes = silver.select(
        F.upper("nome_spe_cv").alias("_asset"),
        "nom_usina",
        "nom_modalidadeoperacao",
        "id_ons_spe",
        "id_ons_conjunto",
    ).distinct()
    return registry.join(attributes, F.upper(registry["spe"]) == attributes["_asset"], "left").select(
        "spe",
        F.col("projeto").alias("projeto_cv"),
        "ceg",
        "nom_usina",
        "nom_modalidadeoperacao",
        "id_ons_spe",
        "id_ons_conjunto",
    )


def dim_restricao(spark) -> DataFrame:
    """All code pairs, also those that do not occur."""
    return constants(spark, D.RESTRICTIONS, D.RESTRICTIONS_SCHEMA)


def dim_tempo(silver: DataFrame) -> DataFrame:
    """One row per instant with its calendar attributes, computed after the distinct."""
    instants = silver.select("din_instante").filter(F.col("din_instante").isNotNull()).distinct()
    return instants.withColumns(C.calendar(F.col("din_instante")))


def fato_geracao_spe(silver: DataFrame) -> DataFrame:
    """Metrics of the asset only; group metrics would be counted once per asset here."""
    return silver.select(
        F.col("nome_spe_cv").alias("spe"),
        "din_instante",
        "val_ventoverificado",
        "flg_dadoventoinvalido",
        "val_geracaoestimada",
        "val_geracaoverificada",
        "flg_estimada_por_historico",
    )


def fato_geracao_conjunto(silver: DataFrame) -> DataFrame:
    """Asset rows reduced to one row per group and instant.

    An instant is missing if all its asset rows were rejected. The assets of a group repeat
    the same group texts, so the numbers are first reduced per grain and texts by hash
    aggregation, combined on the map side; the aggregate on text sorts what is left. Reason,
    origin and description come from one row, the lowest, so they belong together; a row with
    a reason goes before one without.
    """
    grain = ["id_ons_conjunto", "din_instante"]
    text = ["cod_razaorestricao", "cod_origemrestricao", "dsc_restricao"]
    names = {
        "val_geracao_conjunto": "val_geracao",
        "val_geracaolimitada_conjunto": "val_geracaolimitada",
        "val_disponibilidade_conjunto": "val_disponibilidade",
        "val_geracaoreferencia_conjunto": "val_geracaoreferencia",
        "val_geracaoreferenciafinal_conjunto": "val_geracaoreferenciafinal",
        "flg_alerta_limitada": "flg_alerta_limitada",
    }
    known = silver.filter(F.col("id_ons_conjunto").isNotNull())
    per_text = known.groupBy(*grain, *text).agg(*[F.max(c).alias(n) for c, n in names.items()])
    lowest = F.struct(*[part for c in text for part in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))])
    numbers = [n for n in names.values() if n != "flg_alerta_limitada"]
    one = per_text.groupBy(*grain).agg(
        *[F.max(n).alias(n) for n in numbers], F.min(lowest).alias("_texts"), F.max("flg_alerta_limitada").alias("flg_alerta_limitada")
    )
    return one.select(*grain, *numbers, *[F.col(f"_texts.{c}").alias(c) for c in text], "flg_alerta_limitada")


def build(silver: DataFrame, registry: DataFrame) -> dict[str, DataFrame]:
    """The six Gold tables from a stored Silver table."""
    return {
        "dim_spe": dim_spe(silver, registry),
        "dim_conjunto": dim_conjunto(silver),
        "dim_restricao": dim_restricao(silver.sparkSession),
        "dim_tempo": dim_tempo(silver),
        "fato_geracao_spe": fato_geracao_spe(silver),
        "fato_geracao_conjunto": fato_geracao_conjunto(silver),
    }
