"""Analytical answers over the Gold tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustledger.functions import columns as C
from gustledger.operators import joins
from gustledger.plans import domain as D
from gustledger.session import stage


def in_period(facts: DataFrame, start, end) -> DataFrame:
    """Rows between two optional instants; month folders outside are not read."""
    bounds = C.between(F.col("din_instante"), start, end)
    if D.MONTH in facts.columns:
        month = F.col(D.MONTH)
        bounds += [month >= F.lit(_month(start))] if start is not None else []
        bounds += [month <= F.lit(_month(end))] if end is not None else []
    return facts.filter(C.all_of(bounds))


def _month(instant) -> str:
    """Label ``YYYY_MM`` of a date, a datetime or their ISO text."""
    return str(instant)[:7].replace("-", "_")


def projects(dim_spe: DataFrame, dim_conjunto: DataFrame) -> DataFrame:
    """Projects with group, subsystem, state and number of assets."""
    counted = dim_spe.groupBy("projeto_cv", "id_ons_conjunto").agg(F.count("spe").alias("_assets"))
    return (
        counted.join(dim_conjunto, "id_ons_conjunto")
        .groupBy(
            F.col("projeto_cv").alias("id_projeto"),
            F.col("nom_conjunto").alias("nome_conjunto"),
            F.col("nom_subsistema").alias("subsistema"),
            F.col("id_estado").alias("estado"),
        )
        .agg(F.sum("_assets").alias("qtd_spes"))
        .orderBy(F.asc_nulls_last("id_projeto"))
    )


def generation(
    fato_geracao_spe: DataFrame,
    dim_spe: DataFrame,
    project: str,
    grain: str = C.DAILY,
    start=None,
    end=None,
    interval_hours: float = D.INTERVAL_HOURS,
) -> DataFrame:
    """Energy, mean wind and active assets of one project per day or month.

    ``end`` is an instant: a date keeps only the midnight row of that day. The facts are
    summed per asset and period before they meet the dimension, so an asset with very many
    rows arrives at the join as one row per period; the project's assets, stored once, filter
    the scan before and skip the row groups of Gold that hold none of them. Infinite, huge and tiny cells count in the sums as doubles.
    An unknown grain raises ValueError.
    """
    period = C.period(F.col("din_instante"), grain)
    facts = in_period(fato_geracao_spe, start, end)
    assets = stage(dim_spe.filter(F.col("projeto_cv") == project).select("spe"), "assets")
    facts = joins.filter_by_keys(facts, "spe", assets)
    hours = F.lit(interval_hours).cast("decimal(9,6)")
    sums = {"_verified": "val_geracaoverificada", "_estimated": "val_geracaoestimada", "_wind": "val_ventoverificado"}
    per_asset = facts.groupBy("spe", period.alias("periodo")).agg(
        *[F.sum(C.exact(F.col(c))).alias(n) for n, c in sums.items()],
        *[F.sum(C.extreme(F.col(c))).alias(f"{n}_x") for n, c in sums.items()],
        F.count("val_ventoverificado").alias("_winds"),
    )

    def energy(name: str) -> Column:
        return C.total(F.sum(name), F.sum(f"{name}_x"), 2, hours)

    wind = F.sum("_wind").cast("double")
    wind = F.when(F.sum("_wind_x").isNull(), wind).otherwise(F.coalesce(wind, F.lit(0.0)) + F.sum("_wind_x"))
    return (
        per_asset.join(assets, "spe")
        .groupBy("periodo")
        .agg(
            energy("_verified").alias("total_mwh_verificado"),
            energy("_estimated").alias("total_mwh_estimado"),
            C.round_half_up(wind / F.nullif(F.sum("_winds"), F.lit(0)), 2).alias("vento_medio_ms"),
            F.count_distinct("spe").alias("qtd_spes_ativas"),
        )
        .orderBy("periodo")
    )


def restrictions(
    fato_geracao_conjunto: DataFrame,
    dim_conjunto: DataFrame,
    dim_spe: DataFrame,
    dim_restricao: DataFrame,
    project: str | None = None,
    start=None,
    end=None,
    interval_hours: float = D.INTERVAL_HOURS,
) -> DataFrame:
    """Restricted hours and curtailed total per project, group, reason and origin.

    ``total_mwh_cortado`` sums (reference - limit) without the interval length, as the reports
    in use do; ``energia_cortada_mwh`` is the same sum as energy. The facts are reduced to
    their group and code pair first, so the joins see few rows. A group that belongs to two
    projects counts in both; ``shared_groups`` lists such groups.
    """
    codes = ["cod_razaorestricao", "cod_origemrestricao"]
    reference = F.coalesce("val_geracaoreferenciafinal", "val_geracaoreferencia").cast("double")
    limit = F.col("val_geracaolimitada").cast("double")
    ordinary = C.extreme(reference).isNull() & C.extreme(limit).isNull()
    facts = in_period(fato_geracao_conjunto, start, end).filter(F.col("cod_razaorestricao").isNotNull())
    links = dim_spe.select("id_ons_conjunto", "projeto_cv").distinct()
    if project is not None:
        members = dim_spe.filter(F.col("projeto_cv") == project).select("id_ons_conjunto").distinct()
        facts = joins.filter_by_keys(facts, "id_ons_conjunto", stage(members, "members"))
    per_group = facts.groupBy("id_ons_conjunto", *codes, F.col("dsc_restricao").alias("_text")).agg(
        F.count("*").alias("_rows"),
        F.sum(F.when(ordinary, C.exact(reference) - C.exact(limit))).alias("_cut"),
        F.sum(F.when(~ordinary, reference - limit)).alias("_cut_x"),
    )
    hours = F.lit(interval_hours).cast("decimal(9,6)")
    return (
        per_group.join(dim_conjunto.select("id_ons_conjunto", "nom_conjunto"), "id_ons_conjunto")
        .join(links, "id_ons_conjunto")
        .join(dim_restricao, codes, "left")
        .groupBy(
            F.col("projeto_cv").alias("projeto"),
            F.col("nom_conjunto").alias("nome_conjunto"),
            F.col("cod_razaorestricao").alias("razao_restricao"),
            F.col("cod_origemrestricao").alias("origem"),
        )
        .agg(
            F.coalesce(F.min("dsc_restricao_completa"), F.min("_text")).alias("descricao"),
            C.round_half_up(F.sum("_rows") * hours, 1).alias("total_horas_com_restricao"),
            C.total(F.sum("_cut"), F.sum("_cut_x"), 2).alias("total_mwh_cortado"),
            C.total(F.sum("_cut"), F.sum("_cut_x"), 2, hours).alias("energia_cortada_mwh"),
        )
        .orderBy(F.desc_nulls_last("total_mwh_cortado"))
    )


def shared_groups(dim_spe: DataFrame) -> DataFrame:
    """Groups whose assets belong to several projects, with the number of projects; there should be none."""
    links = dim_spe.filter(F.col("id_ons_conjunto").isNotNull()).select("id_ons_conjunto", "projeto_cv").distinct()
    return links.groupBy("id_ons_conjunto").agg(F.count("*").alias("projetos")).filter(F.col("projetos") > 1)
