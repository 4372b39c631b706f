"""Silver: registered assets joined to their group, cleaned, checked and split."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustledger.functions import columns as C
from gustledger.operators import cleaning, contract, duplicates, joins
from gustledger.plans import domain as D
from gustledger.session import stage

# Cells that the soft drop nulled; counted by the report and left out of Silver.
AUDIT = ["aud_vento_fora_faixa", "aud_vento_flag", "aud_geracao_negativa"]
# Place of a detail row in its files, carried only for the policy that keeps first rows.
ADDRESS = "_address"


def group_name() -> Column:
    """Name under which an asset's group reports."""
    return C.choose_key(
        F.col("nom_modalidadeoperacao"), D.GROUP_MODE, F.col("nom_conjuntousina"), F.col("nom_usina")
    )


def registered_assets(detail: DataFrame, registry: DataFrame, pattern: str = D.PLANT_KEY) -> DataFrame:
    """Detail rows of registered assets, with project and asset name."""
    lookup = registry.select(
        F.col("projeto").alias("projeto_cv"), F.col("spe").alias("nome_spe_cv"), F.col("ceg").alias("_ceg")
    )
    return joins.embedded_key_join(detail, lookup, "ceg", "_ceg", pattern)


def wanted_groups(groups: DataFrame, assets: DataFrame) -> DataFrame:
    """Group rows whose name some registered asset refers to."""
    return joins.semi_filter(groups, F.col("nom_usina"), assets, group_name())


def join_groups(assets: DataFrame, groups: DataFrame) -> DataFrame:
    """Asset rows left-joined to their group by name and instant, with soft drops and flags.

    The group's cells are treated before the join, once per group and not once per asset. A
    group that reports twice for an instant gives two rows, which the duplicate check then sees.
    """
    wind, invalid = F.col("val_ventoverificado"), C.to_int(F.col("flg_dadoventoinvalido")) == 1
    low, high = D.WIND_RANGE
    left = assets.drop("nom_subsistema").withColumns(
        {
            "aud_vento_fora_faixa": C.flag(C.out_of_range(wind, low, high)),
            "aud_vento_flag": C.flag(invalid),
            "val_ventoverificado": C.soft_drop(wind, low, high, invalid),
            "flg_estimada_por_historico": C.flag(invalid),
        }
    ).withColumnRenamed("id_ons", "id_ons_spe")

    limit = F.col("val_geracaolimitada")
    final, initial = F.col("val_geracaoreferenciafinal"), F.col("val_geracaoreferencia")
    right = groups.select(
        F.col("nom_usina").alias("_nom_conjunto"),
        "din_instante",
        F.col("id_ons").alias("id_ons_conjunto"),
        "nom_subsistema",
        C.soft_drop(F.col("val_geracao"), low=0).alias("val_geracao_conjunto"),
        C.flag(F.col("val_geracao") < 0).alias("aud_geracao_negativa"),
        "cod_razaorestricao",
        "cod_origemrestricao",
        "dsc_restricao",
        limit.alias("val_geracaolimitada_conjunto"),
        F.col("val_disponibilidade").alias("val_disponibilidade_conjunto"),
        initial.alias("val_geracaoreferencia_conjunto"),
        final.alias("val_geracaoreferenciafinal_conjunto"),
        C.exceeds_reference(limit, final, initial).alias("flg_alerta_limitada"),
    )
    joined = joins.case_insensitive_left_join(
        left, right, group_name(), F.col("_nom_conjunto"), ["din_instante"]
    ).drop("_nom_conjunto")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("flg_alerta_limitada", "aud_geracao_negativa")}
    return joined.withColumns(zero)


def repeated_groups(groups: DataFrame) -> DataFrame:
    """Instants for which a group reports more than once, in any case of its name; each doubles asset rows."""
    name = F.upper("nom_usina")
    known = groups.select(name.alias("nom_usina"), C.to_instant(F.col("din_instante")).alias("din_instante")).dropna()
    return known.groupBy("nom_usina", "din_instante").agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def typed(df: DataFrame) -> DataFrame:
    """Instants and measurements in their types, whatever the files held."""
    return cleaning.coerce_numbers(cleaning.coerce_instant(df, "din_instante"))


def build(detail: DataFrame, groups: DataFrame, registry: DataFrame, pattern: str = D.PLANT_KEY) -> DataFrame:
    """Joined Silver rows before the checks, with the audit columns.

    The registered assets are stored: the wanted groups, the keys and the join read them, so
    the raw rows are read and typed once.
    """
    assets = stage(registered_assets(typed(detail), registry, pattern), "assets")
    joined = join_groups(assets, wanted_groups(typed(groups), assets))
    counters = ["flg_alerta_limitada", "flg_estimada_por_historico", *AUDIT]
    return cleaning.clean_null_tokens(joined).withColumns({c: F.col(c).cast("int") for c in counters})


@dataclass(frozen=True)
class Treated:
    """Joined rows after the duplicate split; Silver, rejects and anomalies derive from it."""

    duplicates: duplicates.DuplicateSplit

    def _contract(self) -> tuple[DataFrame, DataFrame]:
        return contract.split(self.duplicates.clean, D.CONTRACT, D.REASON, D.STAGE, D.CONTRACT_STAGE)

    def silver(self) -> DataFrame:
        return self._contract()[0]

    def quarantine(self) -> DataFrame:
        texts = {D.REASON: F.lit(D.CONFLICT_REASON), D.STAGE: F.lit(D.CONFLICT_STAGE)}
        return self.duplicates.quarantined.withColumns(texts).unionByName(self._contract()[1])

    def anomalies(self) -> DataFrame:
        return anomalies(self.duplicates.clean)

    def duplicate_counts(self) -> DataFrame:
        return self.duplicates.counts


def treat(joined: DataFrame, policy: str = duplicates.DOCUMENTED) -> Treated:
    """Split joined rows into Silver and quarantine. ``joined`` should be a stored table.

    The policy ``first`` needs the column ``ADDRESS`` of the detail rows; Silver and quarantine don't have it.
    """
    address = ADDRESS if policy == duplicates.FIRST else None
    rows = joined.drop(*AUDIT, *([] if address else [ADDRESS]))
    ignore = tuple(cleaning.present(rows, ["filename"])) if policy == duplicates.DOCUMENTED else ()
    split = duplicates.split_duplicates(rows, D.SILVER_KEY, ignore, policy, address=address)
    return Treated(duplicates.DuplicateSplit(split.clean.drop(ADDRESS), split.quarantined.drop(ADDRESS), split.counts))


def anomalies(rows: DataFrame) -> DataFrame:
    """One row per contract reject or soft anomaly, with its reasons as text."""
    wind, generation = F.col("val_ventoverificado").isNull(), F.col("val_geracao_conjunto").isNull()
    alert = F.col("flg_alerta_limitada") == 1
    texts = F.transform(
        contract.REASONS,
        lambda r: F.concat(F.lit("Coluna ["), r["column"], F.lit("] violou ["), r["check"], F.lit("]")),
    )
    soft = F.concat_ws(
        " ; ",
        F.when(wind, F.lit(D.WIND_NULLED)),
        F.when(generation, F.lit(D.GENERATION_NULLED)),
        F.when(alert, F.lit(D.LIMIT_ABOVE)),
    )
    rejected = contract.broken(D.CONTRACT)
    found = rows.withColumn("_rejected", rejected).filter(
        F.col("_rejected") | wind | generation | F.coalesce(alert, F.lit(False))
    )
    return contract.with_reasons(found, D.CONTRACT).select(
        F.col("nome_spe_cv").alias("nome"),
        F.col("id_estado").alias("estado"),
        F.col("nom_subsistema").alias("subsistema"),
        F.date_format("din_instante", "dd/MM/yyyy HH:mm").alias("din_instante"),
        F.when(F.col("_rejected"), F.concat(F.lit("QUARENTENA: "), F.concat_ws(" | ", texts)))
        .otherwise(F.concat(F.lit("SOFT DROP/FLAG: "), soft))
        .alias("justificativa"),
    )
