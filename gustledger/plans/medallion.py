"""One run from raw files to Silver, quarantine, report and Gold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gustledger.operators import cleaning, completeness, duplicates, keys, profile
from gustledger.plans import domain as D
from gustledger.plans import analytics, report, silver, star
from gustledger.session import stage, staging_scope
from gustledger.sources import files, sinks
from gustledger.sources.snapshots import Store


def silver_layer(
    spark: SparkSession,
    detail_paths,
    group_paths,
    registry_path: str,
    out: str,
    policy: str = duplicates.DOCUMENTED,
    as_of: Column | None = None,
    pattern: str = D.PLANT_KEY,
    sep: str = ",",
) -> dict[str, DataFrame]:
    """Build and write Silver, quarantine, anomalies and the report under ``out``.

    The joined rows are stored once, as a table that the next run replaces: each sink then
    reads what it needs from files, and a lost executor repeats one stage only. ``checks`` has
    what a person should look at: keys that a join would lose, and groups that repeat rows.
    Joined rows, Silver and quarantine are published together, once all three are whole.
    """
    store = Store(spark, out)
    registry = files.read_registry(spark, registry_path, D.REGISTRY_SCHEMA)
    address = silver.ADDRESS if policy == duplicates.FIRST else None
    detail = files.read_union(spark, detail_paths, D.DETAIL_TYPES, sep=sep, address_column=address)
    groups = files.read_union(spark, group_paths, D.GROUP_TYPES, file_column=None, sep=sep)
    rows = silver.build(detail, groups, registry, pattern)
    raw = profile.Counter(report.raw_counters(rows))
    joined = store.write(rows, "joined", counter=raw)
    treated = silver.treat(joined, policy)

    kept, rejected = treated.silver(), profile.Counter(report.rejected_counters())
    good = profile.Counter(report.clean_counters(kept))
    clean = store.write(by_month(kept), "silver", D.MONTH, counter=good).drop(D.MONTH)
    quarantine = store.write(treated.quarantine(), "quarantine", counter=rejected)
    counts = report.Counts(raw.row(spark), good.row(spark), rejected.row(spark))
    store.publish()
    sinks.write_json_lines(treated.anomalies(), f"{out}/anomalies")

    assets = stage(report.asset_completeness(clean, registry), "completeness")
    per_project = completeness.project_completeness(assets, "projeto_cv")
    sinks.write_json_lines(per_project, f"{out}/completeness_projects")
    sinks.write_json_lines(
        completeness.problem_assets(assets, "projeto_cv", "nome_spe_cv"), f"{out}/completeness_assets"
    )
    sinks.write_json_lines(
        completeness.assets_without_data(assets, "projeto_cv", "nome_spe_cv"), f"{out}/assets_without_data"
    )
    as_of = F.current_timestamp() if as_of is None else as_of
    summary = report.quality_report(clean, counts, treated.duplicate_counts(), registry, as_of, f"{out}/quarantine")
    summary.write.mode("overwrite").text(f"{out}/report")
    sinks.write_json_lines(source_checks(detail, groups), f"{out}/checks_silver")
    return {"silver": clean, "quarantine": quarantine, "joined": joined, "registry": registry}


def by_month(df: DataFrame) -> DataFrame:
    return df.withColumn(D.MONTH, F.date_format("din_instante", "yyyy_MM"))


def _counted(check: str, df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n")).select(F.lit(check).alias("check"), F.lit(None).cast("string").alias("item"), "n")


def source_checks(detail: DataFrame, groups: DataFrame) -> DataFrame:
    """(check, item, n): null join keys of both sources, and instants for which a group reports twice."""
    frames = [
        profile.null_counts(df, cleaning.present(df, names)).select(F.lit(f"null_keys_{side}").alias("check"), F.col("coluna").alias("item"), F.col("nulos").alias("n"))
        for side, df, names in (
            ("detail", detail, ["ceg", "din_instante", "nom_usina", "nom_conjuntousina"]),
            ("groups", groups, ["nom_usina", "din_instante"]),
        )
    ]
    return profile.union_all([*frames, _counted("repeated_groups", silver.repeated_groups(groups))])


def gold_checks(gold: dict[str, DataFrame]) -> DataFrame:
    """(check, item, n): rows of each table, coverage of the facts, and groups of several projects."""
    counts = profile.table_counts(gold).select(F.lit("rows").alias("check"), F.col("table").alias("item"), "n")
    seen = profile.coverage(gold["fato_geracao_spe"], gold["dim_spe"], "spe", "spe", "id_ons_conjunto")
    cover = seen.unpivot([], seen.columns, "item", "n").select(F.lit("coverage").alias("check"), "item", "n")
    return profile.union_all([counts, cover, _counted("shared_groups", analytics.shared_groups(gold["dim_spe"]))])


# Tables whose plan groups by their key: only a null key is possible there.
GROUPED = ("dim_conjunto", "dim_tempo")


def gold_layer(clean: DataFrame, registry: DataFrame, out: str) -> dict[str, DataFrame]:
    """Write the six Gold tables under ``out``; a broken key fails the run and leaves the old ones.

    Dimensions are staged and checked first. The facts lie in one folder per month, in ranges of their
    key: that one exchange arranges the rows so that a project's are found without reading the others, and
    tells whether the key repeats. All tables are published together; they are also views for SQL.
    """
    staged = {}
    for name, table in star.build(clean, registry).items():
        if name.startswith("fato"):
            staged[name] = table
            continue
        staged[name] = stage(table, name)
        key = D.GOLD_KEYS[name]
        if key and name in GROUPED:
            keys.assert_not_null(staged[name], key, name)
        elif key:
            keys.assert_key(staged[name], key, name)
    store, gold = Store(clean.sparkSession, out), {}
    try:
        for name, table in staged.items():
            if name.startswith("fato"):
                gold[name] = store.write(by_month(table), name, D.MONTH, tuple(D.GOLD_KEYS[name]))
            else:
                gold[name] = store.write(table, name)
    except Exception:
        store.discard()
        raise
    store.publish()
    store.vacuum()
    sinks.register_views(gold)
    sinks.write_json_lines(gold_checks(gold), f"{out}/checks_gold")
    return gold


def current(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """All published tables under ``out``, as of one moment."""
    return Store(spark, out).read()


def run(spark: SparkSession, detail_paths, group_paths, registry_path: str, out: str, **options):
    """Silver, then Gold. ``options`` are those of ``silver_layer``; what the run staged is deleted at its end."""
    with staging_scope(spark):
        layer = silver_layer(spark, detail_paths, group_paths, registry_path, out, **options)
        return {**layer, **gold_layer(layer["silver"], layer["registry"], out)}
