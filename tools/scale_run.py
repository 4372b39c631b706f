"""Time the whole flow on generated raw files of 47 x factor assets over six months.

usage: python tools/scale_run.py folder [factor ...]

The raw files have the shape and the defects the flow expects: about four percent missing
readings, a few per mille of invalid wind, negative generation, identical and differing copies,
and one month whose numbers are text.
"""

from __future__ import annotations

import json
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from gustledger.plans import analytics, medallion  # noqa: E402
from gustledger.session import local_session  # noqa: E402
from gustledger.sources import sinks  # noqa: E402

MONTHS = {"2025_12": 31, "2026_01": 31, "2026_02": 28, "2026_03": 31, "2026_04": 30, "2026_05": 31}
ASSETS, GROUPS = 47, 7


def _instants(month: str, slot):
    return F.expr(f"timestamp_ntz'{month.replace('_', '-')}-01 00:00:00'") + F.make_dt_interval(mins=slot * 30)


def _rare(salt: int, per_mille: int):
    return F.pmod(F.xxhash64("asset", "slot", F.lit(salt)), F.lit(1000)) < per_mille


def _code(asset):
    return F.concat(F.lpad(asset.cast("string"), 6, "0"), F.lit("-"), (asset % 10).cast("string"))


def _detail(spark: SparkSession, month: str, days: int, factor: int) -> DataFrame:
    slots, assets = days * 48, ASSETS * factor
    asset, slot = F.col("asset"), F.col("slot")
    group = F.floor(asset * GROUPS / ASSETS)
    noise = F.pmod(F.xxhash64("asset", "slot"), F.lit(4000)) / 100.0
    rows = spark.range(assets * slots).select((F.col("id") % assets).alias("asset"), F.floor(F.col("id") / assets).alias("slot"))
    rows = rows.filter(~_rare(1, 38)).withColumn("copies", F.when(_rare(2, 2), 2).otherwise(1))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    differs = F.when(_rare(3, 500), F.col("copy") * 0.25).otherwise(0.0)
    out = rows.select(
        F.lit("NE").alias("id_subsistema"),
        F.lit("RN").alias("id_estado"),
        F.lit("Rio Grande do Norte").alias("nom_estado"),
        F.when(group % 2 == 0, "Tipo II-C").otherwise("Tipo I").alias("nom_modalidadeoperacao"),
        F.concat(F.lit("Conj. "), group.cast("string")).alias("nom_conjuntousina"),
        F.concat(F.lit("CONJ. "), group.cast("string")).alias("nom_usina"),
        F.concat(F.lit("U"), asset.cast("string")).alias("id_ons"),
        F.concat(F.lit("EOL.CV.RN."), _code(asset), F.lit(".01")).alias("ceg"),
        _instants(month, slot).alias("din_instante"),
        F.when(_rare(4, 3), 55.0).otherwise(noise / 2).alias("val_ventoverificado"),
        F.when(_rare(5, 5), 1.0).when(_rare(6, 900), 0.0).alias("flg_dadoventoinvalido"),
        F.when(_rare(7, 2), -1.0).otherwise(noise).alias("val_geracaoestimada"),
        (noise + differs).alias("val_geracaoverificada"),
    )
    if month == "2026_02":
        out = out.withColumns({c: F.col(c).cast("string") for c, t in out.dtypes if t == "double"})
    return out


def _group(spark: SparkSession, month: str, days: int, factor: int) -> DataFrame:
    slots, groups = days * 48, GROUPS * factor
    rows = spark.range(groups * slots).select((F.col("id") % groups).alias("asset"), F.floor(F.col("id") / groups).alias("slot"))
    group = F.col("asset").cast("string")
    level = F.pmod(F.xxhash64("asset", "slot"), F.lit(20000)) / 100.0
    return rows.select(
        F.lit("NE").alias("id_subsistema"),
        F.lit("NORDESTE").alias("nom_subsistema"),
        F.lit("RN").alias("id_estado"),
        F.concat(F.lit("Conj. "), group).alias("nom_usina"),
        F.concat(F.lit("G"), group).alias("id_ons"),
        F.lit("-").alias("ceg"),
        _instants(month, F.col("slot")).alias("din_instante"),
        F.when(_rare(1, 1), -2.0).otherwise(level).alias("val_geracao"),
        F.when(_rare(2, 50), "REL").when(_rare(3, 100), "CNF").alias("cod_razaorestricao"),
        F.when(_rare(4, 500), "LOC").otherwise("SIS").alias("cod_origemrestricao"),
        F.lit(None).cast("string").alias("dsc_restricao"),
        (level * 0.8).alias("val_geracaolimitada"),
        F.lit(200.0).alias("val_disponibilidade"),
        level.alias("val_geracaoreferencia"),
        F.when(_rare(5, 500), level * 0.9).alias("val_geracaoreferenciafinal"),
    )


def generate(spark: SparkSession, folder: str, factor: int):
    details, groups = [], []
    for month, days in MONTHS.items():
        details.append(f"{folder}/detail_{month}")
        groups.append(f"{folder}/group_{month}")
        _detail(spark, month, days, factor).write.parquet(details[-1])
        _group(spark, month, days, factor).write.parquet(groups[-1])
    asset = F.col("id")
    registry = spark.range(ASSETS * factor).select(
        F.concat(F.lit("P"), F.floor(asset * GROUPS / ASSETS).cast("string")).alias("projeto"),
        F.concat(F.lit("S"), asset.cast("string")).alias("spe"),
        _code(asset).alias("ceg"),
    )
    registry.coalesce(1).write.option("header", True).csv(f"{folder}/registry")
    return details, groups, f"{folder}/registry"


def main(folder: str, factors: list[int]) -> None:
    spark = local_session(8, "20g", app="scale")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    as_of = F.lit("2026-06-10").cast("timestamp_ntz")
    for factor in factors:
        base = f"{folder}/x{factor}"
        paths = generate(spark, base, factor)
        start = time.perf_counter()
        tables = medallion.run(spark, *paths, f"{base}/out", as_of=as_of)
        built = time.perf_counter() - start
        start = time.perf_counter()
        sinks.json_records(
            analytics.generation(tables["fato_geracao_spe"], tables["dim_spe"], "P1", "mensal")
        ).collect()
        answered = time.perf_counter() - start
        counts = {n: tables[n].count() for n in ("joined", "silver", "quarantine", "fato_geracao_conjunto")}
        print(json.dumps({"factor": factor, "flow_sec": round(built, 1), "generation_sec": round(answered, 2), **counts}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], [int(x) for x in sys.argv[2:]] or [1, 10])
