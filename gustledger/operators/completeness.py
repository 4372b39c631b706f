"""Completeness against a registry, gaps, freshness and period of an interval series.

An instant on the grid of the series (a whole number of steps since 1970) is a slot, and an asset's
slots are bitmaps: one row for each word of WORD slots, with a bit for each slot. Words merge by
OR, so they are combined before the shuffle and stored ones can be merged with new ones; distinct
instants are counted bits, gaps follow from the bits and from the ends of neighbouring words.
Words of a long are sums of a hash aggregate and as many as the data fills; the library's
4 KB bitmaps would need a sort and, with few instants of an asset in a task, more bytes than the instants.
Assets with an instant off the grid take time boxes and a window over these instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pyspark.sql import types as T

from gustledger.functions import columns as C
from gustledger.operators import joins
from gustledger.session import stage

# Slots of a word; its bits stay below the sign of a long.
WORD = 60
# Rows that tell whether the instants of a table are on its grid at all.
PROBE_ROWS = 1000
DAY_MINUTES = 24 * 60

# Alert threshold in percent, slot length and longest step that is no gap.
THRESHOLD, STEP_MINUTES, GAP_MINUTES = 95.0, 30, 45


def spans(
    df: DataFrame, asset: list[str], ts: str, gap_minutes: int = GAP_MINUTES, valid: Column | None = None,
    unique: bool = False,
) -> DataFrame:
    """Per asset and time box of ``gap_minutes``: instants, valid instants, first and last instant.

    Two instants of one box are never a gap apart, so gaps can be found from the boxes alone.
    An asset with very many rows is reduced to boxes on the map side. ``unique`` says that
    (asset, instant) has no duplicates, which saves one shuffle.
    """
    ok = F.lit(True) if valid is None else valid
    if unique:
        instants = df.select(*asset, ts, ok.alias("_ok"))
    else:
        instants = df.groupBy(*asset, ts).agg(F.max(ok).alias("_ok"))
    box = F.window(ts, f"{gap_minutes} minutes")["start"].alias("_box")
    return instants.groupBy(*asset, box).agg(
        F.count("*").alias("received"),
        F.count_if("_ok").alias("valid"),
        F.min(ts).alias("first"),
        F.max(ts).alias("last"),
    )


def per_asset(boxes: DataFrame, asset: list[str], gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """Per asset: distinct instants, valid ones, and steps longer than ``gap_minutes``.

    The window orders boxes, so its size depends on the period and not on the number of rows.
    """
    before = F.lag("last").over(W.partitionBy(*asset).orderBy("_box"))
    step = F.col("first") - before
    return (
        boxes.withColumn("_gap", step > F.expr(f"interval {gap_minutes} minutes"))
        .groupBy(*asset)
        .agg(
            F.sum("received").alias("received"),
            F.sum("valid").alias("valid"),
            F.count_if("_gap").alias("gaps"),
        )
    )


def _grid(df: DataFrame, ts: str, step_minutes: int) -> tuple[Column, Column] | None:
    """The number of an instant's slot and whether it is off the grid; None if days don't hold whole steps."""
    if DAY_MINUTES % step_minutes:
        return None
    if isinstance(df.schema[ts].dataType, T.TimestampType):
        micros, width = F.unix_micros(ts), step_minutes * 60_000_000
        over = F.pmod(micros, F.lit(width))
        return F.floor((micros - over) / width), over != 0
    minute = F.hour(ts) * 60 + F.minute(ts)
    day = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    slot = day * (DAY_MINUTES // step_minutes) + F.floor(minute / step_minutes)
    return slot, (minute % step_minutes != 0) | (F.extract(F.lit("SECOND"), F.col(ts)) != 0)


def slot_words(
    df: DataFrame, asset: list[str], ts: str, valid: Column | None = None, step_minutes: int = STEP_MINUTES
) -> DataFrame:
    """Per asset and word of WORD slots: bits of received and of valid slots, first and last slot, rows off the grid.

    Repeated instants set the same bit. Rows without an instant count nowhere.
    """
    slot, off = _grid(df, ts, step_minutes)
    ok = F.lit(True) if valid is None else valid
    rows = df.filter(F.col(ts).isNotNull()).select(*asset, slot.cast("long").alias("_slot"), off.alias("_off"), ok.alias("_ok"))
    bit = F.expr(f"CASE WHEN NOT _off THEN shiftleft(1L, CAST(pmod(_slot, {WORD}) AS INT)) END")
    word = F.floor(F.col("_slot") / WORD).alias("word")
    return rows.withColumn("_bit", bit).groupBy(*asset, word).agg(
        F.coalesce(F.bit_or("_bit"), F.lit(0)).alias("bits"),
        F.coalesce(F.bit_or(F.when(F.col("_ok"), F.col("_bit"))), F.lit(0)).alias("valid_bits"),
        F.min(F.when(~F.col("_off"), F.col("_slot"))).alias("first"),
        F.max(F.when(~F.col("_off"), F.col("_slot"))).alias("last"),
        F.count_if("_off").alias("off_grid"),
    )


def merge_words(words: DataFrame, asset: list[str]) -> DataFrame:
    """One row for each asset and word of several results of ``slot_words``, such as one for each month."""
    return words.groupBy(*asset, "word").agg(
        F.bit_or("bits").alias("bits"), F.bit_or("valid_bits").alias("valid_bits"),
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("off_grid").alias("off_grid"),
    )


def _gaps_inside(bits: Column, apart: int) -> Column:
    """Pairs of neighbouring set bits that are at least ``apart`` positions apart, from 2 on.

    Every bit is drawn out over the next apart - 2 positions; a run of the result ends exactly where
    a gap follows. What is drawn out beyond the word begins no run.
    """
    if apart >= WORD:
        return F.lit(0)
    drawn, width = bits, 1
    while width < apart - 1:
        more = min(width, apart - 1 - width)
        drawn, width = drawn.bitwiseOR(F.shiftleft(drawn, more)), width + more
    inside = F.lit((1 << WORD) - 1)
    drawn = drawn.bitwiseAND(inside)
    starts = drawn.bitwiseAND(F.bitwise_not(F.shiftleft(drawn, 1)))
    return F.greatest(F.bit_count(starts) - 1, F.lit(0))


def words_per_asset(
    words: DataFrame, asset: list[str], gap_minutes: int = GAP_MINUTES, step_minutes: int = STEP_MINUTES
) -> DataFrame:
    """Like ``per_asset`` from ``slot_words`` without instants off the grid.

    An asset's words are ordered in one short array, whose length depends on the period only.
    """
    apart = gap_minutes // step_minutes + 1  # slots from one instant to the next that make a gap
    # With a gap shorter than a step every two neighbours are a gap apart.
    inside = F.bit_count("bits") - 1 if apart == 1 else _gaps_inside(F.col("bits"), apart)
    ends = F.sort_array(F.collect_list(F.struct("first", "last")))
    out = words.filter(F.col("bits") != 0).groupBy(*asset).agg(
        F.sum(F.bit_count("bits")).cast("long").alias("received"), F.sum(F.bit_count("valid_bits")).cast("long").alias("valid"),
        F.sum(inside).cast("long").alias("_inside"), ends.alias("_ends"),
    )
    later = F.slice("_ends", F.lit(2), F.size("_ends"))
    steps = F.zip_with(F.slice("_ends", F.lit(1), F.size("_ends") - 1), later, lambda a, b: b["first"] - a["last"])
    between = F.size(F.filter(steps, lambda d: d >= apart))
    return out.select(*asset, "received", "valid", (F.col("_inside") + between).alias("gaps"))


def instants_per_asset(
    df: DataFrame, asset: list[str], ts: str, gap_minutes: int = GAP_MINUTES, valid: Column | None = None,
    unique: bool = False, step_minutes: int = STEP_MINUTES,
) -> DataFrame:
    """Per asset: distinct instants, valid ones and gaps, by bitmaps where all its instants are on the grid.

    If none of the first rows is on the grid, all assets take the boxes; either way gives the same rows.
    """
    boxes = lambda part: per_asset(spans(part, asset, ts, gap_minutes, valid, unique), asset, gap_minutes)
    grid = _grid(df, ts, step_minutes)
    if grid is None:
        return boxes(df)
    known, off = df.filter(F.col(ts).isNotNull()).limit(PROBE_ROWS).agg(F.count("*"), F.count_if(grid[1])).first()
    if known and known == off:
        return boxes(df)
    words = stage(slot_words(df, asset, ts, valid, step_minutes), "slot_words")
    uneven = stage(words.filter(F.col("off_grid") > 0).select(*asset).distinct(), "off_grid")
    if uneven.isEmpty():
        return words_per_asset(words, asset, gap_minutes, step_minutes)
    even = words_per_asset(joins.key_difference(words, uneven, asset), asset, gap_minutes, step_minutes)
    return even.unionByName(boxes(joins.key_intersection(df, uneven, asset)))


def gaps(df: DataFrame, asset: str, ts: str, gap_minutes: int = GAP_MINUTES, step_minutes: int = STEP_MINUTES) -> DataFrame:
    """Per asset the number of steps between neighbouring instants above ``gap_minutes``."""
    return instants_per_asset(df, [asset], ts, gap_minutes, unique=True, step_minutes=step_minutes).select(asset, "gaps")


def data_period(df: DataFrame, ts: str, step_minutes: int = STEP_MINUTES) -> DataFrame:
    """One row: first and last instant, their days as text, and the slots of the whole months."""
    return df.agg(F.min(ts).alias("first"), F.max(ts).alias("last")).select(
        "first",
        "last",
        F.date_format("first", "yyyy-MM-dd").alias("inicio"),
        F.date_format("last", "yyyy-MM-dd").alias("fim"),
        C.slots_between(F.col("first"), F.col("last"), step_minutes).alias("slots"),
    )


def asset_completeness(
    df: DataFrame,
    registry: DataFrame,
    asset: str,
    project: str,
    ts: str,
    valid: Column | None = None,
    step_minutes: int = STEP_MINUTES,
    gap_minutes: int = GAP_MINUTES,
    slots: Column | None = None,
    unique: bool = False,
) -> DataFrame:
    """One row per registered asset: received and valid instants, expected slots, percent, gaps.

    ``registry`` has the columns ``asset`` and ``project``. The expected slots cover the whole
    months of the data unless ``slots`` gives them.
    """
    expected = data_period(df, ts, step_minutes).select("slots").scalar() if slots is None else slots
    counted = instants_per_asset(df, [asset], ts, gap_minutes, valid, unique, step_minutes)
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("valid", "gaps")}
    return (
        registry.select(project, asset)
        .join(counted, asset, "left")
        .withColumn("has_data", F.col("received").isNotNull())
        .withColumns({"received": F.coalesce("received", F.lit(0)), **zero, "expected": expected})
        .withColumn("pct", C.percent(F.col("received"), F.col("expected"), 1))
    )


def project_completeness(assets: DataFrame, project: str, threshold: float = THRESHOLD) -> DataFrame:
    """One row per project from the rows of ``asset_completeness``."""
    out = assets.groupBy(project).agg(
        F.count("*").alias("spes_esperadas"),
        F.count_if(~F.col("has_data")).alias("spes_sem_dado"),
        F.count_if(problem()).alias("spes_com_problema"),
        F.max("expected").alias("n_periodos_fixo_por_spe"),
        F.sum("expected").alias("esperado_total"),
        F.sum("received").alias("recebido_total"),
        F.sum("valid").alias("recebido_valido"),
        F.sum("gaps").alias("gaps_detectados"),
    )
    return out.withColumns(
        {
            "pct_envio": C.percent(F.col("recebido_total"), F.col("esperado_total"), 1),
            "pct_dados_validos": C.percent(F.col("recebido_valido"), F.col("esperado_total"), 1),
        }
    ).withColumn("alerta", (F.col("pct_envio") < threshold) | (F.col("pct_dados_validos") < threshold))


def problem() -> Column:
    """Assets with data that are incomplete or have gaps."""
    return F.col("has_data") & ((F.col("pct") < 100.0) | (F.col("gaps") > 0))


def problem_assets(assets: DataFrame, project: str, asset: str) -> DataFrame:
    """One row per asset with a problem (the map of a report, in rows)."""
    return assets.filter(problem()).select(
        project, asset, F.col("received").alias("recebido"), F.col("expected").alias("esperado"), "pct", "gaps"
    )


def assets_without_data(assets: DataFrame, project: str, asset: str) -> DataFrame:
    return assets.filter(~F.col("has_data")).select(project, asset)


def freshness(df: DataFrame, ts: str, as_of: Column) -> DataFrame:
    """One row: is the last instant in the month before ``as_of``?

    OK if so, ALERTA if later (``ok`` stays false), FALHA if earlier or if there is no data.
    """
    last = F.col("last")
    month, expected = C.month_start(last), F.add_months(C.month_start(as_of), -1)
    stamp = F.date_format(last, "dd/MM/yyyy HH:mm")
    return df.agg(F.max(ts).alias("last")).select(
        F.when(last.isNull(), "FALHA")
        .when(month == expected, "OK")
        .when(month > expected, "ALERTA")
        .otherwise("FALHA")
        .alias("status"),
        F.coalesce(month == expected, F.lit(False)).alias("ok"),
        F.when(last.isNull(), "N/A").otherwise(F.date_format(expected, "MM/yyyy")).alias("ultimo_mes_esperado"),
        F.when(last.isNull(), "Sem dados")
        .when(month == expected, F.concat(F.lit("Último registro: "), stamp))
        .when(
            month > expected,
            F.concat(F.lit("Base contém dados do mês atual ("), F.date_format(last, "MM/yyyy"), F.lit(")")),
        )
        .otherwise(F.concat(F.lit("Dados desatualizados. Último: "), stamp))
        .alias("mensagem"),
    )
