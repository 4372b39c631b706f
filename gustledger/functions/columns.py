"""Column builders: every function takes and returns Columns, nothing runs in Python."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that stands for "no value" in the source files.
NULL_TOKENS = ("null", "NULL", "NaN", "nan", "N/A", "n/a", "-")

# The two grains of the generation report.
DAILY, MONTHLY = "diario", "mensal"

def null_tokens(name: str, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    """The text column ``name`` with blank text and null tokens as NULL.

    One short expression per column: with many text columns a longer one makes the generated
    method too large for the JIT compiler, which costs far more than the pattern.
    """
    listed = "|".join(re.escape(t).replace("'", r"\x27") for t in tokens)
    pattern = rf"(?U)^(?:[\s\x1c-\x1f]*|{listed})\z"
    return F.expr(f"CASE WHEN NOT (`{name}` RLIKE r'{pattern}') THEN `{name}` END")


def no_nan(c: Column) -> Column:
    """NaN becomes NULL (a NaN would compare as the largest number)."""
    return F.when(~F.isnan(c), c)


def to_double(c: Column) -> Column:
    """Any column to double; what is not a finite or infinite number becomes NULL."""
    text = F.trim(c.cast("string"))
    # a trailing d or f is a type suffix to the parser, not part of a number
    return no_nan(F.when(~text.rlike(r"[0-9.][dDfF]$"), text.try_cast("double")))


def to_int(c: Column) -> Column:
    """Any column to int through double, so the text ``1.0`` is 1."""
    return F.round(to_double(c)).try_cast("int")


def to_instant(c: Column) -> Column:
    """Any column to a timestamp without zone; bad text becomes NULL."""
    return c.try_cast("timestamp_ntz")


def out_of_range(v: Column, low=None, high=None) -> Column:
    """True where the value breaks a bound; NULL counts as inside."""
    bounds = []
    if low is not None:
        bounds.append(v < low)
    if high is not None:
        bounds.append(v > high)
    return F.coalesce(reduce(lambda a, b: a | b, bounds), F.lit(False))


def soft_drop(v: Column, low=None, high=None, invalid: Column | None = None) -> Column:
    """Null the cell if it breaks a bound or its ``invalid`` condition holds; keep the row."""
    bad = out_of_range(v, low, high)
    if invalid is not None:
        bad = bad | F.coalesce(invalid, F.lit(False))
    return F.when(~bad, v)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def exceeds_reference(limit: Column, *references: Column) -> Column:
    """Flag: limit above the first reference that is known."""
    return flag(limit > F.coalesce(*references))


def choose_key(mode: Column, mode_value: str, if_mode: Column, otherwise: Column) -> Column:
    """One of two columns, picked by an operating mode."""
    return F.when(mode == mode_value, if_mode).otherwise(otherwise)


def embedded_key(c: Column, pattern: str) -> Column:
    """First match of ``pattern`` inside a code; '' where there is none."""
    return F.regexp_extract(c, pattern, 0)


# Zero and measurements of these sizes are summed as decimals with eight digits after the point.
EXACT_FROM, EXACT_BELOW = 1e-3, 1e13


def _fits(v: Column) -> Column:
    size = F.abs(v.cast("double"))
    return (size < EXACT_BELOW) & ((size >= EXACT_FROM) | (size == 0))


def exact(v: Column) -> Column:
    """Decimal form of an ordinary measurement, so that sums do not depend on the order of the rows."""
    return F.when(_fits(v), v).cast("decimal(22,8)")


def extreme(v: Column) -> Column:
    """What has no place in ``exact``: infinite, NaN, huge and tiny values, as doubles."""
    return F.when(~_fits(v), v.cast("double"))


def total(parts: Column, extremes: Column, digits: int, factor: Column | None = None) -> Column:
    """Rounded double of a sum of ``exact`` parts and the sum of ``extreme`` ones, NULL if there are none.

    Without extremes the sum stays decimal until it is rounded.
    """
    factor = F.lit(1).cast("decimal(9,6)") if factor is None else factor
    mixed = (F.coalesce(parts.cast("double"), F.lit(0.0)) + extremes) * factor.cast("double")
    return F.when(extremes.isNull(), round_half_up(parts * factor, digits)).otherwise(round_half_up(mixed, digits))


def round_half_up(v: Column, digits: int) -> Column:
    """Round on the decimal value, return a double; a value too large to have such digits stays as it is."""
    ordinary = F.abs(v.cast("double")) < 1e26
    return F.when(ordinary, F.round(F.when(ordinary, v).cast("decimal(38,10)"), digits).cast("double")).otherwise(v.cast("double"))


def percent(part: Column, whole: Column, digits: int) -> Column:
    """Rounded percentage; 0 over an empty whole counts as 0."""
    return round_half_up(100.0 * part.cast("double") / F.greatest(whole, F.lit(1)), digits)


def month_start(ts: Column) -> Column:
    return F.trunc(ts, "MM")


def period(ts: Column, grain: str) -> Column:
    """Day as a date, or first instant of the month."""
    if grain == DAILY:
        return F.to_date(ts)
    if grain == MONTHLY:
        return month_start(ts).cast("timestamp_ntz")
    raise ValueError(f"grain must be {DAILY!r} or {MONTHLY!r}, not {grain!r}")


def slots_between(first: Column, last: Column, step_minutes: int = 30) -> Column:
    """Number of slots from the start of the first month to the end of the last one."""
    days = F.datediff(F.last_day(last), month_start(first)) + 1
    return (days * (24 * 60 // step_minutes)).cast("long")


def month_labels(reference: Column, months: int = 6, lag: int = 1) -> Column:
    """Array of the last ``months`` labels ``yyyy_MM``, ending ``lag`` months before the reference."""
    start = month_start(reference)
    span = F.sequence(
        F.add_months(start, -(months + lag - 1)), F.add_months(start, -lag), F.expr("interval 1 month")
    )
    return F.transform(span, lambda m: F.date_format(m, "yyyy_MM"))


def calendar(ts: Column) -> dict[str, Column]:
    """Calendar attributes of an instant; Saturday and Sunday are the weekend."""
    return {
        "ano": F.year(ts).cast("long"),
        "mes": F.month(ts).cast("long"),
        "dia": F.dayofmonth(ts).cast("long"),
        "hora": F.hour(ts).cast("long"),
        "minuto": F.minute(ts).cast("long"),
        "flg_fim_semana": flag((F.dayofweek(ts) - 1).isin(0, 6)),
    }


def all_of(conditions: list[Column]) -> Column:
    """Conjunction of an optional filter list; true if the list is empty."""
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def between(ts: Column, start=None, end=None) -> list[Column]:
    """Optional time bounds, both ends included as instants: an end date means its midnight."""
    bounds = []
    if start is not None:
        bounds.append(ts >= F.lit(str(start)).cast("timestamp_ntz"))
    if end is not None:
        bounds.append(ts <= F.lit(str(end)).cast("timestamp_ntz"))
    return bounds
