"""Row contract: declared rules compiled to one array-of-reasons column."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASONS = "_reasons"


@dataclass(frozen=True)
class Rule:
    """A column's nullability and at most one check; NULL passes the check."""

    column: str
    nullable: bool = False
    ge: float | None = None
    in_range: tuple[float, float] | None = None
    isin: tuple | None = None

    def failures(self) -> list[tuple[str, str]]:
        """(check name, SQL condition that is true on a failing row) in reporting order."""
        c = f"`{self.column}`"
        found = []
        if not self.nullable:
            found.append(("not_nullable", f"{c} IS NULL"))
        if self.ge is not None:
            found.append((f"greater_than_or_equal_to({self.ge})", f"{c} < {self.ge}"))
        if self.in_range is not None:
            low, high = self.in_range
            found.append((f"in_range({low}, {high})", f"{c} NOT BETWEEN {low} AND {high}"))
        if self.isin is not None:
            listed = ", ".join(_literal(v) for v in self.isin)
            found.append((f"isin({list(self.isin)})", f"{c} NOT IN ({listed})"))
        return found


def _literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def with_reasons(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add an array of (column, check) structs, one per failed check, in rule order."""
    failed = ", ".join(
        f"CASE WHEN {cond} THEN named_struct('column', {_literal(rule.column)}, 'check', {_literal(check)}) END"
        for rule in rules
        for check, cond in rule.failures()
    )
    return df.withColumn(REASONS, F.expr(f"filter(array({failed}), r -> r IS NOT NULL)"))


def broken(rules: list[Rule]) -> Column:
    """True on a row that fails any check; cheap, so that reasons are built for failing rows only."""
    conditions = " OR ".join(f"({cond})" for rule in rules for _, cond in rule.failures())
    return F.expr(f"coalesce({conditions}, false)")


def reason_text() -> Column:
    """``column:check`` of every failure, joined by ``; ``."""
    return F.concat_ws("; ", F.transform(REASONS, lambda r: F.concat(r["column"], F.lit(":"), r["check"])))


def split(df: DataFrame, rules: list[Rule], reason: str, stage: str, stage_name: str):
    """(valid rows, rejected rows with their reason and stage)."""
    failing = with_reasons(df.filter(broken(rules)), rules)
    rejected = failing.withColumns({reason: reason_text(), stage: F.lit(stage_name)}).drop(REASONS)
    return df.filter(~broken(rules)), rejected
