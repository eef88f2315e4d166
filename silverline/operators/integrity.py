"""Keys, references and range rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def orphan_rows(
    child: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str = "id"
) -> DataFrame:
    """Rows whose foreign key has no parent. Rows without a foreign key are no orphans.

    A left-anti join: adaptive execution splits a hot foreign key on the child side.
    """
    parents = parent.select(F.col(parent_key).alias("parent_key_"))
    return child.filter(F.col(foreign_key).isNotNull()).join(
        parents, F.col(foreign_key) == F.col("parent_key_"), "left_anti"
    )


def orphan_keys(
    child: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str = "id"
) -> DataFrame:
    """Missing parents with the number of rows that name them.

    Foreign keys are counted before the join, so a hot key crosses the network once
    per map task, not once per row.
    """
    keys = child.filter(F.col(foreign_key).isNotNull()).groupBy(foreign_key).agg(F.count(F.lit(1)).alias("n_rows"))
    return orphan_rows(keys, foreign_key, parent, parent_key)


def self_orphan_rows(df: DataFrame, parent_column: str = "parent_id", key: str = "id") -> DataFrame:
    """Rows whose parent is not a row of the same table; roots have no parent."""
    return orphan_rows(df, parent_column, df, key)


def duplicate_keys(df: DataFrame, *keys: str, ignore: Sequence[str] = ()) -> DataFrame:
    """Key values that more than one row carries, with their counts."""
    for key in keys if ignore else ():
        df = df.filter(F.col(key).isNull() | ~F.col(key).isin(*ignore))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


@dataclass(frozen=True)
class Rule:
    """A condition on one column.

    ``check`` names the condition: ``min``, ``between``, ``not_null`` or ``decimals``.
    ``policy`` says what is done with a violation: ``flag`` it only, ``nullify`` the
    value, or ``round`` it. Rows are never dropped.
    """

    name: str
    column: str
    check: str
    bounds: tuple[float, ...] = field(default=())
    policy: str = "flag"

    def __post_init__(self) -> None:
        if self.check not in ("min", "between", "not_null", "decimals"):
            raise ValueError(f"unknown check {self.check!r}")
        if self.policy not in ("flag", "nullify", "round"):
            raise ValueError(f"unknown policy {self.policy!r}")
        if (self.policy == "round") != (self.check == "decimals"):
            raise ValueError("the policy 'round' belongs to the check 'decimals'")

    def violated(self, value: Column | None = None) -> Column:
        """True where the rule is broken. Only ``not_null`` judges NULL values."""
        value = F.col(self.column) if value is None else value
        if self.check == "not_null":
            return value.isNull()
        if self.check == "min":
            broken = value < F.lit(self.bounds[0])
        elif self.check == "between":
            broken = ~value.between(*self.bounds)
        else:
            broken = F.round(value, int(self.bounds[0])) != value
        return F.coalesce(broken, F.lit(False))

    def enforced(self, value: Column | None = None) -> Column:
        """The value, repaired unless the rule only flags."""
        value = F.col(self.column) if value is None else value
        if self.policy == "round":
            return F.round(value, int(self.bounds[0]))
        if self.policy == "nullify":
            return F.when(self.violated(value), F.lit(None)).otherwise(value)
        return value


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``{rule}_violated`` per rule and repair the columns whose policy says so.

    Every rule judges the value as it came; repairs of one column follow each other in
    the order of the rules.
    """
    rules = [r for r in rules if r.column in df.columns]
    changes = {f"{r.name}_violated": r.violated() for r in rules}
    for r in rules:
        if r.policy != "flag":
            changes[r.column] = r.enforced(changes.get(r.column))
    return df.withColumns(changes)


def rule_violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows (rule, column, violations, total) from one pass over the table."""
    rules = [r for r in rules if r.column in df.columns]
    counted = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(r.violated()).alias(f"violations_{i}") for i, r in enumerate(rules)],
    )
    lines = [
        F.struct(
            F.lit(r.name).alias("rule"), F.lit(r.column).alias("column"), F.col(f"violations_{i}").alias("violations")
        )
        for i, r in enumerate(rules)
    ]
    return counted.select(F.explode(F.array(*lines)).alias("line"), "total").select("line.*", "total")
