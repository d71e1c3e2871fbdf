"""Declared rules and the rows that break them.

A check passes when it is true or unknown. All checks of a table are evaluated in one pass; reports hold
one row per broken rule and key, so their size follows the errors and not the table.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class TableRules:
    """Schema of a table and what must hold in it; ``checks`` maps a rule name to a SQL condition."""

    name: str
    schema: str
    primary_key: tuple[str, ...]
    not_null: tuple[str, ...] = ()
    checks: Mapping[str, str] = field(default_factory=dict)
    foreign_keys: tuple[ForeignKey, ...] = ()

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromDDL(self.schema)


def check_violations(rows: DataFrame, checks: Mapping[str, str], key: list[str]) -> DataFrame:
    """``(rule, key...)`` for every row on which a check is false."""
    broken = [F.when(~F.expr(condition), F.lit(rule)) for rule, condition in checks.items()]
    return rows.select(*key, F.explode(F.array_compact(F.array(*broken))).alias("rule"))


def not_null_violations(rows: DataFrame, columns: list[str], key: list[str]) -> DataFrame:
    """``(column, key...)`` for every empty cell of a required column."""
    empty = [F.when(F.col(c).isNull(), F.lit(c)) for c in columns]
    return rows.select(*key, F.explode(F.array_compact(F.array(*empty))).alias("column"))


def duplicate_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    """Key values that are used more than once or are incomplete, with their row count."""
    incomplete = " or ".join(f"`{c}` is null" for c in key)
    return rows.groupBy(*key).agg(F.count("*").alias("n_rows")).where(f"n_rows > 1 or {incomplete}")


def orphans(child: DataFrame, columns: list[str], parent: DataFrame, parent_columns: list[str]) -> DataFrame:
    """Foreign key values without a parent, with the number of rows that use them.

    A key with an empty column refers to nothing and passes. Values are counted before the join, so a
    value used by most rows reaches it once; so does a parent value that is repeated.
    """
    used = child.dropna(subset=columns).groupBy(*columns).agg(F.count("*").alias("n_rows"))
    targets = parent.select(*[F.col(p).alias(c) for c, p in zip(columns, parent_columns)])
    return used.join(targets.distinct(), columns, "left_anti")


def cast_failures(rows: DataFrame, types: Mapping[str, str], key: list[str]) -> DataFrame:
    """``(column, value, key...)`` for every text that does not fit the declared type."""
    failed = [
        F.when(
            F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(),
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")),
        )
        for c, t in types.items()
    ]
    return rows.select(*key, F.explode(F.array_compact(F.array(*failed))).alias("cell")).select(*key, "cell.*")


def table_report(
    rows: DataFrame, rules: TableRules, tables: Mapping[str, DataFrame], existing: DataFrame | None = None
) -> DataFrame:
    """Everything that is wrong with a table: ``(table, kind, rule, key, n_rows)``.

    Rows that are to be added to ``existing`` are checked alone; only their keys are looked up in it.
    """
    key = list(rules.primary_key)
    key_text = F.to_json(F.struct(*key), {"ignoreNullFields": "false"})

    def lines(found: DataFrame, kind, rule, at, n=F.lit(1).cast("bigint")) -> DataFrame:
        return found.select(
            F.lit(rules.name).alias("table"), kind.alias("kind"), rule.alias("rule"), at.alias("key"), n.alias("n_rows")
        )

    report = lines(duplicate_keys(rows, key), F.lit("primary key"), F.lit(", ".join(key)), key_text, F.col("n_rows"))
    if existing is not None:
        taken = rows.select(key).join(existing.select(key), key, "left_semi")
        report = report.unionByName(lines(taken, F.lit("primary key"), F.lit(", ".join(key)), key_text))
    # Checks and required columns look at single rows: one pass for all of them.
    broken = [
        F.when(~F.expr(condition), F.struct(F.lit("check").alias("kind"), F.lit(rule).alias("rule")))
        for rule, condition in rules.checks.items()
    ] + [
        F.when(F.col(c).isNull(), F.struct(F.lit("not null").alias("kind"), F.lit(c).alias("rule")))
        for c in rules.not_null
    ]
    if broken:
        found = rows.select(*key, F.explode(F.array_compact(F.array(*broken))).alias("found"))
        report = report.unionByName(lines(found, F.col("found.kind"), F.col("found.rule"), key_text))
    for fk in rules.foreign_keys:
        columns = list(fk.columns)
        found = orphans(rows, columns, tables[fk.parent], list(fk.parent_columns))
        rule = F.lit(f"{', '.join(columns)} -> {fk.parent}")
        at = F.to_json(F.struct(*columns))
        report = report.unionByName(lines(found, F.lit("foreign key"), rule, at, F.col("n_rows")))
    return report
