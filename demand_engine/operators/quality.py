"""Checks of a table against its declared rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demand_engine.operators.tables import quoted
from demand_engine.schemas import TableRules


class SchemaViolation(ValueError):
    """A table breaks its rules; the message lists every broken one."""


def _entry(column: str, check: str, detail: str, failures: Column) -> Column:
    return F.struct(
        F.lit(column).alias("column"),
        F.lit(check).alias("check"),
        F.lit(detail).alias("detail"),
        failures.cast("bigint").alias("failures"),
    )


def _sql_type(name: str) -> T.DataType:
    return T.DataType.fromDDL(name)


def violations(df: DataFrame, rules: TableRules) -> DataFrame:
    """One row per broken rule: (column, check, detail, failures), read in a single pass.

    Checks are `missing`, `type`, `unreadable` (values that do not fit the declared type, only
    with coercion) and `null`.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    found = []
    for rule in rules.columns:
        if rule.name not in have:
            if not rules.add_missing:
                found.append(_entry(rule.name, "missing", rule.type, F.lit(1)))
            elif not rule.nullable:
                found.append(_entry(rule.name, "null", "added as null", F.count(F.lit(1))))
            continue
        value = quoted(rule.name)
        fits = have[rule.name] == _sql_type(rule.type)
        if not fits and not rules.coerce:
            detail = f"{have[rule.name].simpleString()} is not {rule.type}"
            found.append(_entry(rule.name, "type", detail, F.lit(1)))
        elif not fits:
            bad = F.count_if(value.isNotNull() & value.try_cast(rule.type).isNull())
            found.append(_entry(rule.name, "unreadable", f"not {rule.type}", bad))
        if not rule.nullable:
            found.append(_entry(rule.name, "null", "must have a value", F.count_if(value.isNull())))
    if not found:
        found = [_entry("", "none", "", F.lit(0))]
    return (
        df.agg(F.array(*found).alias("entries"))
        .select(F.inline("entries"))
        .where(F.col("failures") > 0)
    )


def coerce(df: DataFrame, rules: TableRules) -> DataFrame:
    """The declared columns in order and type, absent ones as null, other columns after them."""
    declared = [
        (quoted(r.name).try_cast(r.type) if r.name in df.columns else F.lit(None).cast(r.type))
        .alias(r.name)
        for r in rules.columns
        if r.name in df.columns or rules.add_missing
    ]
    named = rules.types()
    return df.select(declared + [quoted(c) for c in df.columns if c not in named])


def validate(df: DataFrame, rules: TableRules) -> DataFrame:
    """`df`, coerced where the rules say so; raises with the full list when a rule is broken."""
    broken = violations(df, rules).collect()
    if broken:
        raise SchemaViolation(
            "; ".join(f"{r['column']}: {r['check']} ({r['detail']}) x{r['failures']}" for r in broken)
        )
    return coerce(df, rules) if rules.coerce or rules.add_missing else df


def unreadable(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """One row per column holding text that its declared type cannot represent."""
    entries = [
        _entry(c, "unreadable", f"not {t}", F.count_if(
            quoted(c).isNotNull() & quoted(c).try_cast(t).isNull()
        ))
        for c, t in types.items()
        if c in df.columns
    ]
    return (
        df.agg(F.array(*entries).alias("entries"))
        .select(F.inline("entries"))
        .where(F.col("failures") > 0)
    )
