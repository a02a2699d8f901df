"""Schema contracts: types, nullability, domains and the primary key of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import Contract, FieldRule
from .checks import Check, in_set, not_null, run_checks, unique


def _present(df: DataFrame, name: str, rule: FieldRule) -> str | None:
    return next((c for c in (name, *rule.aliases) if c in df.columns), None)


def _failing(broken: bool):
    """A schema-level failure concerns every row."""
    return F.count(F.lit(1)) if broken else F.lit(0).cast("bigint")


def contract_checks(df: DataFrame, contract: Contract) -> list[Check]:
    """Schema comparison on the driver, value rules as checks."""
    checks: list[Check] = []
    names = {}
    for name, rule in contract.fields.items():
        actual = _present(df, name, rule)
        checks.append(Check("present", name, _failing(actual is None), "CRITICAL"))
        if actual is None:
            continue
        names[name] = actual
        kind = df.schema[actual].dataType.simpleString()
        checks.append(Check(f"type {rule.type}", name, _failing(kind != rule.type), "CRITICAL"))
        if not rule.nullable:
            checks.append(not_null(actual, "CRITICAL"))
        if rule.values:
            checks.append(in_set(actual, rule.values))
    for column in contract.partition_keys:
        checks.append(Check("partition", column, _failing(column not in df.columns), "CRITICAL"))
    key = [names.get(k, k) for k in contract.primary_key]
    if all(k in df.columns for k in key):
        checks.append(unique(*key, severity="CRITICAL"))
    return checks


def validate_contract(df: DataFrame, contract: Contract) -> DataFrame:
    return run_checks(df, contract_checks(df, contract), contract.entity)
