"""Schema and non-emptiness contracts of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hourgrid.errors import ContractError


def required_columns(df: DataFrame, names: tuple[str, ...] | list[str]) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ContractError(f"missing required columns: {', '.join(missing)}")
    return df


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ContractError("table is empty")
    return df


def fields(schema: T.StructType) -> list[tuple[str, str]]:
    return [(field.name, field.dataType.simpleString()) for field in schema]


def assert_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Names, order and types must be equal; nullability is not compared."""
    if fields(df.schema) != fields(expected):
        raise ContractError(
            f"unexpected schema {df.schema.simpleString()}; "
            f"expected {expected.simpleString()}"
        )
    return df


def assert_fields(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Every expected field must be there with its type; others may follow."""
    present = dict(fields(df.schema))
    for name, kind in fields(expected):
        if present.get(name) != kind:
            raise ContractError(f"field {name!r} must have type {kind}")
    return df
