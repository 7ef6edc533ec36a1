"""Constant arrays in one expression each."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def constant_array(values: Iterable[object], kind: str) -> Column:
    """``array<kind>`` of plain constants."""
    items = ", ".join(sql_literal(value) for value in values)
    return F.expr(f"cast(array({items}) AS array<{kind}>)")


def constant_rows(rows: list[tuple], fields: str) -> Column:
    """A constant array of structs, with ``fields`` given as ``name type, name type``."""
    structs = ", ".join(f"struct({', '.join(map(sql_literal, row))})" for row in rows)
    return F.expr(f"cast(array({structs}) AS array<struct<{fields}>>)")
