"""Checks on JSON texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_list(body: Column) -> Column:
    """Whether a text starts as a JSON array; a parser would take an object for a list of one."""
    return F.coalesce(body.rlike(r"^\s*\["), F.lit(False))
