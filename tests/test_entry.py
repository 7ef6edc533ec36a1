"""Every query has SQL, and the cheaper ones are compared here on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from cubagem.queries import QUERIES
from tools.compare import connect, spark_rows, sql_rows

SF_DIR = "/root/testdata/sf0.001"
COMPARED = [
    "flatten_surveys",
    "cube_summary",
    "parse_period_texts",
    "period_conformity",
    "flatten_cube",
    "plan_restricted",
    "normalise_requests",
    "values_by_level",
    "values_of_one_level",
    "stream_progress",
    "manifest",
]

needs_data = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


#: JSON texts of whole cubes, which the tests of documents compare byte by byte.
NO_SQL = {"snapshot_manifest"}


def test_every_query_has_sql():
    assert set(QUERIES) - NO_SQL <= set(entry.oracle_sql()) <= set(entry.queries())


@needs_data
def test_entry(spark):
    assert entry.entry(spark).count() == 10


@needs_data
@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_sql(spark, name):
    assert spark_rows(entry.queries()[name](spark, SF_DIR)) == sql_rows(connect(SF_DIR), entry.oracle_sql()[name])


@needs_data
def test_splits_of_all_levels(spark):
    for name in ("plan_variable_split", "plan_class_split"):
        plan = entry.queries()[name](spark, SF_DIR)
        assert {r[0] for r in plan.select("nivel_territorial").distinct().collect()} > {"N1"}
