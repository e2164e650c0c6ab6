import pytest

import __spark_entry__ as spark_entry
from tests.compare import mismatch

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", spark_entry.queries())
def test_query_equals_its_sql(spark, name):
    assert mismatch(spark, SF_DIR, name) is None


def test_entry_has_rows(spark):
    assert spark_entry.entry(spark).count() > 0


def test_sql_names_are_queries():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())
