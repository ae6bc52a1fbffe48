"""Every query gives the rows of its SQL."""

import pytest

import __spark_entry__ as entry
from tests.compare import difference

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, name):
    assert difference(entry.queries()[name](spark, SF), SF, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 1500


def test_only_learned_queries_lack_sql():
    without = set(entry.queries()) - set(entry.oracle_sql())
    assert {n for n in without if not n.startswith("op")} <= {"pipeline"}
