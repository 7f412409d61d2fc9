"""Every registered query of the library against its SQL, on the smallest tables."""

import pytest

from corpusloom.plans.registry import FLAGSHIP, ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(name, same):
    same(QUERIES[name], ORACLE[name], SF)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_queries_without_sql_give_rows(name, spark):
    assert QUERIES[name](spark, SF).count() > 0


def test_every_sql_has_its_query():
    assert set(ORACLE) <= set(QUERIES) and FLAGSHIP in QUERIES
