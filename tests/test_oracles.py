from __future__ import annotations

import pytest
from oracle import compare

from loamline.plans import registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, data, name):
    compare(spark, registry.queries()[name], registry.oracle_sql()[name], data)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql()) - {"p4_imputed"}))
def test_other_queries_run(spark, data, name):
    assert registry.queries()[name](spark, data).count() >= 0
