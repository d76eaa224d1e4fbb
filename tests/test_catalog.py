"""Every registered query against its SQL on the given tables (TEST_SF_DIR, default sf0.001)."""

import pytest
from support import SF, spark_result, sql_result

from exprspark.catalog import oracles, queries

QUERIES, ORACLES = queries(), oracles()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert spark_result(df) == sql_result(ORACLES[name], SF)
    else:
        assert df.columns
        df.write.format("noop").mode("overwrite").save()
