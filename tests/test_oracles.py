"""Every registered query against its DuckDB oracle (the driver's gate), at sf0.001."""

import pytest

import __spark_entry__ as E
from gtfsforge.plans.verify import compare, duck_connect

from conftest import SF_SMALL

# the library's own queries; those of optional subpackages have tests of their own
QUERIES = {k: v for k, v in E.queries().items() if k.startswith("q_")}
SQL = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF_SMALL)


def test_every_query_is_registered_with_a_callable():
    assert len(QUERIES) >= 50
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    r = compare(QUERIES[name](spark, SF_SMALL), SQL[name], duck)
    assert r["schema_match"], (r["spark_cols"], r["duck_cols"])
    assert r["ok"], {k: r.get(k) for k in ("spark_rows", "duck_rows", "only_spark", "only_duck")}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["trip_id", "arrival_time", "departure_time", "stop_id", "stop_headsign", "stop_sequence",
                          "pickup_type", "drop_off_type"]
