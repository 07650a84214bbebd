"""Every registered query against its DuckDB oracle (the driver's gate, run
here on sf0.001 to stay quick; ``check_oracles.py`` runs sf0.01)."""
import os

import pytest

import __spark_entry__ as entry
from harness import compare, duck
from quire.plans import registry

SF = os.environ.get("QUIRE_TEST_SF", "/root/testdata/sf0.001")
entry.queries()                       # loads every module that registers queries
QUERIES = dict(registry.QUERIES)
ORACLES = dict(registry.ORACLES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    fn = QUERIES[name]
    if name in ORACLES:
        r = compare(spark, name, fn, ORACLES[name], SF, con)
        assert r["ok"], r
    else:
        assert fn(spark, SF).count() >= 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "reason" in df.columns


def test_every_query_has_a_name_of_its_operator():
    for name in QUERIES:
        assert "_" in name and not name.startswith("op")
