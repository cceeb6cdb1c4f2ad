import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from shelfrisk.sources.views import TABLES

FOLDER = "/root/testdata/sf0.001"
# Model training has no SQL counterpart and is covered in test_risk.
TRAINED = {"gbt_cv", "top_importances", "score_batch"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def second_engine():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


def test_every_query_has_a_counterpart():
    # The optional training-data queries have their own tests.
    own = {name for name in entry.queries() if not re.fullmatch(r"op\d+_.*|pipeline", name)}
    assert own - set(entry.oracle_sql()) == TRAINED


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, second_engine, name):
    ours = entry.queries()[name](spark, FOLDER)
    columns = sorted(ours.columns)
    other = second_engine.execute(entry.oracle_sql()[name])
    names = [d[0] for d in other.description]
    assert sorted(names) == columns
    expected = [tuple(row[names.index(c)] for c in columns) for row in other.fetchall()]
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in ours.collect()))) == sorted(map(repr, expected))


def test_entry(spark):
    assert entry.entry(spark).columns == ["item_nbr", "total_units_sold"]
