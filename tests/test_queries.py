"""Every registered query against its SQL counterpart."""

import os

import pytest
from compare import connect, difference

import __spark_entry__ as contract
from pitchline.plans.oracle import ORACLE
from pitchline.plans.registry import QUERIES

SMALL = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"

needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")

# No bucket has a full squad in the small tables.
FULL_SQUADS = ("formation_check", "player_mean_chemistry", "team_strength", "win_prediction")


@needs_data
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    sf_dir = LARGER if name in FULL_SQUADS else SMALL
    df = QUERIES[name](spark, sf_dir)
    assert difference(df, connect(sf_dir), ORACLE[name]) is None


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= contract.queries().keys() and ORACLE.keys() <= contract.oracle_sql().keys()


@needs_data
def test_entry(spark):
    assert contract.entry(spark).count() > 0
