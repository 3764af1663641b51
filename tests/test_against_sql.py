"""Every query with a SQL twin gives the same rows on the second engine."""

import pytest

import __spark_entry__ as contract
from check import normal, oracle
from tidegate.operators.features import labelled
from tidegate.operators.training import train_and_evaluate
from tidegate.queries.base import BASELINE, view
from tidegate.sources.tables import partitions

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle(SF_DIR)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_same_rows(spark, con, name):
    df = contract.queries()[name](spark, SF_DIR)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(contract.oracle_sql()[name])
    assert got == normal([d[0] for d in found.description], found.fetchall())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


def test_trained_models_are_sane(spark):
    rows = labelled(partitions(view(spark, "/root/testdata/sf0.01", *BASELINE), *BASELINE))
    _, metrics = train_and_evaluate(rows)
    row = metrics.first()
    assert row["labelled_rows"] == 1016 and row["roc_auc"] > 0.75
