import pytest

from tidegate.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairs_of_all_rows(spark, name):
    text = QUERIES[name](spark, FOLDER)._jdf.queryExecution().toString()
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
