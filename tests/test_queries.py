import os
import re

import pandas as pd
import pytest
from compare import differences, sql_session

import __spark_entry__ as contract

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return sql_session(FOLDER)


def test_every_query_has_sql():
    # queries of the separate subpackage are tested beside it
    own = {name for name in QUERIES if not re.match(r"op\d+_|pipeline$", name)}
    assert own - set(SQL) == set()
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    expected = con.execute(SQL[name]).df()
    assert differences(QUERIES[name](spark, FOLDER).toPandas(), expected) == []


def test_comparison_notices_a_difference():
    a = pd.DataFrame({"x": [1, 2], "y": [0.5, 0.25]})
    assert differences(a, a.iloc[::-1]) == []
    assert differences(a, a.assign(y=[0.5, 0.26])) != []
    assert differences(a, a.assign(x=[1.0, 2.0])) != []
    assert differences(a, a.head(1)) != []


def test_regression_beats_the_majority(spark):
    out = QUERIES["lr_intent"](spark, FOLDER).toPandas()
    majority = (out.lang == out.lang.mode()[0]).mean()
    assert (out.lang == out.intent).mean() > max(0.9, majority)


def test_entry_gives_rows(spark):
    assert contract.entry(spark).count() > 0


def test_scores_of_the_distribution_are_made_once(spark):
    plan = QUERIES["lr_distribution"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
