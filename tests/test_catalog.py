"""Every query against its SQL counterpart on the smallest data folder."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from keepsake.catalog.queries import QUERIES
from tools.check_oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the given test data")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    result = compare(spark, con, name, FOLDER)
    assert result.startswith(("ok", "rows-only")), result


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and len(df.columns) == 53


def test_only_model_queries_lack_sql():
    assert set(QUERIES) - set(entry.oracle_sql()) == {
        "churn_scores", "cv_auc", "feature_importance", "model_report", "shap_importance"
    }
    assert set(entry.oracle_sql()) <= set(entry.queries())
