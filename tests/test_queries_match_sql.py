"""Every query with SQL gives the SQL's rows; the cheap others give rows."""

import pytest

import __spark_entry__ as entry
from tools.check_queries import compare, connect

MODEL_QUERIES = {"d9_d10_delivery_models", "d11_cv_mae", "d12_feature_importance", "d13_score",
                 "d14_model_comparison", "r5_risk_models", "r9_risk_factors", "r10_predict", "o1_run_all"}


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, small, con, name):
    got = entry.queries()[name](spark, small).toArrow()
    assert got.num_rows > 0
    assert compare(got, con.sql(entry.oracle_sql()[name]).to_arrow_table()) is None


@pytest.mark.parametrize("name", ["c5_mode_recommendation", "c12_recommendations", "p3_median_fill", "s3_profile"])
def test_matches_sql_on_more_rows(spark, name):
    """Over the small-table limit, so the quantile brackets are at work."""
    bigger = "/root/testdata/sf0.01"
    got = entry.queries()[name](spark, bigger).toArrow()
    assert compare(got, connect(bigger).sql(entry.oracle_sql()[name]).to_arrow_table()) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql()) - MODEL_QUERIES))
def test_gives_rows(spark, small, name):
    assert entry.queries()[name](spark, small).count() > 0


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns[0] == "policy" and out.count() == 4
