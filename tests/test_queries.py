"""Every registered query against its SQL, and the shape of the plans."""

import pytest

import __spark_entry__ as registered
from gleaner import plans
from tools.check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


# distances iterate on Arrow batches; everything else stays in the JVM
ARROW = {
    "geo_feature_matrix", "geo_error", "geo_oof_errors", "pairwise_distance", "places_within_radius", "geo_matrix_model", "geo_sparse_model",
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def plan(spark, name):
    return plan_of(registered.queries()[name](spark, SF))


@pytest.mark.parametrize("name", plans.QUERIES)
def test_query(spark, duck, name):
    result = registered.queries()[name](spark, SF)
    text = plan_of(result)
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "BatchEvalPython" not in text
    assert name in ARROW or "EvalPython" not in text
    good, remark = compare(result, duck, name)
    assert good, remark


def test_entry(spark):
    assert registered.entry(spark).count() > 0


def test_registry():
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_wide_and_sparse_models_agree(spark):
    errors = [
        {r["messid"]: r["error_m"] for r in registered.queries()[name](spark, SF).collect()}
        for name in ("geo_matrix_model", "geo_sparse_model")
    ]
    assert errors[0] == pytest.approx(errors[1], rel=1e-3, abs=1.0)


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "filter_range")
    assert "GreaterThanOrEqual(value,5" in text and "ReadSchema: struct<event_id:bigint,value:double>" in text
    assert "PushedFilters: [In(l_linenumber, [0,1])]" in plan(spark, "filter_isin")


def test_top_k_does_not_sort_everything(spark):
    for name in ("top_keys", "top20_words", "priority_sort_topk", "top_scores"):
        assert "TakeOrderedAndProject" in plan(spark, name), name
