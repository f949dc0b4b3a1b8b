"""Plan checks over every registered query: no row-at-a-time Python, pandas
only where the similarity kernel runs, no cross join, pruned scans."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

QUERIES = E.queries()
SIMILARITY = {"similar_items", "similar_items_padded", "content_recs_liked", "content_recs_top_item",
              "unseen_candidates", "content_predictions", "content_rating_eval", "content_eval", "jaccard_lists",
              "coverage", "diversity", "novelty", "recommend_content", "compare_algorithms",
              "algorithm_comparison", "saved_content_model"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    if name not in SIMILARITY:
        assert "FlatMapGroupsInPandas" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_is_pruned(spark):
    plan = _plan(QUERIES["top_rated_items"](spark, SF_SMALL))
    assert "l_extendedprice" not in plan and "o_totalprice" not in plan
    assert "PushedFilters" in plan
