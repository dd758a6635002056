"""Plan shape: no cross products or nested-loop joins, filters and column
pruning reach the parquet scans, top-k per brand is limited before the shuffle."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
SKIP = {"m1_kmeans", "m2_pca_projection", "m3_train_test_split", "m4_svm_test_predictions", "m4_svm_report",
        "m5_grid_search", "m6_predict_titles", "st1_engagement_stream"}
NAMES = sorted(n for n in E.queries() if n not in SKIP and not n.startswith("op") and n != "pipeline")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_product(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_scan_pruning_and_pushdown(spark):
    plan = _plan(E.queries()["t7_tfidf_documents"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    plan = _plan(E.queries()["a1_engagement_rate"](spark, SF))
    assert "ReadSchema: struct<user_id:bigint,event_type:string,props:string>" in plan


def test_per_brand_topk_limited_before_shuffle(spark):
    plan = _plan(E.queries()["r4_many_brands"](spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_top15_is_take_ordered(spark):
    plan = _plan(E.queries()["r1_rank_category"](spark, SF))
    assert "TakeOrderedAndProject(limit=15" in plan


def test_category_filter_prunes_feature_partitions(spark):
    plan = _plan(E.queries()["r1_rank_category"](spark, SF))
    assert "PartitionFilters: [(lower(trim(category" in plan and "= building)]" in plan
