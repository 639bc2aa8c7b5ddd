"""Shapes of physical plans that matter at scale."""

import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry.queries()


def plan_of(df):
    mode = df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    return df._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize("name", ["candidate_eval", "candidate_pairs", "cold_start_recs", "negative_sample", "retrain_trigger", "slice_assignment", "unseen_candidates"])
def test_no_cross_joins(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("name", ["last_n_per_user", "per_user_split", "masked_sequences", "serving_sequence", "next_item_recs", "enrich", "precision_recall_at_k"])
def test_groups_are_limited_before_the_shuffle(spark, name):
    limits = [line for line in plan_of(QUERIES[name](spark, SF_DIR)).splitlines() if "WindowGroupLimit" in line]
    assert any("Partial" in line for line in limits)


@pytest.mark.parametrize("name", ["global_split", "tail_holdout"])
def test_splits_are_narrow(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "Window" not in plan and "Exchange rangepartitioning" not in plan


def test_scan_reads_only_what_is_needed(spark):
    plan = plan_of(QUERIES["sequence_stats"](spark, SF_DIR))
    assert "l_discount" not in plan and "l_returnflag" not in plan and "o_totalprice" not in plan


def test_watermark_filter_is_pushed_down(spark, ratings, tmp_path):
    from tidemark.operators.slices import next_slice

    path = str(tmp_path / "r")
    ratings([(1, 1, 4.0, t) for t in range(100)]).write.parquet(path)
    plan = plan_of(next_slice(spark.read.parquet(path), 5, 1))
    assert "GreaterThan(ts,5)" in plan and "LessThan(ts," in plan
