"""Plan guards: no registered query plans a Cartesian product or a
broadcast nested-loop join (no cross joins, no all-pairs), neither in its
result nor in a job that runs while it is built, and the flagship query's scans
read only the columns it needs."""

import pytest

from tests.conftest import SF_SMALL

import __spark_entry__ as E

MODEL_FITS = {"L3_boosted_trees", "L3_boosted_nodes", "L4_grid_search", "L5_undersampled_ensemble",
              "L5_undersampled_ten_to_one", "L7_isolation_forest", "P12_model_rules", "L9_one_class_boundary",
              "L12_als_fit", "L13_als_tune", "L14_recommend_top", "L14_search_report", "L15_export_factors",
              "L16_text_classifier", "L16_mean_vector_classifier", "Q7_affinity_job", "S8_save_load_model"}
QUERIES = E.queries()


# the training-data queries run jobs over whole texts when they are built; their own tests cover them
PLANNED = {k for k in QUERIES if k not in MODEL_FITS and not k.startswith(("op", "pipeline"))}


def plans_since(spark, last: int) -> list[tuple[int, str]]:
    """(number, plan) of the executions that this session has run after ``last``."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    ran = spark._jsparkSession.sharedState().statusStore().executionsList()
    return [(e.executionId(), e.physicalPlanDescription()) for e in (ran.apply(i) for i in range(ran.size())) if e.executionId() > last]


@pytest.mark.parametrize("name", sorted(PLANNED))
def test_no_cross_join_in_plan(spark, name):
    last = max((k for k, _ in plans_since(spark, -1)), default=-1)
    plans = [QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()]
    plans += [p for _, p in plans_since(spark, last)]
    assert not [p for p in plans if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p]


def test_the_guard_sees_jobs_that_run_meanwhile(spark):
    last = max((k for k, _ in plans_since(spark, -1)), default=-1)
    spark.range(3).crossJoin(spark.range(2).withColumnRenamed("id", "b")).count()
    assert any("NestedLoopJoin" in p or "CartesianProduct" in p for _, p in plans_since(spark, last))


def test_flagship_scans_are_pruned(spark):
    plan = E.entry(spark)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan
    assert "l_comment" not in plan and "l_shipdate" not in plan
