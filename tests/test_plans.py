"""Physical-plan checks: pruning and pushdown reach the Parquet scan, the
hot paths stay JVM-side, and no plan pairs every row with every row."""

import pytest
from pyspark.sql import functions as F

from zonelake.plans import queries as Q
from zonelake.plans.lake import Lake
from zonelake.plans.registry import registered
from zonelake.sources import io


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def written(spark, sf_small, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("zones"))
    lake = Lake(spark, sf_small)
    io.write_processed(lake.processed, f"{root}/processed")
    return root


def test_q4_prunes_partitions_and_pushes_score(spark, written):
    processed = io.read_processed(spark, f"{written}/processed")
    plan = _plan(Q.processed_high_quality(processed, 2024, 1, 15))
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "GreaterThanOrEqual(quality_score,80)" in plan
    assert "TakeOrderedAndProject" in plan


def test_projection_prunes_columns(spark, written):
    processed = io.read_processed(spark, f"{written}/processed")
    plan = _plan(Q.source_quality(processed, 2024, 1))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "ReadSchema: struct<quality_score:int>" in scan


def test_aggregates_combine_map_side(spark, written):
    processed = io.read_processed(spark, f"{written}/processed")
    for df in (Q.records_by_source(processed), Q.quality_by_source(processed, 2024, 1)):
        assert "partial_" in _plan(df)


@pytest.mark.parametrize("name", sorted(registered()))
def test_no_python_udf_and_no_pairing(spark, sf_small, name):
    plan = _plan(registered()[name](spark, sf_small))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"


def test_duplicate_report_broadcasts_only_the_top_k(spark, sf_small):
    df = Q.duplicate_records(Lake(spark, sf_small).processed, 2024, 1, top=100)
    plan = _plan(df)
    # What is broadcast is the limited top-k, never the whole table.
    assert plan.count("BroadcastExchange") == 1
    assert "TakeOrderedAndProject(limit=100" in plan.split("BroadcastExchange")[1][:400]


@pytest.mark.parametrize("name", ["recent_raw", "ingestion_rate_by_hour", "processed_high_quality", "quality_by_source",
                                  "processing_lag", "daily_report", "freshness", "duplicate_records", "raw_by_source",
                                  "source_quality"])
def test_date_predicates_reach_the_scan_as_a_time_range(spark, sf_small, name):
    from zonelake.session import scoped_conf

    with scoped_conf(spark, {"spark.sql.maxMetadataStringLength": "100000"}):
        plan = _plan(registered()[name](spark, sf_small))
    day = name in ("recent_raw", "processed_high_quality")
    start, end = ("2024-01-15", "2024-01-16") if day else ("2024-01-01", "2024-02-01")
    for scan in [line for line in plan.splitlines() if "FileScan parquet" in line]:
        pushed = scan.split("PushedFilters:")[1]
        assert f"GreaterThanOrEqual(ts,{start}T00:00)" in pushed and f"LessThan(ts,{end}T00:00)" in pushed, scan


def test_denormalised_join_does_not_shuffle_the_processed_rows(spark, sf_small):
    plan = _plan(registered()["denormalized"](spark, sf_small))
    assert "BroadcastHashJoin" in plan and "hashpartitioning(source#" not in plan.split("BroadcastExchange")[-1]


def test_cross_run_dedup_prunes_target_partitions(spark, sf_small, written):
    from zonelake.operators import process as P

    existing = io.read_processed(spark, f"{written}/processed")
    batch = P.valid_rows(Lake(spark, sf_small).processed).filter(F.col("ingestion_timestamp") < "2024-01-04")
    from zonelake.session import scoped_conf

    with scoped_conf(spark, {"spark.sql.maxMetadataStringLength": "100000"}):
        plan = _plan(P.exclude_existing(batch, existing))
    target_scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "record_hash" in ln
                   and "event_id" not in ln][0]
    assert "dynamicpruning" in target_scan


def test_failing_records_are_computed_before_the_filter(spark, sf_small):
    """The filter on failed rules reads their column; pushed further down, it
    would evaluate parsing and validation again for every rule."""
    from zonelake.plans.registry import registered

    plan = registered()["quality_failures"](spark, sf_small)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter " in line]
    assert any("failed_rules" in f for f in filters) and not any("variant" in f or "regexp" in f for f in filters)
