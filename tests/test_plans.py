"""Physical plans: shuffles, pruning, no Python, and behaviour under one hot key."""

import re

import pytest
from pyspark.sql import functions as F

from tidewell.operators.latest import latest_per_key
from tidewell.operators.validate import split_by_bounds
from tidewell.functions.bounds import HRV_BOUNDS
from tidewell.plans import gold, silver
from tidewell.plans.pipeline import _shared_user_hash
from tidewell.queries import _QUERIES
from tidewell.sources import sensor_views as views

SF = "/root/testdata/sf0.001"
EAGER = {
    "json_scan_typed", "json_array_split", "gold_incremental", "silver_stream", "gold_stream", "colocated_recovery", "zordered_table", "upsert_single_key", "upsert_composite_key", "table_create_replace", "quarantine_append",
    "gold_from_silver", "recovery_then_vs_now", "compacted_table", "cohort_benchmarks", "level_benchmarks",
    "profile_scan", "late_sensor", "gold_export", "quality_report",
    "performance_tiers", "percent_rank_scaled",
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange hashpartitioning", plan_of(df)))


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.fixture
def stored(spark, workspace):
    hrv, sleep = (silver.clean(raw(spark, SF), feed) for raw, feed in ((views.hrv_raw, silver.HRV), (views.sleep_raw, silver.SLEEP)))
    hrv.write.parquet(f"{workspace}/hrv")
    sleep.write.parquet(f"{workspace}/sleep")
    return spark.read.parquet(f"{workspace}/hrv"), spark.read.parquet(f"{workspace}/sleep")


def test_recovery_from_stored_silver_shuffles_each_side_once(spark, stored, no_broadcast):
    with _shared_user_hash(spark):
        df = gold.daily_recovery(*stored, colocate=True)
        text = plan_of(df)
        assert len(re.findall(r"Exchange", text)) == 2, text
    assert "hrv_sdnn_ms" not in text and "awake_minutes" not in text
    assert "Python" not in text


def test_cleaned_inputs_join_without_another_shuffle(spark, no_broadcast):
    hrv, sleep = (silver.clean(raw(spark, SF), feed) for raw, feed in ((views.hrv_raw, silver.HRV), (views.sleep_raw, silver.SLEEP)))
    joined = gold.recovery_inputs(hrv, sleep)
    assert exchanges(joined) == 4  # two duplicate removals per side
    assert exchanges(gold.daily_recovery(hrv, sleep)) == 5


def test_sleep_metrics_use_one_shuffle_and_one_sort(spark, stored):
    text = plan_of(gold.sleep_metrics(stored[1]))
    assert len(re.findall(r"Exchange", text)) == 1 and len(re.findall(r"\bSort \[", text)) == 1


def test_duplicates_shrink_before_the_shuffle(spark):
    text = plan_of(latest_per_key(views.hrv_raw(spark, SF), "reading_id"))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_date_filter_prunes_partitions(spark, workspace):
    views.hrv_raw(spark, SF).write.partitionBy("date").parquet(workspace)
    text = plan_of(spark.read.parquet(workspace).filter("date >= '2024-01-20'").select("reading_id"))
    assert re.search(r"PartitionFilters: \[[^\]]*date", text)


@pytest.mark.parametrize("name", sorted(set(_QUERIES) - EAGER))
def test_no_python_and_no_product_in_any_plan(spark, name):
    text = plan_of(_QUERIES[name](spark, SF))
    assert "Python" not in text and "CartesianProduct" not in text
    assert "Exchange SinglePartition" not in text or name in {
        # global aggregates, and windows over a handful of already aggregated rows
        "component_correlations", "ols_strain_recovery", "pass_rate", "quality_gate", "quality_gate_summary",
        "recovery_state_distribution", "rejection_rate", "run_stats", "sleep_tier_share", "recovery_last_7d",
        "strain_category_distribution", "recovery_last_30d", "training_phase_means", "user_date_slice", "user_date_uniqueness",
        "sketched_quartiles",
    }


def hot_readings(spark, n=6000):
    """A third of all readings come from one user on one day under one id."""
    return spark.range(n, numPartitions=6).selectExpr(
        "if(id % 3 = 0, 'hot_2024-01-01_hrv', concat('u', id, '_2024-01-01_hrv')) as reading_id",
        "if(id % 3 = 0, 'hot', concat('u', id)) as user_id",
        "'2024-01-01' as date",
        "double(20 + id % 60) as hrv_rmssd_ms",
        "double(90) as hrv_sdnn_ms",
        "double(14) as respiratory_rate_brpm",
        "false as is_anomaly",
        "lpad(string(id), 8, '0') as ingested_at",
        "'run' as _ingestion_run_id",
        "timestamp_ntz'2024-01-01 00:00:00' as _ingest_timestamp",
    )


def test_a_hot_key_leaves_each_map_task_as_one_row(spark):
    seen = latest_per_key(hot_readings(spark), "reading_id")
    rows = seen.collect()
    assert len(rows) == 4001
    hot = [r for r in rows if r.user_id == "hot"]
    assert len(hot) == 1 and hot[0].ingested_at == "00005997"
    shuffled = _shuffle_records(seen)
    assert shuffled <= 4000 + 6


def _shuffle_records(df):
    df.collect()
    pending, found = [df._jdf.queryExecution().executedPlan()], []
    while pending:
        node = pending.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            pending.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            pending.append(node.plan())
            continue
        if name == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        pending += [children.apply(i) for i in range(children.size())]
    return max(found)


def test_cleaning_under_a_hot_user(spark):
    clean = silver.clean(hot_readings(spark), silver.HRV)
    assert clean.count() == 4001
    valid, bad = split_by_bounds(hot_readings(spark).withColumn("hrv_rmssd_ms", F.lit(999.0)), HRV_BOUNDS, "reading_id", "t")
    assert (valid.count(), bad.count()) == (0, 6000)
