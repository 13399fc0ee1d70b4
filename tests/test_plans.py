"""What the plans must look like to hold at a large scale."""

import pytest
from events_cases import bronze_rows

from cairnlake import schemas
from cairnlake.functions import events as ev
from cairnlake.operators import quality, refine, reports, rollups
from cairnlake.plans import registered
from cairnlake.sources.known_ids import KnownIds

SMALL = "/root/testdata/sf0.001"
FILE_BACKED = {"incremental_resume", "stored_repo_daily", "stored_new_rows", "stored_versions", "corrupt_file_guard",
               "streaming_ingest", "streaming_late_counts", "streaming_distinct_events", "partition_scan_compare", "partition_scan_cost", "streaming_hourly_counts",
               "rejected_files", "hours_in_halves", "gold_after_crash", "full_refresh_after_crash", "run_day_twice", "stored_stamps",
               "stored_mixed_schema", "first_records", "first_records_by_type", "check_errors", "check_gate",
               "check_report", "streaming_contributors"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registered.OVER_TABLES) - FILE_BACKED))
def test_no_cross_join_and_no_python_in_any_query(spark, name):
    df = registered.queries()[name](spark, SMALL)
    text = plan_of(df)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "Pandas" not in text
    assert "RoundRobinPartitioning" not in text
    assert "strategy=broadcast" not in df._jdf.queryExecution().analyzed().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("t"))
    bronze = refine.classify(bronze_rows(spark, [{}, {"id": None}]))
    bronze.drop(*ev.PARSED).write.parquet(path + "/bronze")
    refine.silver(bronze).write.partitionBy("event_date").parquet(path + "/silver")
    return path


def test_duplicates_are_cut_before_the_shuffle(spark, stored):
    text = plan_of(refine.silver(spark.read.parquet(stored + "/bronze")))
    above, below = text.split("Exchange", 1)
    assert "WindowGroupLimit" in above and "Partial" in below.split("WindowGroupLimit", 1)[1]
    assert text.count("Exchange") == 1
    # the JSON text itself is not shuffled
    assert "payload" not in below.split("Generate")[0].split("Sort")[0]


def test_quarantine_scan_pushes_its_filter(spark, stored):
    rows = spark.read.schema(schemas.BRONZE_STORED).parquet(stored + "/bronze")
    text = plan_of(refine.quarantine(rows))
    assert "IsNotNull(error_reason)" in text.split("PushedFilters")[1]
    assert "Exchange" not in text


def test_gold_reads_only_what_it_needs_and_pre_aggregates(spark, stored):
    silver = spark.read.schema(schemas.SILVER).parquet(stored + "/silver")
    text = plan_of(rollups.repo_daily(silver))
    columns = text.split("ReadSchema: struct<")[1].split(">")[0]
    assert {c.split(":")[0] for c in columns.split(",")} <= {
        "type", "actor_login", "repo_name", "action", "commit_count"}
    first_exchange = text.rsplit("Exchange hashpartitioning", 1)[1]
    assert "partial_count" in first_exchange and "actor_login" in first_exchange.split("]")[0]


def test_date_filter_prunes_partitions(spark, stored):
    silver = spark.read.schema(schemas.SILVER).parquet(stored + "/silver")
    text = plan_of(reports.full_and_one_day(silver, "2024-01-01"))
    assert "PartitionFilters: [isnotnull(event_date" in text


def test_top_k_is_not_a_full_sort(spark, stored):
    silver = spark.read.schema(schemas.SILVER).parquet(stored + "/silver")
    text = plan_of(reports.top_repo_days(rollups.repo_daily(silver)))
    assert "TakeOrderedAndProject" in text


def test_single_pass_checks_share_one_scan(spark, stored):
    silver = spark.read.schema(schemas.SILVER).parquet(stored + "/silver")
    checks = quality.silver_checks()
    text = plan_of(quality.check_table(silver, "silver", checks, registered.NOW))
    uniqueness = sum(c.metric == "duplicate_count" for c in checks)
    assert text.count("FileScan") == 1 + uniqueness


def test_past_ids_are_not_moved_to_find_new_rows(spark, tmp_path):
    known = KnownIds(spark, str(tmp_path / "ids"), 8)
    for seq, ids in enumerate([["a", "b", None], ["b", "c"], ["d"]], start=1):
        known.add(seq, bronze_rows(spark, [{"id": i} for i in ids]))
    known.add(3, bronze_rows(spark, [{"id": "e"}]))  # a batch that is tried again
    rows = bronze_rows(spark, [{"id": i} for i in ("a", "c", "d", "e", None, None)])
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = known.unseen(rows, 2)
        text = plan_of(found)
        assert text.count("Exchange") == 1 and "Bucketed: true" in text
        assert "Exchange" not in text[text.index("Bucketed: true") - 400 : text.index("Bucketed: true")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert sorted(str(r.id) for r in found.collect()) == ["None", "None", "d", "e"]
    again = KnownIds(spark.newSession(), str(tmp_path / "ids"), 8)
    assert sorted(str(r.id) for r in again.unseen(rows.sparkSession.read.parquet(str(tmp_path / "rows")), 3).collect()) == [
        "None", "None", "d"]
