import json

from events_cases import NOW, bronze_rows
from pyspark.sql import functions as F

from cairnlake import schemas
from cairnlake.operators import refine, rollups

OTHER = "2024-01-01-10.json.gz"


def test_keep_first_inside_each_file(spark):
    bronze = bronze_rows(spark, [
        {"id": "a", "actor_login": "first", "row_pos": 1},
        {"id": "a", "actor_login": "second", "row_pos": 2},
        {"id": "a", "actor_login": "other file", "row_pos": 0, "source_file": OTHER},
        {"id": "None", "row_pos": 3},
        {"id": "None", "row_pos": 4},
    ]).repartition(4)
    rows = refine.silver(refine.classify(bronze), NOW).orderBy("id", "actor_login").collect()
    assert [(r.id, r.actor_login) for r in rows] == [
        ("None", "ann"), ("a", "first"), ("a", "other file")]
    assert refine.silver(refine.classify(bronze), NOW).schema.names == schemas.SILVER.names


def test_keep_first_over_the_whole_table_goes_by_file_hour_not_by_name(spark):
    bronze = bronze_rows(spark, [
        {"id": "a", "actor_login": "hour ten", "row_pos": 0, "source_file": OTHER},
        {"id": "a", "actor_login": "hour nine", "row_pos": 9,
         "source_file": "2024-01-01-9.json.gz"},
    ])
    rows = refine.silver(refine.classify(bronze), NOW, per_file=False).collect()
    assert [r.actor_login for r in rows] == ["hour nine"]


def test_quarantine_keeps_the_whole_row(spark):
    bronze = bronze_rows(spark, [{"id": None, "actor_login": None}, {"payload": "{"}, {}])
    rows = refine.quarantine(refine.classify(bronze), NOW).orderBy("error_reason").collect()
    assert [r.error_reason for r in rows] == ["malformed_payload", "missing_id"]
    record = json.loads(rows[1].raw_record)
    assert set(schemas.BRONZE.names) <= set(record)
    assert record["actor_login"] is None and record["type"] == "PushEvent"
    assert rows[1].raw_id is None


def test_replay_after_a_fix(spark):
    bronze = bronze_rows(spark, [{"type": None}, {"payload": "{"}, {"id": ""}])
    quarantined = refine.quarantine(refine.classify(bronze), NOW)

    def fix(rows):
        return rows.withColumn("type", F.coalesce("type", F.lit("PublicEvent"))).withColumn(
            "payload", F.lit("{}"))

    again = refine.replay(quarantined, fix).select("row_pos", "old_reason", "error_reason")
    assert sorted(map(tuple, again.collect())) == [
        (0, "missing_type", None), (1, "malformed_payload", None), (2, "missing_id", "missing_id")]
    assert refine.silver(refine.replay(quarantined, fix), NOW).count() == 2
    untouched = refine.replay(quarantined).where("old_reason <> error_reason").count()
    assert untouched == 0


def test_audit_balances_also_with_one_id_in_a_third_of_all_rows(spark):
    n = 3000
    rows = [{"id": "hot" if i % 3 == 0 else str(i), "row_pos": i} for i in range(n)]
    rows += [{"id": None, "row_pos": n + i} for i in range(50)]
    classified = refine.classify(bronze_rows(spark, rows).repartition(8))
    audit = refine.balanced(refine.file_audit(classified)).first()
    assert audit.balanced
    assert (audit.bronze_rows, audit.quarantine_rows) == (n + 50, 50)
    assert audit.silver_rows == refine.silver(classified, NOW).count() == 2001
    assert audit.duplicate_rows == 999


def test_audit_counts_a_file_of_rejected_rows_only(spark):
    audit = refine.file_audit(refine.classify(bronze_rows(spark, [{"id": ""}, {"id": None}])))
    assert tuple(audit.first())[1:] == (2, 0, 2, 0, 0)


def test_audit_counts_the_repeated_ids(spark):
    rows = [{"id": "hot" if i % 3 == 0 else str(i % 700), "row_pos": i, "actor_login": f"u{i}",
             "source_file": OTHER if i % 5 else "2024-01-01-0.json.gz"} for i in range(2000)]
    rows += [{"id": None, "row_pos": 2000 + i} for i in range(5)]
    classified = refine.classify(bronze_rows(spark, rows).repartition(6))
    repeated = refine.repeated_ids(classified).count()
    audit = refine.file_audit(classified)
    assert audit.agg(F.sum("repeated_ids")).first()[0] == repeated > 2


def test_gold_counts_are_never_null(spark):
    bronze = bronze_rows(spark, [
        {"type": "PullRequestEvent", "payload": "{}"},
        {"type": "PullRequestEvent", "payload": '{"action":"opened"}', "repo_name": "org/b",
         "actor_login": None},
        {"type": "PushEvent", "payload": '{"size":"n/a"}', "repo_name": "org/b"},
        {"type": "WatchEvent", "repo_name": None},
        {"type": "ForkEvent", "repo_name": ""},
    ])
    silver = refine.silver(refine.classify(bronze), NOW)
    repos = {r.repo_name: r for r in rollups.repo_daily(silver, NOW).collect()}
    assert set(repos) == {"org/a", "org/b", ""}
    assert (repos["org/a"].pr_opened, repos["org/a"].total_commits) == (0, 0)
    assert (repos["org/b"].pr_opened, repos["org/b"].unique_contributors) == (1, 1)
    assert repos[""].forks == 1
    actors = {r.actor_login: r for r in rollups.actor_daily(silver).collect()}
    assert set(actors) == {"ann"}
    assert (actors["ann"].repos_touched, actors["ann"].total_events) == (3, 4)
    assert (actors["ann"].pr_count, actors["ann"].push_count) == (1, 1)


def test_repo_days_add_up_to_silver(spark):
    rows = [{"repo_name": f"org/{i % 5}" if i % 7 else None, "actor_login": f"u{i % 11}"}
            for i in range(500)]
    silver = refine.silver(refine.classify(bronze_rows(spark, rows)), NOW)
    total = rollups.repo_daily(silver).agg(F.sum("total_events")).first()[0]
    assert total == silver.where("repo_name IS NOT NULL").count()


def test_presented_order(spark):
    silver = refine.silver(refine.classify(bronze_rows(spark, [
        {"repo_name": "b"}, {"repo_name": "a"}, {"repo_name": "c"}, {"repo_name": "c"}])), NOW)
    got = [r.repo_name for r in rollups.presented(rollups.repo_daily(silver)).collect()]
    assert got == ["c", "a", "b"]


def test_sketches_merge_to_what_one_pass_gives_and_stay_within_their_bound(spark):
    rows = spark.range(60_000).selectExpr(
        "DATE '2024-01-01' AS event_date", "concat('org/r', id % 2) AS repo_name",
        "IF(id % 7 = 0, NULL, concat('u', id % 40000)) AS actor_login", "id % 5 AS batch")
    nobody = rows.selectExpr("event_date", "'org/none' AS repo_name", "CAST(NULL AS STRING) AS actor_login", "batch")
    rows = rows.union(nobody.limit(3)).union(rows.selectExpr("event_date", "NULL", "actor_login", "batch").limit(3))
    kept = rollups.contributor_sketches(rows, "batch")
    merged = {r.repo_name: r.approx_contributors for r in
              rollups.estimated(rollups.merged_sketches(kept)).collect()}
    at_once = {r.repo_name: r.approx_contributors for r in
               rollups.estimated(rollups.contributor_sketches(rows)).collect()}
    exact = {r.repo_name: r.n for r in rows.where("repo_name IS NOT NULL").groupBy("repo_name").agg(
        F.count_distinct("actor_login").alias("n")).collect()}
    assert set(merged) == set(at_once) == set(exact) and exact["org/none"] == 0
    for repo, n in exact.items():
        assert abs(merged[repo] - n) <= rollups.SKETCH_BOUND * n
        assert abs(at_once[repo] - n) <= rollups.SKETCH_BOUND * n
