import datetime as dt
import random

import pytest
from events_cases import NOW, UTC, event, write_hour, write_part
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairnlake import schemas
from cairnlake.functions import events as ev
from cairnlake.operators import history, quality, refine, reports
from cairnlake.plans import ingest
from cairnlake.sources import lake as storage
from cairnlake.sources import raw
from cairnlake.sources.lake import Lake
from cairnlake.streaming import files


def hour_lines(day, hour, n=20):
    rng = random.Random(day * 100 + hour)
    types = ev.EVENT_TYPES
    lines = [
        event(f"{day}-{hour}-{i}", rng.choice(types), f"u{rng.randrange(5)}",
              f"org/r{rng.randrange(4)}", day, hour)
        for i in range(n)
    ]
    return lines + [lines[0], {**lines[1], "id": None}, "{broken"]


@pytest.fixture
def raw_root(tmp_path):
    root = tmp_path / "raw"
    for day in (1, 2):
        for hour in (0, 1, 23):
            write_hour(root, day, hour, hour_lines(day, hour))
    return root


def ledger_of(lake):
    rows = lake.ledger().where("status = 'done'").orderBy("source_file").collect()
    return [(r.source_file, r.bronze_rows, r.silver_rows, r.quarantine_rows, r.duplicate_rows)
            for r in rows]


EXPECTED = sorted(
    (f"2024-01-0{d}-{h}.json.gz", 23, 20, 2, 1) for d in (1, 2) for h in (0, 1, 23))


def test_run_then_nothing_left_to_do(spark, tmp_path, raw_root):
    lake = Lake(spark, str(tmp_path / "lake"))
    assert lake.silver().count() == 0  # no table yet: typed and empty
    assert ingest.run(lake, str(raw_root), run_at=NOW) == 1
    assert ledger_of(lake) == EXPECTED
    assert lake.bronze().count() == 138
    assert lake.silver().schema.names == schemas.SILVER.names
    assert lake.silver().count() == 120
    reasons = {r.error_reason: r.n for r in
               reports.counts_by(lake.quarantine(), "error_reason").collect()}
    assert reasons == {"missing_id": 6, "malformed_record": 6}
    gold = lake.gold("repo_daily")
    assert gold.agg(F.sum("total_events")).first()[0] == 120
    assert ingest.run(lake, str(raw_root), run_at=NOW) == 0
    assert ledger_of(lake) == EXPECTED


def test_the_first_part_by_name_wins_however_large_the_others(spark, tmp_path):
    hour = tmp_path / "raw" / "2024-01-01-5.json.gz"
    for part, lines in enumerate([[event("x", login="first")],
                                  [event("x", login="later"), *hour_lines(1, 5, 3000)]]):
        write_hour(hour, 2, part, lines).rename(hour / f"part-{part}.gz")
    lake = Lake(spark, str(tmp_path / "lake"))
    ingest.run(lake, str(tmp_path / "raw"), run_at=NOW)
    assert [r.actor_login for r in lake.silver().where("id = 'x'").collect()] == ["first"]


def test_a_download_under_way_is_not_an_hour(spark, tmp_path, raw_root):
    (raw_root / "2024-01-03-0.json.gz.tmp").write_bytes(b"\x1f\x8b half of a file")
    (raw_root / "2024-01-03-1.json.gz").write_bytes(b"")
    lake = Lake(spark, str(tmp_path / "lake"))
    ingest.run(lake, str(raw_root), run_at=NOW)
    assert ledger_of(lake) == EXPECTED
    rejected = lake.ledger().where("status = 'rejected'").collect()
    assert [(r.source_file, r.reason) for r in rejected] == [
        ("2024-01-03-1.json.gz", "empty file")]
    write_hour(raw_root, 3, 0, hour_lines(3, 0))  # the finished file
    assert ingest.run(lake, str(raw_root), run_at=NOW) == 1
    assert lake.silver().count() == 140


def test_versions_of_one_run_have_times_of_their_own(spark, tmp_path, raw_root):
    lake = Lake(spark, str(tmp_path / "lake"))
    ingest.ingest_pending(lake, str(raw_root), files_per_batch=3)
    stamps = [r.committed_at for r in
              history.versions(lake.ledger()).orderBy("batch_seq").collect()]
    assert len(stamps) == 2 and stamps[0] < stamps[1]


def test_one_version_per_file(spark, tmp_path, raw_root):
    lake = Lake(spark, str(tmp_path / "lake"))
    assert ingest.ingest_pending(lake, str(raw_root), run_at=NOW, files_per_batch=1) == 6
    committed = history.versions(lake.ledger())
    rows = history.version_history(committed, bucket_size=4).orderBy("idx").collect()
    assert [(r.idx, r.batch_seq, r.total_rows) for r in rows] == [
        (i, i + 1, 20 * (i + 1)) for i in range(6)]
    assert lake.silver(version=2).count() == 40
    assert lake.silver(version=99).count() == 120
    flagged = history.growth({"silver": committed}, limit=5).first()
    assert (flagged.versions, flagged.current_rows, flagged.needs_expiry) == (6, 120, True)
    # files go in by day and hour, not by name
    first = lake.ledger().where("batch_seq = 3").first().source_file
    assert first == "2024-01-01-23.json.gz"


def test_crashed_batch_is_invisible_and_replaced(spark, tmp_path, raw_root):
    lake = Lake(spark, str(tmp_path / "lake"))
    ingest.run_day(lake, str(raw_root), "2024-01-01", NOW)
    before = lake.silver().count()
    paths = [str(p) for p in raw_root.glob("2024-01-02-*")]
    ingest.stage_batch(lake, lake.last_seq() + 1, raw.read_lines(spark, paths), NOW)
    # all three tables are written, the ledger is not: nobody sees the rows
    assert lake.silver().count() == before == 60
    assert lake.bronze().count() == 69 and lake.quarantine().count() == 6
    # the resumed run takes fewer files in its batch, and no stray rows remain
    assert ingest.run(lake, str(raw_root), run_at=NOW, files_per_batch=2) == 2
    assert ledger_of(lake) == EXPECTED
    assert lake.silver().count() == 120
    assert lake.silver().select("id").distinct().count() == 120


@pytest.mark.parametrize("check_first", [False, True])
def test_corrupt_files_are_rejected_and_retried(spark, tmp_path, raw_root, check_first):
    bad = raw_root / "2024-01-01-1.json.gz"
    data = bad.read_bytes()
    bad.write_bytes(data[:100])
    write_hour(raw_root, 2, 5, [])  # valid gzip without a single record
    lake = Lake(spark, str(tmp_path / "lake"))
    ingest.run(lake, str(raw_root), run_at=NOW, check_first=check_first)
    assert ledger_of(lake) == [e for e in EXPECTED if e[0] != bad.name]
    rejected = {r.source_file: r.reason for r in
                lake.ledger().where("status = 'rejected'").collect()}
    assert set(rejected) == {bad.name, "2024-01-02-5.json.gz"}
    assert rejected["2024-01-02-5.json.gz"] in ("no records", "empty file")
    bad.write_bytes(data)
    ingest.run(lake, str(raw_root), run_at=NOW)
    assert ledger_of(lake) == EXPECTED
    assert lake.silver().count() == 120


def test_zero_byte_file_of_a_requested_day_is_rejected(spark, tmp_path, raw_root):
    (raw_root / "2024-01-01-9.json.gz").write_bytes(b"")
    lake = Lake(spark, str(tmp_path / "lake"))
    ingest.run_day(lake, str(raw_root), "2024-01-01", NOW)
    rejected = lake.ledger().where("status = 'rejected'").collect()
    assert [(r.source_file, r.reason) for r in rejected] == [
        ("2024-01-01-9.json.gz", "empty file")]
    assert lake.silver().count() == 60


def test_other_failures_are_not_taken_for_corrupt_files(spark, tmp_path, raw_root, monkeypatch):
    lake = Lake(spark, str(tmp_path / "lake"))

    def full(*_):
        raise OSError("storage is full")

    monkeypatch.setattr(lake, "write_batch", full)
    with pytest.raises(OSError):
        ingest.run(lake, str(raw_root), run_at=NOW)
    assert lake.ledger().count() == 0


def test_gold_of_touched_dates_equals_a_full_recompute(spark, tmp_path, raw_root):
    lake = Lake(spark, str(tmp_path / "lake"))
    ingest.run_day(lake, str(raw_root), "2024-01-01", NOW)
    # a late file of the second day also carries an event of the first
    write_hour(raw_root, 2, 7, [event("late", "ForkEvent", day=1, hour=3)])
    ingest.run(lake, str(raw_root), run_at=NOW)
    partial = {t: sorted(map(str, lake.gold(t).collect())) for t in storage.REPLACED}
    ingest.refresh_gold(lake, run_at=NOW)
    assert partial == {t: sorted(map(str, lake.gold(t).collect())) for t in storage.REPLACED}


def test_unreadable_event_time_reaches_gold_too(spark, tmp_path):
    root = tmp_path / "raw"
    write_hour(root, 1, 0, [event("1"), {**event("2"), "created_at": "never"}])
    lake = Lake(spark, str(tmp_path / "lake"))
    ingest.run(lake, str(root), run_at=NOW)
    rows = lake.gold("repo_daily").orderBy("event_date").collect()
    assert [str(r.event_date) for r in rows] == ["None", "2024-01-01"]


def test_full_refresh_switches_only_at_the_end(spark, tmp_path, raw_root):
    lake = Lake(spark, str(tmp_path / "lake"))
    ingest.run(lake, str(raw_root), run_at=NOW)
    (raw_root / "2024-01-02-23.json.gz").unlink()
    fresh = ingest.full_refresh(lake, str(raw_root), NOW)
    assert fresh.generation == lake.generation + 1
    assert lake.silver().count() == 120  # the old generation is untouched
    assert Lake(spark, str(tmp_path / "lake")).silver().count() == 100


def test_added_column(spark, tmp_path, raw_root, monkeypatch):
    lake = Lake(spark, str(tmp_path / "lake"))
    ingest.run_day(lake, str(raw_root), "2024-01-01", NOW)
    assert lake.add_column("silver", "is_bot", T.BooleanType())
    assert not lake.add_column("silver", "is_bot", T.BooleanType())  # idempotent
    old = lake.silver()
    assert old.where("is_bot IS NULL").count() == old.count() == 60
    # a writer that does not know the column goes on working
    ingest.run_day(lake, str(raw_root), "2024-01-02", NOW)
    assert lake.silver().where("is_bot IS NULL").count() == 120
    # one that does, fills it
    plain = refine.silver
    monkeypatch.setattr(refine, "silver", lambda *a, **k: reports.flag_bots(plain(*a, **k)))
    write_hour(raw_root, 3, 0, [event(f"demo{i}", login=x, day=3) for i, x in enumerate(
        ["ci[bot]", "x-bot", "ann"])])
    ingest.run_day(lake, str(raw_root), "2024-01-03", NOW)
    found = lake.silver().where(ev.starts_with(F.col("id"), "demo"))
    assert sorted(r.is_bot for r in found.collect()) == [False, True, True]


def test_version_comparison_over_stored_batches(spark, tmp_path, raw_root):
    lake = Lake(spark, str(tmp_path / "lake"))
    ingest.run_day(lake, str(raw_root), "2024-01-01", dt.datetime(2024, 1, 2, tzinfo=UTC))
    ingest.run_day(lake, str(raw_root), "2024-01-02", dt.datetime(2024, 1, 3, tzinfo=UTC))
    committed = history.versions(lake.ledger())
    assert history.choose_version(committed) == 1
    assert history.choose_version(committed, as_of="2024-01-03T01:30:00+02:00") == 1
    assert history.choose_version(committed, as_of="2024-01-03T00:00:00") == 2
    assert history.choose_version(committed, version=2) == 2
    with pytest.raises(history.NoSuchVersion):
        history.choose_version(committed, as_of="2023-12-31")
    with pytest.raises(history.NoSuchVersion):
        history.choose_version(committed, version=7)
    table = lake.versioned("silver")
    delta = history.row_delta(table, 1).first()
    assert (delta.before_rows, delta.after_rows, delta.percent) == (60, 120, 100.0)
    new = history.rows_since(table, 1)
    assert new.count() == 60 == history.new_rows(lake.silver(1), lake.silver()).count()
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "batch_seq" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_reports_over_the_lake(spark, tmp_path, raw_root):
    lake = Lake(spark, str(tmp_path / "lake"))
    ingest.run_day(lake, str(raw_root), "2024-01-01", NOW)
    days = reports.date_range(spark, "2024-01-01", "2024-01-02")
    assert reports.missing_hours(days, lake.ledger()).count() == 45
    status = reports.file_status(days, lake.ledger())
    assert status.count() == 48 and status.where("status = 'done'").count() == 3
    fresh = reports.freshness_by_day(lake.ledger(), NOW + dt.timedelta(hours=30)).collect()
    assert [(r.files_done, r.hours_ago, r.status) for r in fresh] == [(3, 30, "Stale")]
    per_table = reports.storage(lake.files(), F.regexp_extract("path", r"gen=\d+/(\w+)/", 1))
    names = {r.table_name for r in per_table.collect()}
    assert names == {
        "bronze", "silver", "quarantine", "repo_daily", "actor_daily", "ledger", "gold_marks"}
    total = reports.storage_total(per_table).first()
    assert total.bytes > 0 and abs(total.monthly_cost - total.bytes / 2**30 * 0.023) < 1e-12
    ingest.run_day(lake, str(raw_root), "2024-01-02", NOW)
    path = lake.path("silver")
    stored = spark.read.schema(schemas.plus(schemas.SILVER, "batch_seq BIGINT")).parquet(path)
    whole = reports.scan_cost(stored).first()
    one = reports.scan_cost(stored.where("event_date = DATE '2024-01-01'")).first()
    assert one.rows_scanned == 60 and whole.rows_scanned == 120
    assert one.files_read < whole.files_read and one.bytes_read < whole.bytes_read
    measured = reports.measured_scans(stored, "2024-01-01").collect()
    assert [(m.scan, m.rows_scanned) for m in measured] == [("full", 120), ("one_day", 60)]
    assert reports.ledger_totals(lake.ledger()).first().silver_rows == 120
    assert lake.head("silver", 5, version=1).count() == 5
    totals = reports.table_totals({"silver": lake.silver(), "gold": lake.gold("repo_daily")})
    assert totals.where("table_name = 'silver'").first().n == 120


def test_checks_over_the_lake(spark, tmp_path, raw_root):
    lake = Lake(spark, str(tmp_path / "lake"))
    ingest.run(lake, str(raw_root), run_at=NOW)
    results = ingest.check_lake(lake, NOW)
    failing = {r.check_name for r in results.where("outcome = 'fail'").collect()}
    assert "event id not null" in failing and "event id unique in bronze" in failing
    assert not any("silver" in f or "gold" in f for f in failing)
    assert spark.read.parquet(lake.checks_path).count() == 47
    with pytest.raises(quality.QualityGateError):
        quality.gate(results, max_failures=0)


def test_stream_and_batch_ingest_agree(spark, tmp_path, raw_root):
    lake = Lake(spark, str(tmp_path / "lake"))
    checkpoint = str(tmp_path / "checkpoint")
    files.start_ingest(lake, str(raw_root), checkpoint, max_files=4).awaitTermination()
    assert ledger_of(lake) == EXPECTED
    assert lake.gold("repo_daily").agg(F.sum("total_events")).first()[0] == 120
    # the stream's progress is lost: all files come again and are skipped
    again = str(tmp_path / "checkpoint2")
    files.start_ingest(lake, str(raw_root), again, max_files=4).awaitTermination()
    assert ledger_of(lake) == EXPECTED and lake.silver().count() == 120


def test_stream_keeps_an_hour_of_several_parts_whole(spark, tmp_path):
    hour = tmp_path / "raw" / "2024-01-01-5.json.gz"
    for part in range(3):
        write_hour(hour, 1, part, [event(f"{part}")]).rename(hour / f"part-{part}.gz")
    lake = Lake(spark, str(tmp_path / "lake"))
    files.start_ingest(
        lake, str(tmp_path / "raw"), str(tmp_path / "chk"), max_files=1, with_gold=False
    ).awaitTermination()
    assert ledger_of(lake) == [("2024-01-01-5.json.gz", 3, 3, 0, 0)]


def test_catalog_tables(spark, tmp_path):
    where = str(tmp_path / "cat")
    storage.ensure_namespace(spark, "cairn_test", where)
    for _ in range(2):
        storage.ensure_table(
            spark, "cairn_test.repo_daily", schemas.REPO_DAILY, f"{where}/t", ["event_date"])
    rows = storage.describe_table(spark, "cairn_test.repo_daily").collect()
    assert len(rows) == 12 and rows[-1].column_name == "event_date"
    assert schemas.describe(schemas.REPO_DAILY)[:2] == [
        (1, "event_date", "date", True), (2, "repo_name", "string", True)]
    storage.drop_table(spark, "cairn_test.repo_daily")
    storage.drop_table(spark, "cairn_test.repo_daily")
    assert not spark.catalog.tableExists("cairn_test.repo_daily")


def test_gold_owed_by_a_crashed_run_is_made_up_for(spark, tmp_path, raw_root):
    lake = Lake(spark, str(tmp_path / "lake"))
    ingest.ingest_pending(lake, str(raw_root), run_at=NOW)  # and no gold: the run died
    assert ingest.run(lake, str(raw_root), run_at=NOW) == 0
    whole = lake.gold("repo_daily").agg(F.sum("total_events")).first()[0]
    assert whole == lake.silver().where("repo_name IS NOT NULL").count()
    assert lake.gold_seq() == lake.last_seq() and not ingest.owed_gold(lake)


def test_full_refresh_after_a_crashed_one(spark, tmp_path, raw_root):
    lake = Lake(spark, str(tmp_path / "lake"))
    ingest.run(lake, str(raw_root), run_at=NOW)
    crashed = lake.next_generation()
    ingest.ingest_pending(crashed, str(raw_root), run_at=NOW)
    fresh = ingest.full_refresh(lake, str(raw_root), run_at=NOW)
    assert fresh.generation > crashed.generation
    assert fresh.gold("actor_daily").count() == lake.gold("actor_daily").count() > 0


def test_an_hour_waits_for_the_parts_it_states(spark, tmp_path):
    """Half landed it stays pending; whole it is read once. A count that is no number never fits."""
    whole, half, odd = (tmp_path / "raw" / f"2024-01-01-{h}.json.gz" for h in (0, 1, 2))
    for hour, place, parts in ((0, whole, 1), (1, half, 1), (2, odd, 1)):
        for part in range(parts):
            write_part(place, part, hour_lines(1, hour))
    (half / raw.PART_COUNT).write_text("2\n")
    (odd / raw.PART_COUNT).write_text("all\n")
    lake = Lake(spark, str(tmp_path / "lake"))
    options = {"run_at": NOW, "part_counts": True}
    assert ingest.run(lake, str(tmp_path / "raw"), **options) == 1
    assert [r[0] for r in ledger_of(lake)] == [whole.name]
    assert ingest.run(lake, str(tmp_path / "raw"), **options) == 0
    write_part(half, 1, [event("late", "PushEvent", "u1", "org/r1", 1, 1)])
    (odd / raw.PART_COUNT).write_text("1\n")
    assert ingest.run_day(lake, str(tmp_path / "raw"), "2024-01-01", **options) == 1
    assert [r[:2] for r in ledger_of(lake)] == [(whole.name, 23), (half.name, 24), (odd.name, 23)]
    assert ingest.run(lake, str(tmp_path / "raw"), **options) == 0
