"""Raw files to committed batches, and gold from silver."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from cairnlake import schemas
from cairnlake.functions import events as ev
from cairnlake.operators import quality, refine, reports, rollups
from cairnlake.sources import raw
from cairnlake.sources.lake import Lake, run_stamp

# Names of one batch's files pass through the driver, as they do in any file read.
FILES_PER_BATCH = 10_000


class UnbalancedBatch(RuntimeError):
    pass


# ---- one batch --------------------------------------------------------------


class FileCounts(NamedTuple):
    source_file: str
    bronze_rows: int
    silver_rows: int
    quarantine_rows: int
    duplicate_rows: int

    @property
    def balanced(self) -> bool:
        return self.bronze_rows == self.silver_rows + self.quarantine_rows + self.duplicate_rows


def stage_batch(
    lake: Lake, seq: int, lines: DataFrame, run_at: dt.datetime
) -> list[FileCounts]:
    """Write bronze, silver and quarantine of a batch; returns one count row per file.

    Bronze is classified as it is written. Silver and quarantine then come from the
    stored batch, not from a second parse of the raw files: quarantine reads the few
    pages that hold a rejected row, silver the rest. Silver is dealt out by date as it is
    written, so that a date becomes few files, and one with very many rows still several.
    """
    bronze = refine.classify(raw.to_bronze(lines, run_at)).select(
        *schemas.BRONZE_STORED.fieldNames()
    )
    lake.write_batch("bronze", seq, bronze)
    stored = lake.spark.read.schema(schemas.BRONZE_STORED).parquet(lake.batch_path("bronze", seq))
    silver = refine.silver(stored, run_at, keep=["source_file"])
    lake.write_batch("silver", seq, silver.hint("rebalance", F.col("event_date")))
    lake.write_batch("quarantine", seq, refine.quarantine(stored, run_at))
    if lake.known_ids:
        clean = lake.spark.read.schema(lake.schema("silver")).parquet(lake.batch_path("silver", seq))
        lake.known_ids.add(seq, clean)
    return _batch_counts(lake, seq, refine.file_audit(stored).collect())  # one row per file


def _batch_counts(lake: Lake, seq: int, audit: list[Row]) -> list[FileCounts]:
    """Rows per file as found in each written table; duplicates as counted in bronze."""

    def written(table: str) -> dict[str, int]:
        rows = lake.spark.read.schema(lake.schema(table)).parquet(lake.batch_path(table, seq))
        counted = rows.groupBy("source_file").agg(F.count("*").alias("n")).collect()
        return {r.source_file: r.n for r in counted}

    silver, quarantine = written("silver"), written("quarantine")
    return [
        FileCounts(
            a.source_file,
            a.bronze_rows,
            silver.get(a.source_file, 0),
            quarantine.get(a.source_file, 0),
            a.duplicate_rows,
        )
        for a in audit
    ]


def commit_batch(
    lake: Lake, seq: int, counts: list[FileCounts], run_at: dt.datetime | None = None
) -> None:
    """Enter a batch in the ledger. Nothing of it is visible to readers before.

    Without a given time the stamp is that of the commit, so every batch has its own.
    """
    run_at = run_at or run_stamp()
    off = [c.source_file for c in counts if not c.balanced]
    if off:
        raise UnbalancedBatch(f"rows in and out differ for {off}")
    rows = [
        (seq, c.source_file, "done", run_at, c.bronze_rows, c.silver_rows, c.quarantine_rows,
         c.duplicate_rows, None)
        for c in counts
    ]
    lake.commit(lake.spark.createDataFrame(rows, schemas.LEDGER))


def reject_files(
    lake: Lake, faults: dict[str, str], run_at: dt.datetime | None = None
) -> set[str]:
    """Enter files that could not be read. They stay pending for the next run."""
    run_at = run_at or run_stamp()
    if faults:
        rows = [
            (None, name, "rejected", run_at, None, None, None, None, reason)
            for name, reason in faults.items()
        ]
        lake.commit(lake.spark.createDataFrame(rows, schemas.LEDGER))
    return set(faults)


# ---- runs -------------------------------------------------------------------


def ingest_pending(
    lake: Lake,
    raw_root: str | list[str],
    days: DataFrame | None = None,
    run_at: dt.datetime | None = None,
    files_per_batch: int = FILES_PER_BATCH,
    check_first: bool = False,
    part_counts: bool = False,
) -> int:
    """Process every landed file the ledger does not have as done; returns batches made.

    `days` restricts the run to the files of those dates. With `files_per_batch=1`
    every file becomes a version of its own. An unreadable file is rejected and the
    others go on; by default files are tested only when reading them failed, so that
    good files are decompressed once. Without `run_at` every batch is stamped as it is
    committed, so that versions of one run can be told apart by time. With `part_counts`
    an hour whose folder states a number of parts stays pending until all of them are there.
    """
    listed = raw.list_files(lake.spark, raw_root)
    if part_counts:
        listed = raw.whole_hours(listed, raw.stated_parts(lake.spark, raw_root))
    empty = raw.zero_byte_files(lake.spark, raw_root)
    if days is not None:
        expected = reports.expected_files(days).select("source_file")
        listed = listed.join(expected, "source_file", "left_semi")
    else:
        expected = None
    refused = _reject_empty(lake, empty, expected, run_at)
    batches = 0
    while parts := _next_batch(listed, lake, refused, files_per_batch):
        made, bad = _ingest_parts(lake, parts, run_at, check_first)
        refused |= bad
        batches += made
    return batches


def _reject_empty(
    lake: Lake, empty: dict[str, str], expected: DataFrame | None, run_at: dt.datetime | None
) -> set[str]:
    """Refuse hours that are there, but without a byte, among the expected ones if given."""
    if not empty:
        return set()
    names = lake.spark.createDataFrame([(n,) for n in empty], "source_file STRING")
    if expected is not None:
        names = names.join(expected, "source_file", "left_semi")
    open_names = [r.source_file for r in reports.pending_files(names, lake.ledger()).collect()]
    return reject_files(lake, {n: empty[n] for n in open_names}, run_at)


def _next_batch(listed: DataFrame, lake: Lake, refused: set[str], n: int) -> list[Row]:
    """The parts (source_file, path, length) of the next n pending files, oldest first."""
    pending = reports.pending_files(listed, lake.ledger())
    if refused:
        left_out = lake.spark.createDataFrame([(f,) for f in refused], "source_file STRING")
        pending = pending.join(left_out, "source_file", "left_anti")
    order = [
        ev.file_date(F.col("source_file")),
        ev.file_hour(F.col("source_file")),
        F.col("source_file"),
    ]
    names = pending.select("source_file").distinct().orderBy(*order).limit(n)
    return pending.join(names, "source_file", "left_semi").collect()


def _ingest_parts(
    lake: Lake, parts: list[Row], run_at: dt.datetime | None, check_first: bool
) -> tuple[int, set[str]]:
    """Try a batch; when reading fails, leave the faulty files out and try again.

    Files that an earlier run has rejected are tested beforehand, so that one which is still
    faulty does not cost its batch an attempt.
    """
    suspects = parts if check_first else _rejected_before(lake, parts)
    bad = _reject_faulty(lake, suspects, run_at) if suspects else set()
    good = [p for p in parts if p.source_file not in bad]
    try:
        made, empty = _ingest_good(lake, good, run_at)
    except (PySparkException, Py4JError):
        faulty = _reject_faulty(lake, good, run_at)
        if not faulty:
            raise  # the files are sound, so the failure is about something else
        bad |= faulty
        made, empty = _ingest_good(
            lake, [p for p in good if p.source_file not in faulty], run_at
        )
    return made, bad | empty


def _rejected_before(lake: Lake, parts: list[Row]) -> list[Row]:
    names = lake.spark.createDataFrame([(p.source_file,) for p in parts], "source_file STRING")
    rejected = lake.ledger().where("status = 'rejected'").join(names, "source_file", "left_semi")
    known = {r.source_file for r in rejected.select("source_file").distinct().collect()}
    return [p for p in parts if p.source_file in known]


def _reject_faulty(lake: Lake, parts: list[Row], run_at: dt.datetime | None) -> set[str]:
    files = lake.spark.createDataFrame(parts, "source_file STRING, path STRING, length BIGINT")
    faults = raw.gzip_faults(lake.spark, files).collect()
    return reject_files(lake, {f.source_file: f.fault for f in faults}, run_at)


def _ingest_good(
    lake: Lake, parts: list[Row], run_at: dt.datetime | None
) -> tuple[int, set[str]]:
    """Stage and commit; files that gave no record are rejected."""
    if not parts:
        return 0, set()
    seq = lake.last_seq() + 1
    lines = raw.read_lines(lake.spark, [p.path for p in parts])
    counts = stage_batch(lake, seq, lines, run_at or run_stamp())
    silent = {p.source_file for p in parts} - {c.source_file for c in counts}
    empty = reject_files(lake, dict.fromkeys(sorted(silent), "no records"), run_at)
    if counts:
        commit_batch(lake, seq, counts, run_at)
    return int(bool(counts)), empty


# ---- gold -------------------------------------------------------------------


def refresh_gold(
    lake: Lake, since: int | None = None, run_at: dt.datetime | None = None
) -> None:
    """Recompute gold from silver and mark the version it reflects.

    With `since`, only the dates that batches after that version touched, unreadable dates
    included: the date is part of both keys, so other dates cannot change.
    """
    run_at, upto = run_at or run_stamp(), lake.last_seq()
    silver = lake.silver(upto)
    if since is not None:
        new = lake.versioned("silver", upto).where(F.col("batch_seq") > since)
        touched = new.select(F.col("event_date").alias("touched")).distinct()
        silver = silver.join(touched, F.col("event_date").eqNullSafe(F.col("touched")), "left_semi")
    lake.replace("repo_daily", rollups.repo_daily(silver, run_at), since is not None)
    lake.replace("actor_daily", rollups.actor_daily(silver, run_at), since is not None)
    lake.mark_gold(upto)


def owed_gold(lake: Lake, run_at: dt.datetime | None = None) -> bool:
    """Bring gold up to the last version, whichever run left it behind."""
    behind = lake.gold_seq()
    if behind >= lake.last_seq():
        return False
    refresh_gold(lake, since=behind or None, run_at=run_at)
    return True


def run(
    lake: Lake,
    raw_root: str,
    days: DataFrame | None = None,
    run_at: dt.datetime | None = None,
    **options,
) -> int:
    """Ingest what is pending and bring gold up to date, also for an earlier run that crashed."""
    batches = ingest_pending(lake, raw_root, days, run_at, **options)
    owed_gold(lake, run_at)
    return batches


def run_day(
    lake: Lake, raw_root: str, day: str, run_at: dt.datetime | None = None, **options
) -> int:
    return run(lake, raw_root, reports.date_list(lake.spark, [day]), run_at, **options)


def backfill(
    lake: Lake, raw_root: str, start: str, end: str, run_at: dt.datetime | None = None, **options
) -> int:
    """All outstanding files of a range of days, in as few batches as allowed."""
    return run(lake, raw_root, reports.date_range(lake.spark, start, end), run_at, **options)


def full_refresh(lake: Lake, raw_root: str, run_at: dt.datetime | None = None) -> Lake:
    """Rebuild all tables beside the current ones and switch at the end."""
    fresh = lake.next_generation()
    run(fresh, raw_root, run_at=run_at)
    fresh.make_current()
    return fresh


# ---- checks -----------------------------------------------------------------


def check_lake(
    lake: Lake,
    now: dt.datetime | None = None,
    layer: str | None = None,
    fail_fast: bool = False,
    **expected,
) -> DataFrame:
    """Run the declared checks over the stored tables and keep the results."""
    now = now or run_stamp()
    tables = {
        "bronze": lake.bronze,
        "silver": lake.silver,
        "gold_repo": lambda: lake.gold("repo_daily"),
        "gold_actor": lambda: lake.gold("actor_daily"),
    }
    declared = quality.declared_checks(**expected)
    results = quality.run_checks(lake.spark, tables, declared, now, layer, fail_fast)
    results.coalesce(1).write.mode("append").parquet(lake.checks_path)
    return results
