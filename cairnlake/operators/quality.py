"""Declared data checks: measure, judge, summarise, gate.

All single-pass metrics of a table are taken by one aggregate, i.e. one scan that
reads only the checked columns. A uniqueness check adds one grouped count over
its key columns. A check whose value cannot be had has the outcome `error`.
"""

from __future__ import annotations

import datetime as dt
import operator
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake import schemas
from cairnlake.functions import events as ev

DAY_SECONDS = 86_400
MISSING_TOKENS = ("", "null", "None")  # fixed values: texts that count as missing
Rule = tuple[str, int]  # e.g. (">", 0): the outcome applies when value > 0
_COMPARE = {
    ">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le, "=": operator.eq,
}


class QualityGateError(RuntimeError):
    pass


@dataclass(frozen=True)
class Check:
    name: str
    metric: str
    columns: tuple[str, ...] = ()
    expression: str | None = None
    tokens: tuple[str, ...] = ()
    valid: tuple[str, ...] = ()
    fail: Rule | None = (">", 0)
    warn: Rule | None = None


# ---- declaring --------------------------------------------------------------


def has_rows(name: str) -> Check:
    return Check(name, "row_count", fail=("=", 0))


def not_missing(name: str, column: str, tokens: tuple[str, ...] = ()) -> Check:
    return Check(name, "missing_count", (column,), tokens=tokens)


def only_valid(name: str, column: str, valid: list[str]) -> Check:
    return Check(name, "invalid_count", (column,), valid=tuple(valid))


def unique(name: str, *columns: str) -> Check:
    return Check(name, "duplicate_count", columns)


def at_least(name: str, expression: str, least: int) -> Check:
    return Check(name, "min", expression=expression, fail=("<", least))


def no_rows_where(name: str, predicate: str, only_warn: bool = False) -> Check:
    rule = (">", 0)
    return Check(
        name, "failed_rows", expression=predicate,
        fail=None if only_warn else rule, warn=rule if only_warn else None,
    )


def fresh(name: str, column: str, warn_days: int, fail_days: int) -> Check:
    return Check(
        name, "freshness", (column,),
        fail=(">", fail_days * DAY_SECONDS), warn=(">", warn_days * DAY_SECONDS),
    )


# ---- measuring --------------------------------------------------------------


def _is_missing(column: str, tokens: tuple[str, ...]) -> Column:
    missing = F.col(column).isNull()
    return missing | F.col(column).isin(*tokens) if tokens else missing


def bad_rows(df: DataFrame, check: Check) -> DataFrame:
    """The rows a row-level check objects to."""
    return df.where(_objection(check))


def _objection(check: Check) -> Column:
    if check.metric == "missing_count":
        return _is_missing(check.columns[0], check.tokens)
    if check.metric == "invalid_count":
        return F.col(check.columns[0]).isNotNull() & ~F.col(check.columns[0]).isin(*check.valid)
    if check.metric == "failed_rows":
        return F.expr(check.expression)
    raise ValueError(f"{check.metric} is not a row-level metric")


def _measure(check: Check, now: dt.datetime) -> Column:
    if check.metric == "row_count":
        return F.count("*")
    if check.metric == "min":
        return F.min(F.expr(check.expression)).cast("bigint")
    if check.metric == "freshness":
        age = F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros(F.max(check.columns[0]))
        return F.floor(age / 1_000_000).cast("bigint")
    return F.count_if(_objection(check))


def _repeated_keys(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    known = reduce(operator.and_, [F.col(c).isNotNull() for c in columns])
    counted = df.where(known).groupBy(*columns).agg(F.count("*").alias("_rows"))
    return counted.agg(F.count_if(F.col("_rows") > 1).alias("value"))


def _outcome(check: Check, value: Column) -> Column:
    verdict = F.when(value.isNull(), "error")
    if check.fail:
        verdict = verdict.when(_COMPARE[check.fail[0]](value, check.fail[1]), "fail")
    if check.warn:
        verdict = verdict.when(_COMPARE[check.warn[0]](value, check.warn[1]), "warn")
    return verdict.otherwise("pass")


def _result(layer: str, number: int, check: Check, value: Column) -> Column:
    return F.struct(
        F.lit(layer).alias("layer"),
        F.lit(number).alias("check_no"),
        F.lit(check.name).alias("check_name"),
        F.lit(check.metric).alias("metric"),
        value.alias("value"),
        _outcome(check, value).alias("outcome"),
    )


def check_table(
    df: DataFrame, layer: str, checks: list[Check], now: dt.datetime
) -> DataFrame:
    """One row per check: layer, check_no, check_name, metric, value, outcome."""
    numbered = list(enumerate(checks, start=1))
    single = [(i, c) for i, c in numbered if c.metric != "duplicate_count"]
    parts = []
    if single:
        measured = df.agg(*[_measure(c, now).alias(f"v{i}") for i, c in single])
        rows = F.array(*[_result(layer, i, c, F.col(f"v{i}")) for i, c in single])
        parts.append(measured.select(F.inline(rows)))
    for i, c in numbered:
        if c.metric == "duplicate_count":
            repeated = _repeated_keys(df, c.columns)
            parts.append(repeated.select(F.inline(F.array(_result(layer, i, c, F.col("value"))))))
    return reduce(DataFrame.unionByName, parts)


# ---- running ----------------------------------------------------------------


def run_checks(
    spark: SparkSession,
    tables: dict[str, DataFrame | Callable[[], DataFrame]],
    declared: dict[str, list[Check]],
    now: dt.datetime,
    layer: str | None = None,
    fail_fast: bool = False,
) -> DataFrame:
    """Evaluate the layers one after another and return all results.

    A layer that cannot be evaluated gets an `error` row for each of its checks.
    With `fail_fast` later layers are left out once one has a fail or an error.
    """
    results: list[tuple] = []
    for name in [layer] if layer else list(declared):
        checks = declared[name]
        try:
            source = tables[name]
            df = source() if callable(source) else source
            found = check_table(df, name, checks, now).orderBy("check_no").collect()
            rows = [(now, *r, None) for r in found]  # at most one row per declared check
        except (PySparkException, Py4JError, KeyError) as exc:  # of the plan, of a task, or no table
            text = (str(exc).splitlines() or [type(exc).__name__])[0]
            rows = [
                (now, name, i, c.name, c.metric, None, "error", text)
                for i, c in enumerate(checks, start=1)
            ]
        results += rows
        if fail_fast and any(r[6] in ("fail", "error") for r in rows):
            break
    return spark.createDataFrame(results, schemas.CHECK_RESULTS)


def summarise(results: DataFrame) -> DataFrame:
    """Counts per layer and for `all`; `ok` is false with any fail or error."""
    outcome = F.col("outcome")
    counted = results.rollup("layer").agg(
        F.count("*").alias("total"),
        F.count_if(outcome == "pass").alias("passed"),
        F.count_if(outcome == "warn").alias("warned"),
        F.count_if(outcome == "fail").alias("failed"),
        F.count_if(outcome == "error").alias("errors"),
    )
    return counted.withColumn("layer", F.coalesce("layer", F.lit("all"))).withColumn(
        "ok", F.col("failed") + F.col("errors") == 0
    )


def gate(results: DataFrame, max_failures: int = 3) -> int:
    """Number of fails and errors; raises when there are more than allowed, or no results."""
    total, bad = results.agg(
        F.count("*"), F.count_if(F.col("outcome").isin("fail", "error"))
    ).first()
    if total == 0:
        raise QualityGateError("no check results: nothing was checked")
    if bad > max_failures:
        raise QualityGateError(f"{bad} checks failed, {max_failures} are allowed")
    return bad


def gate_at(results: DataFrame, limits: list[int]) -> DataFrame:
    """(max_failures, total, bad, open): what `gate` would say at each limit; shut without results."""
    counted = results.agg(
        F.count("*").alias("total"), F.count_if(F.col("outcome").isin("fail", "error")).alias("bad")
    )
    return counted.select(
        F.explode(F.array(*map(F.lit, limits))).alias("max_failures"), "total", "bad"
    ).withColumn("open", (F.col("total") > 0) & (F.col("bad") <= F.col("max_failures")))


def report(results: DataFrame) -> DataFrame:
    """One nested row per run: run_at, summary, layers with their details.

    The lists hold declared checks, so their length does not grow with the data.
    """

    def tally(of: str) -> Column:
        return F.count_if(F.col("outcome") == of)

    detail = F.struct("check_no", "check_name", "metric", "value", "outcome", "error")
    layers = results.groupBy("run_at", "layer").agg(
        F.count("*").alias("total"),
        tally("pass").alias("passed"),
        tally("warn").alias("warned"),
        tally("fail").alias("failed"),
        tally("error").alias("errors"),
        F.array_sort(F.collect_list(detail)).alias("details"),
    )
    counts = ["total", "passed", "warned", "failed", "errors"]
    return layers.groupBy("run_at").agg(
        F.struct(*[F.sum(c).alias(c) for c in counts]).alias("summary"),
        F.array_sort(F.collect_list(F.struct("layer", *counts, "details"))).alias("layers"),
    )


def write_report(results: DataFrame, path: str) -> None:
    report(results).write.mode("append").json(path)


# ---- the declared checks ----------------------------------------------------


def bronze_checks(year: int = 2024) -> list[Check]:
    return [
        has_rows("bronze has rows"),
        not_missing("event id not null", "id", MISSING_TOKENS),
        not_missing("event type not null", "type", MISSING_TOKENS),
        not_missing("actor login not null", "actor_login"),
        not_missing("actor id not null", "actor_id"),
        not_missing("repo name not null", "repo_name"),
        not_missing("repo id not null", "repo_id"),
        not_missing("created_at not null", "created_at"),
        not_missing("payload not null", "payload"),
        unique("event id unique in bronze", "id"),
        only_valid("event type only known values", "type", ev.EVENT_TYPES),
        at_least("event id not empty string", "length(id)", 1),
        no_rows_where("created_at within expected year", f"year(created_at) <> {year}"),
        no_rows_where("no future events in bronze", "created_at > ingested_at"),
    ]


def _outside(first_day: str, last_day: str) -> str:
    return f"event_date < DATE '{first_day}' OR event_date > DATE '{last_day}'"


def silver_checks(first_day: str = "2024-01-01", last_day: str = "2024-01-07") -> list[Check]:
    late = "unix_micros(transformed_at) - unix_micros(created_at) > 86400000000"
    return [
        has_rows("silver has rows"),
        not_missing("event id not null after dedup", "id", MISSING_TOKENS),
        not_missing("event type not null in silver", "type"),
        not_missing("actor login not null in silver", "actor_login"),
        not_missing("actor id not null in silver", "actor_id"),
        not_missing("repo name not null in silver", "repo_name"),
        not_missing("repo id not null in silver", "repo_id"),
        not_missing("event_date populated for all rows", "event_date"),
        unique("no duplicate event ids after deduplication", "id"),
        only_valid("silver event type only known values", "type", ev.EVENT_TYPES),
        no_rows_where("created_at within expected date range", _outside(first_day, last_day)),
        no_rows_where("no future events in silver", "created_at > transformed_at"),
        no_rows_where("late arriving events flagged", late, only_warn=True),
        fresh("silver data not stale", "ingested_at", warn_days=1, fail_days=2),
    ]


def repo_daily_checks(first_day: str = "2024-01-01", last_day: str = "2024-01-07") -> list[Check]:
    return [
        has_rows("gold repo activity has rows"),
        not_missing("repo name not null in gold", "repo_name"),
        not_missing("event date not null in gold repo", "event_date"),
        not_missing("total events not null", "total_events"),
        at_least("total events not negative", "total_events", 0),
        at_least("push count not negative", "push_count", 0),
        at_least("star count not negative", "stars", 0),
        at_least("fork count not negative", "forks", 0),
        at_least("at least one contributor per repo-day", "unique_contributors", 1),
        no_rows_where("event date within expected range", _outside(first_day, last_day)),
        unique("one row per repo per date", "repo_name", "event_date"),
    ]


def actor_daily_checks(first_day: str = "2024-01-01", last_day: str = "2024-01-07") -> list[Check]:
    return [
        has_rows("gold actor activity has rows"),
        not_missing("actor login not null in gold", "actor_login"),
        not_missing("event date not null in gold actor", "event_date"),
        at_least("actor total events not negative", "total_events", 0),
        at_least("actor push count not negative", "push_count", 0),
        at_least("actor touched at least one repo", "repos_touched", 1),
        unique("one row per actor per date", "actor_login", "event_date"),
        no_rows_where("actor event date within expected range", _outside(first_day, last_day)),
    ]


def declared_checks(
    year: int = 2024, first_day: str = "2024-01-01", last_day: str = "2024-01-07"
) -> dict[str, list[Check]]:
    """The 47 checks by layer."""
    return {
        "bronze": bronze_checks(year),
        "silver": silver_checks(first_day, last_day),
        "gold_repo": repo_daily_checks(first_day, last_day),
        "gold_actor": actor_daily_checks(first_day, last_day),
    }
