import datetime as dt

import pytest
from events_cases import NOW, UTC, bronze_rows

from cairnlake.operators import quality, refine, rollups

DAY = dt.timedelta(days=1)


def outcome(spark, df, check, now=NOW):
    row = quality.check_table(df, "layer", [check], now).first()
    return row.value, row.outcome


def test_each_metric(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 2), ("", 3), (None, 4), ("None", -1)], "k STRING, n INT")
    empty = df.where("false")
    assert outcome(spark, df, quality.has_rows("r")) == (5, "pass")
    assert outcome(spark, empty, quality.has_rows("r")) == (0, "fail")
    assert outcome(spark, df, quality.not_missing("m", "k")) == (1, "fail")
    assert outcome(spark, df, quality.not_missing("m", "k", quality.MISSING_TOKENS)) == (3, "fail")
    assert outcome(spark, df, quality.only_valid("v", "k", ["a", "None"])) == (1, "fail")
    assert outcome(spark, df, quality.unique("u", "k")) == (1, "fail")
    assert outcome(spark, df, quality.unique("u", "k", "n")) == (0, "pass")
    assert outcome(spark, df, quality.at_least("l", "n", 0)) == (-1, "fail")
    assert outcome(spark, empty, quality.at_least("l", "n", 0)) == (None, "error")
    assert outcome(spark, df, quality.no_rows_where("f", "n > 3")) == (1, "fail")
    assert outcome(spark, df, quality.no_rows_where("f", "n > 3", True)) == (1, "warn")
    assert outcome(spark, empty, quality.not_missing("m", "k")) == (0, "pass")
    assert quality.bad_rows(df, quality.no_rows_where("f", "n > 3")).count() == 1


@pytest.mark.parametrize("age,want", [(0.5, "pass"), (1.5, "warn"), (2.5, "fail"), (2, "warn")])
def test_freshness(spark, age, want):
    df = spark.createDataFrame([(NOW - age * DAY,), (NOW - 9 * DAY,)], "t TIMESTAMP")
    value, got = outcome(spark, df, quality.fresh("x", "t", 1, 2))
    assert (value, got) == (int(age * 86400), want)


def test_47_declared_checks():
    declared = quality.declared_checks()
    assert {k: len(v) for k, v in declared.items()} == {
        "bronze": 14, "silver": 14, "gold_repo": 11, "gold_actor": 8}


@pytest.fixture(scope="module")
def tables(spark):
    bronze = bronze_rows(spark, [{"payload": '{"size":1}'}, {}, {"type": "WatchEvent"}])
    silver = refine.silver(refine.classify(bronze), dt.datetime(2024, 1, 1, 3, tzinfo=UTC))
    return {
        "bronze": bronze, "silver": silver, "gold_repo": rollups.repo_daily(silver),
        "gold_actor": lambda: rollups.actor_daily(silver),
    }


def test_good_data_passes_everything(spark, tables):
    now = dt.datetime(2024, 1, 1, 5, tzinfo=UTC)
    results = quality.run_checks(spark, tables, quality.declared_checks(), now)
    assert results.where("outcome <> 'pass'").count() == 0
    assert results.count() == 47
    assert quality.gate(results) == 0
    summary = {r.layer: r for r in quality.summarise(results).collect()}
    assert summary["all"].total == 47 and summary["all"].ok


def test_negative_case_repo_day_without_known_contributor(spark):
    bronze = bronze_rows(spark, [{"actor_login": None}])
    gold = rollups.repo_daily(refine.silver(refine.classify(bronze), NOW))
    rows = quality.check_table(gold, "gold_repo", quality.repo_daily_checks(), NOW).collect()
    assert [r.check_name for r in rows if r.outcome == "fail"] == [
        "at least one contributor per repo-day"]


def test_error_layer_counts_against_the_gate(spark, tables):
    broken = {**tables, "silver": tables["silver"].drop("id")}
    broken.pop("gold_repo")
    results = quality.run_checks(spark, broken, quality.declared_checks(), NOW)
    errors = results.where("outcome = 'error'")
    assert {r.layer for r in errors.select("layer").collect()} == {"silver", "gold_repo"}
    assert errors.where("error IS NULL").count() == 0
    with pytest.raises(quality.QualityGateError):
        quality.gate(results)


def test_gate_without_results(spark, tables):
    results = quality.run_checks(spark, tables, quality.declared_checks(), NOW, layer="bronze")
    assert results.select("layer").distinct().count() == 1
    with pytest.raises(quality.QualityGateError):
        quality.gate(results.where("false"))


def test_fail_fast_stops_after_the_first_bad_layer(spark, tables):
    broken = {**tables, "bronze": tables["bronze"].where("false")}
    results = quality.run_checks(
        spark, broken, quality.declared_checks(), NOW, fail_fast=True)
    assert {r.layer for r in results.select("layer").collect()} == {"bronze"}


def test_report_is_one_nested_row_per_run(spark, tables, tmp_path):
    results = quality.run_checks(spark, tables, quality.declared_checks(), NOW)
    quality.write_report(results, str(tmp_path / "report"))
    row = spark.read.json(str(tmp_path / "report")).collect()
    assert len(row) == 1
    assert row[0].summary.total == 47
    assert sorted(len(layer.details) for layer in row[0].layers) == [8, 11, 14, 14]


def test_the_gate_at_several_limits(spark):
    df = spark.createDataFrame([(None,), (1,)], "k INT")
    results = quality.check_table(df, "layer", [quality.not_missing("m", "k"), quality.has_rows("r")], NOW)
    got = [tuple(r) for r in quality.gate_at(results, [0, 1]).collect()]
    assert got == [(0, 2, 1, False), (1, 2, 1, True)]
    assert not any(r.open for r in quality.gate_at(results.where("false"), [0, 9]).collect())
