import datetime as dt

import pytest
from events_cases import UTC
from pyspark.sql import types as T

from cairnlake.operators import history, reports


def table(spark, rows):
    return spark.createDataFrame(rows, "id STRING, type STRING, batch_seq BIGINT")


def test_instants():
    assert history.parse_instant("2024-01-01T02:00:00+02:00") == dt.datetime(2024, 1, 1, tzinfo=UTC)
    assert history.parse_instant("2024-01-01") == dt.datetime(2024, 1, 1, tzinfo=UTC)


def test_type_diff_has_no_false_zeros(spark):
    # 12 types; the rarest of one side is outside a per-side top 10 but is not zero
    rows = [(f"{t}{i}", f"T{t:02d}", 1) for t in range(12) for i in range(12 - t)]
    rows += [(f"x{i}", "T11", 2) for i in range(50)] + [("n", "New", 2), ("z", None, 2)]
    df = table(spark, rows)
    diff = {r.event_type: (r.before_n, r.after_n, r["diff"]) for r in
            history.type_diff(history.as_of(df, 1), df).collect()}
    assert diff["T11"] == (1, 51, 50)
    assert diff["New"] == (0, 1, 1)
    assert len(diff) == 13
    top = history.type_diff(history.as_of(df, 1), df, top_n=3).collect()
    assert [r.event_type for r in top] == ["T00", "T01", "T11"]


def test_new_rows_and_null_keys(spark):
    df = table(spark, [("a", "t", 1), (None, "t", 1), ("a", "t", 2), ("b", "t", 2), (None, "u", 2)])
    before = history.as_of(df, 1)
    both = sorted(map(str, history.new_rows(before, df).collect()))
    assert both == sorted(map(str, history.rows_since(df, 1).collect()))
    assert len(both) == 3  # b and both rows without a key


def test_row_delta_of_an_empty_past(spark):
    row = history.row_delta(table(spark, [("a", "t", 2)]), 1).first()
    assert (row.before_rows, row.added_rows, row.percent) == (0, 1, 0.0)


@pytest.mark.parametrize("bucket", [1, 3, 1000])
def test_running_totals_do_not_depend_on_the_buckets(spark, bucket):
    rows = [(i * 2, dt.datetime(2024, 1, 1, tzinfo=UTC), i) for i in range(1, 11)]
    committed = spark.createDataFrame(rows, "batch_seq BIGINT, committed_at TIMESTAMP, added_rows BIGINT")
    got = history.version_history(committed, bucket).orderBy("batch_seq").collect()
    assert [(r.idx, r.total_rows) for r in got] == [
        (i - 1, i * (i + 1) // 2) for i in range(1, 11)]


def test_schema_helpers(spark):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType())])
    wider = history.add_column(schema, "flag", T.BooleanType())
    assert history.add_column(wider, "flag", T.BooleanType()) == wider
    df = spark.createDataFrame([(5, "x")], "n INT, id STRING")
    aligned = history.align_to_schema(df, wider)
    assert aligned.schema == wider and tuple(aligned.first()) == ("x", 5, None)
    both = history.append_evolved(df, aligned.withColumn("n", aligned.n.cast("int")))
    assert both.count() == 2 and both.where("flag IS NULL").count() == 2


def test_dates(spark):
    days = [str(r.day) for r in reports.date_range(spark, "2024-02-28", "2024-03-01").collect()]
    assert days == ["2024-02-28", "2024-02-29", "2024-03-01"]
    listed = reports.date_list(spark, ["2024-01-02", "2024-01-01", "2024-01-02"]).collect()
    assert [str(r.day) for r in listed] == ["2024-01-01", "2024-01-02"]
    with pytest.raises(ValueError):
        reports.date_range(spark, "2024-01-02", "2024-01-01")
