from events_cases import bronze_rows
from pyspark.sql import functions as F

from cairnlake.functions import events as ev
from cairnlake.operators import refine


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_to_bigint(spark):
    texts = ["12", " 7 ", "3.0", "1e3", "1.5", "x", "", None, "NaN", "Infinity", "-4",
             "9223372036854775807"]
    got = values(spark, [(t,) for t in texts], "t STRING", ev.to_bigint(F.col("t")))
    assert got == [12, 7, 3, 1000, None, None, None, None, None, None, -4, 9223372036854775807]


def test_payload_columns_by_type(spark):
    body = (
        '{"action":"opened","ref":"r","ref_type":"branch","size":3,"number":4,'
        '"pull_request":{"number":5},"issue":{"number":6}}'
    )
    types = ev.EVENT_TYPES + ["SomethingElse"]
    df = refine.classify(bronze_rows(spark, [{"type": t, "payload": body} for t in types]))
    got = {r["type"]: tuple(r)[1:] for r in df.select(
        "type", *[c.alias(n) for n, c in ev.payload_columns().items()]).collect()}
    nothing = (None,) * 6
    want = {
        "PushEvent": (None, "r", None, 3, None, None),
        "CreateEvent": (None, "r", "branch", None, None, None),
        "DeleteEvent": (None, "r", "branch", None, None, None),
        "PullRequestEvent": ("opened", None, None, None, 4, None),
        "PullRequestReviewEvent": ("opened", None, None, None, 5, None),
        "PullRequestReviewCommentEvent": ("opened", None, None, None, 5, None),
        "IssuesEvent": ("opened", None, None, None, None, 6),
        "IssueCommentEvent": ("opened", None, None, None, None, 6),
        **{t: ("opened", None, None, None, None, None) for t in ev.ACTION_ONLY_TYPES},
    }
    assert got == {t: want.get(t, nothing) for t in types}


def test_classification_priority_and_payload_rules(spark):
    cases = [
        ({}, None),
        ({"id": None}, "missing_id"),
        ({"id": "", "type": None, "payload": "{"}, "missing_id"),
        ({"type": "", "payload": "{"}, "missing_type"),
        ({"payload": '{"action":'}, "malformed_payload"),
        ({"payload": '{"action":"opened","size":'}, "malformed_payload"),
        ({"payload": "abc"}, "malformed_payload"),
        ({"payload": ""}, None),
        ({"payload": None}, None),
        ({"payload": "[]"}, None),
        ({"payload": "3"}, None),
        ({"payload": "null"}, None),
        ({"payload": '{"a":1,"a":2}'}, None),
        ({"payload": '{"unknown":{"deep":[1,2]}}'}, None),
        ({"payload": '{"pull_request":"x"}'}, None),
        ({"id": "None"}, None),  # a text, not a missing value; a check reports it
        # pinned differences from a strict reader
        ({"payload": '{"size":NaN}'}, "malformed_payload"),
        ({"payload": '{"a":1} tail'}, None),
    ]
    df = refine.classify(bronze_rows(spark, [c for c, _ in cases]))
    got = [r.error_reason for r in df.orderBy("row_pos").collect()]
    assert got == [want for _, want in cases]


def test_is_bot(spark):
    logins = ["ci[bot]", "CI[BOT]", "renovate-bot", "Auto-Bot", "bot", "robot", "", None, "[bot]x"]
    got = values(spark, [(x,) for x in logins], "l STRING", ev.is_bot(F.col("l")))
    assert got == [True, True, True, True, False, False, False, False, False]


def test_contains_is_literal_unless_asked(spark):
    rows = [("octo",), ("ci[bot]",), (None,)]
    literal = values(spark, rows, "l STRING", ev.contains(F.col("l"), "[BOT]"))
    pattern = values(spark, rows, "l STRING", ev.contains(F.col("l"), "[bot]", regex=True))
    assert literal == [False, True, False]
    assert pattern == [True, True, False]


def test_starts_with_and_file_names(spark):
    assert values(spark, [("demo1",), (None,)], "l STRING", ev.starts_with(F.col("l"), "demo")) == [
        True, False]
    rows = [("2024-01-05-7.json.gz",), ("2024-01-05-17.json.gz",), ("other",)]
    days = values(spark, rows, "f STRING", ev.file_date(F.col("f")).cast("string"))
    hours = values(spark, rows, "f STRING", ev.file_hour(F.col("f")))
    assert days == ["2024-01-05", "2024-01-05", None]
    assert hours == [7, 17, None]
