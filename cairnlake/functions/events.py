"""Column expressions over event rows. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The event types the checks accept.
EVENT_TYPES = [
    "PushEvent",
    "PullRequestEvent",
    "PullRequestReviewEvent",
    "PullRequestReviewCommentEvent",
    "IssuesEvent",
    "IssueCommentEvent",
    "WatchEvent",
    "ForkEvent",
    "CreateEvent",
    "DeleteEvent",
    "ReleaseEvent",
    "MemberEvent",
    "CommitCommentEvent",
    "GollumEvent",
    "PublicEvent",
]
PULL_REQUEST_TYPES = ["PullRequestEvent", "PullRequestReviewEvent", "PullRequestReviewCommentEvent"]
REVIEW_TYPES = ["PullRequestReviewEvent", "PullRequestReviewCommentEvent"]
ISSUE_TYPES = ["IssuesEvent", "IssueCommentEvent"]
REF_TYPES = ["CreateEvent", "DeleteEvent"]
ACTION_ONLY_TYPES = ["WatchEvent", "ReleaseEvent", "MemberEvent", "ForkEvent"]

# The shape of an hourly file name, hour without a leading zero.
HOUR_FILE = r"(\d{4}-\d{2}-\d{2}-\d{1,2}\.json\.gz)"
# The file of that name, or a gzip part in a folder of that name, and nothing else: a
# download under way (`….json.gz.tmp`) is not an hour. Groups: the place, the name.
HOUR_PLACE = rf"^((?:.*[/=])?{HOUR_FILE})(?:/[^/]*\.gz)?$"
HOUR_FILE_PARTS = r"^(\d{4}-\d{2}-\d{2})-(\d{1,2})"

# Every payload member any event type reads, so that a payload is parsed once.
PAYLOAD_MEMBERS = ["action", "ref", "ref_type", "size", "number", "pull_request", "issue"]
PARSED = [f"p_{member}" for member in PAYLOAD_MEMBERS]


def with_payload(df: DataFrame) -> DataFrame:
    """Add the payload members as `p_*` texts, NULL where absent or not JSON.

    json_tuple is a generator: Spark evaluates it once per row and cannot copy it into
    a filter below, which it would do with a JSON expression in a plain column.
    """
    return df.select("*", F.json_tuple("payload", *PAYLOAD_MEMBERS).alias(*PARSED))


def is_blank(column: Column) -> Column:
    return column.isNull() | (column == "")


def is_broken_json(text: Column, *members: str) -> Column:
    """The text is not JSON. `members` are what json_tuple found in it.

    A row with any member was read to its end, so only the rows without one are read a
    second time. Valid JSON of any shape passes. Differences from a strict reader: NaN
    is not accepted; text after the first value and single quotes are.
    """
    nothing_found = F.coalesce(*members).isNull()
    return F.when(nothing_found, F.get_json_object(text, "$").isNull()).otherwise(False)


def is_malformed_payload(payload: Column) -> Column:
    """A payload that is not JSON; NULL, empty and {} payloads are fine."""
    present = ~F.coalesce(payload, F.lit("")).isin("", "{}")
    return present & is_broken_json(payload, *PARSED)


def error_reason(
    id_: Column, type_: Column, malformed: Column, corrupt: Column | None = None
) -> Column:
    """NULL for a clean row, else its most important fault."""
    start = F.when(corrupt.isNotNull(), "malformed_record") if corrupt is not None else F
    return (
        start.when(is_blank(id_), "missing_id")
        .when(is_blank(type_), "missing_type")
        .when(malformed, "malformed_payload")
    )


def to_bigint(text: Column) -> Column:
    """Whole number in the text, also when written like 3.0 or 1e3; otherwise NULL."""
    number = text.try_cast("double")
    whole = number.try_cast("bigint")
    return F.coalesce(text.try_cast("bigint"), F.when(whole.cast("double") == number, whole))


def payload_columns() -> dict[str, Column]:
    """The six typed columns by event type, over `with_payload`; else NULLs."""
    type_ = F.col("type")
    has_action = type_.isin("PullRequestEvent", *REVIEW_TYPES, *ISSUE_TYPES, *ACTION_ONLY_TYPES)
    pr_number = F.when(type_ == "PullRequestEvent", F.col("p_number")).when(
        type_.isin(REVIEW_TYPES), F.get_json_object("p_pull_request", "$.number")
    )
    issue_number = F.when(type_.isin(ISSUE_TYPES), F.get_json_object("p_issue", "$.number"))
    return {
        "action": F.when(has_action, F.col("p_action")),
        "ref": F.when(type_.isin("PushEvent", *REF_TYPES), F.col("p_ref")),
        "ref_type": F.when(type_.isin(REF_TYPES), F.col("p_ref_type")),
        "commit_count": to_bigint(F.when(type_ == "PushEvent", F.col("p_size"))),
        "pr_number": to_bigint(pr_number),
        "issue_number": to_bigint(issue_number),
    }


def is_bot(login: Column) -> Column:
    lowered = F.lower(login)
    return F.coalesce(lowered.endswith("[bot]") | lowered.endswith("-bot"), F.lit(False))


def contains(column: Column, text: str, regex: bool = False) -> Column:
    """Case-insensitive search; NULL does not match. `text` is literal unless `regex`."""
    if regex:
        found = column.rlike("(?i)" + text)
    else:
        found = F.contains(F.lower(column), F.lower(F.lit(text)))
    return F.coalesce(found, F.lit(False))


def starts_with(column: Column, text: str) -> Column:
    return F.coalesce(column.startswith(text), F.lit(False))


def file_date(source_file: Column) -> Column:
    text = F.regexp_extract(source_file, HOUR_FILE_PARTS, 1)
    return F.when(text != "", F.to_date(text))


def file_hour(source_file: Column) -> Column:
    return F.regexp_extract(source_file, HOUR_FILE_PARTS, 2).try_cast("int")


def hour_file_name(day: Column, hour: Column) -> Column:
    return F.concat(
        F.date_format(day, "yyyy-MM-dd"), F.lit("-"), hour.cast("string"), F.lit(".json.gz")
    )


def lag_micros(later: Column, earlier: Column) -> Column:
    return F.unix_micros(later) - F.unix_micros(earlier)
