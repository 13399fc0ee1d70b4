"""The registered queries as SQL for an independent engine, for result comparison.

The statements are written from the definitions, not generated from the Spark plans:
counts use COUNT(*) FILTER so that a count is never NULL, and sums of bigints are
cast back to BIGINT.
"""

from __future__ import annotations

# The known event types, as the checks and classes must have them.
TYPE_LIST = """'PushEvent','PullRequestEvent','PullRequestReviewEvent',
 'PullRequestReviewCommentEvent','IssuesEvent','IssueCommentEvent','WatchEvent','ForkEvent',
 'CreateEvent','DeleteEvent','ReleaseEvent','MemberEvent','CommitCommentEvent','GollumEvent',
 'PublicEvent'"""

CTES = {
    "e": """SELECT event_id, ts, user_id, event_type,
  CAST(json_extract_string(props,'$.k') AS INT) AS k FROM events""",
    "b": """SELECT event_id * 2 AS row_pos,
  CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 101 = 0 THEN ''
   WHEN event_id % 139 = 0 THEN 'None' ELSE CAST(event_id AS VARCHAR) END AS id,
  CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 107 = 0 THEN ''
   WHEN event_id % 109 = 0 THEN 'DownloadEvent'
   WHEN event_type='click' THEN CASE event_id % 3 WHEN 0 THEN 'PushEvent'
     WHEN 1 THEN 'CreateEvent' ELSE 'DeleteEvent' END
   WHEN event_type='purchase' THEN CASE event_id % 3 WHEN 0 THEN 'PullRequestEvent'
     WHEN 1 THEN 'PullRequestReviewEvent' ELSE 'PullRequestReviewCommentEvent' END
   WHEN event_type='error' THEN CASE event_id % 3 WHEN 0 THEN 'IssuesEvent'
     WHEN 1 THEN 'IssueCommentEvent' ELSE 'CommitCommentEvent' END
   WHEN event_type='view' THEN CASE event_id % 3 WHEN 0 THEN 'WatchEvent'
     WHEN 1 THEN 'ReleaseEvent' ELSE 'GollumEvent' END
   ELSE CASE event_id % 3 WHEN 0 THEN 'ForkEvent' WHEN 1 THEN 'MemberEvent'
     ELSE 'PublicEvent' END END AS type,
  CASE WHEN user_id % 37 = 5 THEN NULL
   WHEN user_id % 10 = 3 THEN concat('ci', CAST(user_id AS VARCHAR), '[bot]')
   WHEN user_id % 10 = 4 THEN concat('Auto', CAST(user_id AS VARCHAR), '-Bot')
   ELSE concat('user', CAST(user_id AS VARCHAR)) END AS actor_login,
  CAST(user_id AS VARCHAR) AS actor_id,
  CASE WHEN k = 13 THEN NULL ELSE concat('org/repo', CAST(k AS VARCHAR)) END AS repo_name,
  CAST(k AS VARCHAR) AS repo_id,
  ts AS created_at,
  CASE WHEN event_id % 113 = 0 THEN '{"action":' WHEN event_id % 127 = 0 THEN '{}'
   ELSE concat('{"action":"', CASE event_id % 2 WHEN 0 THEN 'opened' ELSE 'closed' END,
    '","ref":"refs/heads/b', CAST(k AS VARCHAR), '","ref_type":"branch","size":',
    CASE WHEN k % 11 = 0 THEN '"n/a"' ELSE CAST(k % 7 AS VARCHAR) END,
    ',"number":', CAST(k AS VARCHAR), ',"pull_request":{"number":', CAST(k + 1000 AS VARCHAR),
    '},"issue":{"number":', CAST(k + 2000 AS VARCHAR), '}}') END AS payload,
  concat(CAST(CAST(ts AS DATE) AS VARCHAR), '-', CAST(hour(ts) AS VARCHAR), '.json.gz')
   AS source_file,
  CASE WHEN event_id % 131 = 0 THEN ts + INTERVAL 30 HOUR
   WHEN event_id % 137 = 0 THEN ts - INTERVAL 1 HOUR ELSE ts + INTERVAL 2 HOUR END AS ingested_at
 FROM e""",
    "bronze": """SELECT * FROM b UNION ALL
  SELECT * REPLACE (row_pos + 1 AS row_pos) FROM b WHERE row_pos // 2 % 41 = 0""",
    "classified": """SELECT *, CASE WHEN id IS NULL OR id = '' THEN 'missing_id'
   WHEN type IS NULL OR type = '' THEN 'missing_type'
   WHEN payload NOT IN ('', '{}') AND NOT json_valid(payload) THEN 'malformed_payload'
   END AS error_reason FROM bronze""",
    "typed": """SELECT id, type, actor_login, actor_id, repo_name, repo_id, created_at,
  CAST(created_at AS DATE) AS event_date,
  CASE WHEN type IN ('PullRequestEvent','PullRequestReviewEvent','PullRequestReviewCommentEvent',
    'IssuesEvent','IssueCommentEvent','WatchEvent','ReleaseEvent','MemberEvent','ForkEvent')
   THEN json_extract_string(p, '$.action') END AS action,
  CASE WHEN type IN ('PushEvent','CreateEvent','DeleteEvent')
   THEN json_extract_string(p, '$.ref') END AS ref,
  CASE WHEN type IN ('CreateEvent','DeleteEvent')
   THEN json_extract_string(p, '$.ref_type') END AS ref_type,
  CASE WHEN type = 'PushEvent'
   THEN TRY_CAST(json_extract_string(p, '$.size') AS BIGINT) END AS commit_count,
  CASE WHEN type = 'PullRequestEvent' THEN TRY_CAST(json_extract_string(p, '$.number') AS BIGINT)
   WHEN type IN ('PullRequestReviewEvent','PullRequestReviewCommentEvent')
   THEN TRY_CAST(json_extract_string(p, '$.pull_request.number') AS BIGINT) END AS pr_number,
  CASE WHEN type IN ('IssuesEvent','IssueCommentEvent')
   THEN TRY_CAST(json_extract_string(p, '$.issue.number') AS BIGINT) END AS issue_number,
  ingested_at, ingested_at AS transformed_at, source_file, row_pos
  FROM (SELECT *, CASE WHEN json_valid(payload) THEN payload END AS p
   FROM classified WHERE error_reason IS NULL)""",
    "silver": """SELECT * FROM typed
  QUALIFY row_number() OVER (PARTITION BY source_file, id ORDER BY row_pos) = 1""",
    "silver_global": """SELECT * FROM typed QUALIFY row_number() OVER (PARTITION BY id ORDER BY
   CAST(regexp_extract(source_file, '^(\\d{4}-\\d{2}-\\d{2})-(\\d{1,2})', 1) AS DATE),
   CAST(regexp_extract(source_file, '^(\\d{4}-\\d{2}-\\d{2})-(\\d{1,2})', 2) AS INT),
   row_pos) = 1""",
    "quarantine": """SELECT source_file, id AS raw_id, type AS raw_type, error_reason
  FROM classified WHERE error_reason IS NOT NULL""",
    "repo_daily": """SELECT event_date, repo_name,
  COUNT(*) FILTER (WHERE type = 'PushEvent') AS push_count,
  CAST(COALESCE(SUM(commit_count) FILTER (WHERE type = 'PushEvent'), 0) AS BIGINT)
   AS total_commits,
  COUNT(*) FILTER (WHERE type = 'PullRequestEvent' AND action = 'opened') AS pr_opened,
  COUNT(*) FILTER (WHERE type = 'PullRequestEvent' AND action = 'closed') AS pr_closed,
  COUNT(*) FILTER (WHERE type = 'IssuesEvent' AND action = 'opened') AS issues_opened,
  COUNT(*) FILTER (WHERE type = 'WatchEvent') AS stars,
  COUNT(*) FILTER (WHERE type = 'ForkEvent') AS forks,
  COUNT(DISTINCT actor_login) AS unique_contributors, COUNT(*) AS total_events
  FROM silver WHERE repo_name IS NOT NULL GROUP BY event_date, repo_name""",
    "actor_daily": """SELECT event_date, actor_login,
  COUNT(*) FILTER (WHERE type = 'PushEvent') AS push_count,
  CAST(COALESCE(SUM(commit_count) FILTER (WHERE type = 'PushEvent'), 0) AS BIGINT)
   AS total_commits,
  COUNT(*) FILTER (WHERE type IN ('PullRequestEvent','PullRequestReviewEvent',
   'PullRequestReviewCommentEvent')) AS pr_count,
  COUNT(*) FILTER (WHERE type IN ('IssuesEvent','IssueCommentEvent')) AS issue_count,
  COUNT(DISTINCT repo_name) AS repos_touched, COUNT(*) AS total_events
  FROM silver WHERE actor_login IS NOT NULL GROUP BY event_date, actor_login""",
    "repeated": """SELECT source_file, id, MIN(row_pos) AS first_pos FROM classified
  WHERE error_reason IS NULL GROUP BY source_file, id HAVING COUNT(*) > 1""",
    "audit": """SELECT c.source_file, COUNT(*) AS bronze_rows,
  COUNT(DISTINCT CASE WHEN error_reason IS NULL THEN c.id END) AS silver_rows,
  COUNT(*) FILTER (WHERE error_reason IS NOT NULL) AS quarantine_rows,
  COUNT(*) FILTER (WHERE error_reason IS NULL)
   - COUNT(DISTINCT CASE WHEN error_reason IS NULL THEN c.id END) AS duplicate_rows,
  COUNT(DISTINCT r.id) AS repeated_ids
  FROM classified c LEFT JOIN repeated r
   ON r.source_file = c.source_file AND r.id = c.id AND c.error_reason IS NULL
  GROUP BY c.source_file""",
    "ledger0": """SELECT *, CAST(regexp_extract(source_file, '^(\\d{4}-\\d{2}-\\d{2})', 1) AS DATE)
   AS day, CAST(regexp_extract(source_file, '-(\\d{1,2})\\.json', 1) AS INT) AS hour FROM audit""",
    "ledger": """SELECT *,
  CASE WHEN hour = 7 AND day(day) % 5 = 0 THEN 'pending' ELSE 'done' END AS status,
  CAST(day AS TIMESTAMP) + to_hours(hour + 2) AS ingested_at FROM ledger0""",
    "done": "SELECT * FROM ledger WHERE status = 'done'",
    "spine": """SELECT CAST(d.day AS DATE) AS day, CAST(h.hour AS INT) AS hour,
  concat(CAST(CAST(d.day AS DATE) AS VARCHAR), '-', CAST(h.hour AS VARCHAR), '.json.gz')
   AS source_file
  FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY) d(day),
   generate_series(0, 23) h(hour)""",
    "versioned": "SELECT *, CAST(day(created_at) AS BIGINT) AS batch_seq FROM silver",
    "committed": """SELECT batch_seq,
  CAST(MAX(event_date) AS TIMESTAMP) + INTERVAL 1 DAY AS committed_at, COUNT(*) AS added_rows
  FROM versioned GROUP BY batch_seq""",
}

SILVER_COLUMNS = """id, type, actor_login, actor_id, repo_name, repo_id, created_at, event_date,
 action, ref, ref_type, commit_count, pr_number, issue_number, ingested_at"""

PREFIX = "WITH " + ",\n".join(f"{name} AS (\n{body})" for name, body in CTES.items()) + "\n"

# layer, check_no, check_name, metric, source, value, fail rule, warn rule
_NONE = "FALSE"


def _missing(column: str, tokens: bool = False) -> str:
    also = f" OR {column} IN ('', 'null', 'None')" if tokens else ""
    return f"COUNT(*) FILTER (WHERE {column} IS NULL{also})"


def _where(predicate: str) -> str:
    return f"COUNT(*) FILTER (WHERE {predicate})"


def _repeated(table: str, *keys: str) -> str:
    known = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    cols = ", ".join(keys)
    return (
        f"(SELECT COUNT(*) FROM (SELECT {cols} FROM {table} WHERE {known} "
        f"GROUP BY {cols} HAVING COUNT(*) > 1))"
    )


_RANGE = "event_date < DATE '2024-01-01' OR event_date > DATE '2024-01-07'"
_MANY = "v > 0"
# Order, titles and rules of the checks; results are reported under these titles.
CHECKS = {
    "bronze": ("bronze", [
        ("bronze has rows", "row_count", "COUNT(*)", "v = 0", _NONE),
        ("event id not null", "missing_count", _missing("id", True), _MANY, _NONE),
        ("event type not null", "missing_count", _missing("type", True), _MANY, _NONE),
        ("actor login not null", "missing_count", _missing("actor_login"), _MANY, _NONE),
        ("actor id not null", "missing_count", _missing("actor_id"), _MANY, _NONE),
        ("repo name not null", "missing_count", _missing("repo_name"), _MANY, _NONE),
        ("repo id not null", "missing_count", _missing("repo_id"), _MANY, _NONE),
        ("created_at not null", "missing_count", _missing("created_at"), _MANY, _NONE),
        ("payload not null", "missing_count", _missing("payload"), _MANY, _NONE),
        ("event id unique in bronze", "duplicate_count", _repeated("bronze", "id"), _MANY, _NONE),
        ("event type only known values", "invalid_count",
         _where(f"type IS NOT NULL AND type NOT IN ({TYPE_LIST})"), _MANY, _NONE),
        ("event id not empty string", "min", "MIN(length(id))", "v < 1", _NONE),
        ("created_at within expected year", "failed_rows",
         _where("year(created_at) <> 2024"), _MANY, _NONE),
        ("no future events in bronze", "failed_rows",
         _where("created_at > ingested_at"), _MANY, _NONE),
    ]),
    "silver": ("silver", [
        ("silver has rows", "row_count", "COUNT(*)", "v = 0", _NONE),
        ("event id not null after dedup", "missing_count", _missing("id", True), _MANY, _NONE),
        ("event type not null in silver", "missing_count", _missing("type"), _MANY, _NONE),
        ("actor login not null in silver", "missing_count", _missing("actor_login"), _MANY, _NONE),
        ("actor id not null in silver", "missing_count", _missing("actor_id"), _MANY, _NONE),
        ("repo name not null in silver", "missing_count", _missing("repo_name"), _MANY, _NONE),
        ("repo id not null in silver", "missing_count", _missing("repo_id"), _MANY, _NONE),
        ("event_date populated for all rows", "missing_count",
         _missing("event_date"), _MANY, _NONE),
        ("no duplicate event ids after deduplication", "duplicate_count",
         _repeated("silver", "id"), _MANY, _NONE),
        ("silver event type only known values", "invalid_count",
         _where(f"type IS NOT NULL AND type NOT IN ({TYPE_LIST})"), _MANY, _NONE),
        ("created_at within expected date range", "failed_rows", _where(_RANGE), _MANY, _NONE),
        ("no future events in silver", "failed_rows",
         _where("created_at > transformed_at"), _MANY, _NONE),
        ("late arriving events flagged", "failed_rows",
         _where("epoch_us(transformed_at) - epoch_us(created_at) > 86400000000"), _NONE, _MANY),
        ("silver data not stale", "freshness",
         "CAST(floor((epoch_us(TIMESTAMP '2024-02-01') - epoch_us(MAX(ingested_at))) / 1000000)"
         " AS BIGINT)", "v > 172800", "v > 86400"),
    ]),
    "gold_repo": ("repo_daily", [
        ("gold repo activity has rows", "row_count", "COUNT(*)", "v = 0", _NONE),
        ("repo name not null in gold", "missing_count", _missing("repo_name"), _MANY, _NONE),
        ("event date not null in gold repo", "missing_count",
         _missing("event_date"), _MANY, _NONE),
        ("total events not null", "missing_count", _missing("total_events"), _MANY, _NONE),
        ("total events not negative", "min", "MIN(total_events)", "v < 0", _NONE),
        ("push count not negative", "min", "MIN(push_count)", "v < 0", _NONE),
        ("star count not negative", "min", "MIN(stars)", "v < 0", _NONE),
        ("fork count not negative", "min", "MIN(forks)", "v < 0", _NONE),
        ("at least one contributor per repo-day", "min",
         "MIN(unique_contributors)", "v < 1", _NONE),
        ("event date within expected range", "failed_rows", _where(_RANGE), _MANY, _NONE),
        ("one row per repo per date", "duplicate_count",
         _repeated("repo_daily", "repo_name", "event_date"), _MANY, _NONE),
    ]),
    "gold_actor": ("actor_daily", [
        ("gold actor activity has rows", "row_count", "COUNT(*)", "v = 0", _NONE),
        ("actor login not null in gold", "missing_count", _missing("actor_login"), _MANY, _NONE),
        ("event date not null in gold actor", "missing_count",
         _missing("event_date"), _MANY, _NONE),
        ("actor total events not negative", "min", "MIN(total_events)", "v < 0", _NONE),
        ("actor push count not negative", "min", "MIN(push_count)", "v < 0", _NONE),
        ("actor touched at least one repo", "min", "MIN(repos_touched)", "v < 1", _NONE),
        ("one row per actor per date", "duplicate_count",
         _repeated("actor_daily", "actor_login", "event_date"), _MANY, _NONE),
        ("actor event date within expected range", "failed_rows", _where(_RANGE), _MANY, _NONE),
    ]),
}


def checks_sql(*layers: str) -> str:
    rows = []
    for layer in layers:
        table, checks = CHECKS[layer]
        for number, (name, metric, value, fail, warn) in enumerate(checks, start=1):
            source = "" if value.startswith("(SELECT") else f" FROM {table}"
            rows.append(
                f"SELECT layer, check_no, check_name, metric, v AS value, "
                f"CASE WHEN v IS NULL THEN 'error' WHEN {fail} THEN 'fail' "
                f"WHEN {warn} THEN 'warn' ELSE 'pass' END AS outcome FROM "
                f"(SELECT '{layer}' AS layer, {number} AS check_no, '{name}' AS check_name, "
                f"'{metric}' AS metric, CAST({value} AS BIGINT) AS v{source})"
            )
    return "\nUNION ALL\n".join(rows)


_SUMMARY = f"""SELECT COALESCE(layer, 'all') AS layer, COUNT(*) AS total,
  COUNT(*) FILTER (WHERE outcome = 'pass') AS passed,
  COUNT(*) FILTER (WHERE outcome = 'warn') AS warned,
  COUNT(*) FILTER (WHERE outcome = 'fail') AS failed,
  COUNT(*) FILTER (WHERE outcome = 'error') AS errors,
  COUNT(*) FILTER (WHERE outcome IN ('fail','error')) = 0 AS ok
 FROM ({checks_sql(*CHECKS)}) GROUP BY ROLLUP (layer)"""

_SHARE = "ROUND(CAST(n AS DOUBLE) * 100.0 / CAST(SUM(n) OVER () AS DOUBLE), 6)"

STATEMENTS = {
    # The rows as they come back from JSON lines: a line holding a broken payload is
    # kept whole, with its other fields unknown.
    "bronze_flatten": """SELECT source_file, row_pos, ingested_at,
  row_pos // 2 % 113 = 0 AS is_corrupt,
  CASE WHEN NOT is_corrupt THEN id END AS id, CASE WHEN NOT is_corrupt THEN type END AS type,
  CASE WHEN NOT is_corrupt THEN actor_login END AS actor_login,
  CASE WHEN NOT is_corrupt THEN actor_id END AS actor_id,
  CASE WHEN NOT is_corrupt THEN repo_name END AS repo_name,
  CASE WHEN NOT is_corrupt THEN repo_id END AS repo_id,
  CASE WHEN NOT is_corrupt THEN created_at END AS created_at,
  CASE WHEN NOT is_corrupt THEN payload END AS payload FROM bronze""",
    "declared_scan": """SELECT NOT ok AS is_corrupt, CASE WHEN ok THEN id END AS id,
  CASE WHEN ok THEN type END AS type, CASE WHEN ok THEN actor_login END AS actor_login,
  CASE WHEN ok THEN actor_id END AS actor_id, CASE WHEN ok THEN repo_name END AS repo_name,
  CASE WHEN ok THEN repo_id END AS repo_id, CASE WHEN ok THEN created_at END AS created_at,
  CASE WHEN ok THEN payload END AS payload, CASE WHEN ok THEN TRUE END AS public
  FROM (SELECT *, json_valid(payload) AS ok FROM bronze)""",
    "raw_preview": """SELECT row_pos, CASE WHEN ok THEN type END AS type,
  CASE WHEN ok THEN id END AS id, CASE WHEN ok THEN actor_login END AS actor_login,
  CASE WHEN ok THEN repo_name END AS repo_name,
  CASE WHEN ok THEN strftime(created_at, '%Y-%m-%dT%H:%M:%S.%fZ') END AS created_at,
  CASE WHEN ok THEN 'id,type,actor,repo,created_at,public,payload' END AS top_level_keys
  FROM (SELECT *, json_valid(payload) AS ok FROM bronze) ORDER BY row_pos LIMIT 100""",
    "quarantine_records": "SELECT * FROM quarantine",
    "quarantine_by_reason": f"""SELECT error_reason, n, {_SHARE} AS percent FROM
  (SELECT error_reason, COUNT(*) AS n FROM quarantine GROUP BY error_reason)""",
    "silver_events": f"SELECT {SILVER_COLUMNS} FROM silver",
    "silver_events_global_dedup": f"SELECT {SILVER_COLUMNS} FROM silver_global",
    "duplicate_audit": """SELECT *,
  bronze_rows = silver_rows + quarantine_rows + duplicate_rows AS balanced FROM audit""",
    "repeated_ids": "SELECT * FROM repeated",
    "gold_repo_daily": "SELECT * FROM repo_daily",
    "gold_actor_daily": "SELECT * FROM actor_daily",
    "gold_repo_presented": "SELECT * FROM repo_daily ORDER BY event_date, total_events DESC, repo_name",
    "gold_actor_presented": """SELECT * FROM actor_daily
  ORDER BY event_date, total_events DESC, actor_login""",
    "top_repos": """SELECT event_date, repo_name, total_events, push_count, stars, forks
  FROM repo_daily ORDER BY total_events DESC, repo_name, event_date LIMIT 10""",
    "top_actors": """SELECT event_date, actor_login, total_commits, push_count, repos_touched
  FROM actor_daily ORDER BY total_commits DESC, actor_login, event_date LIMIT 10""",
    "top_repos_15": """SELECT event_date, repo_name, total_events, push_count, stars, forks
  FROM repo_daily ORDER BY total_events DESC, repo_name, event_date LIMIT 15""",
    "top_actors_15": """SELECT event_date, actor_login, total_commits, push_count, repos_touched
  FROM actor_daily ORDER BY total_commits DESC, actor_login, event_date LIMIT 15""",
    "top_push_repos": """SELECT repo_name, COUNT(*) AS pushes FROM bronze WHERE type = 'PushEvent'
  GROUP BY repo_name ORDER BY pushes DESC, repo_name NULLS FIRST LIMIT 10""",
    "top_push_actors": """SELECT actor_login, COUNT(*) AS pushes FROM bronze
  WHERE type = 'PushEvent' GROUP BY actor_login
  ORDER BY pushes DESC, actor_login NULLS FIRST LIMIT 10""",
    "top_starred_repos": """SELECT event_date, repo_name, push_count, stars, forks, total_events
  FROM repo_daily WHERE stars > 0 ORDER BY total_events DESC, repo_name, event_date LIMIT 200""",
    "event_type_counts": "SELECT type, COUNT(*) AS n FROM bronze GROUP BY type",
    "silver_type_counts": """SELECT type, COUNT(*) AS n FROM silver WHERE type IS NOT NULL
  GROUP BY type""",
    "event_type_counts_sampled": """SELECT COALESCE(type, 'unknown') AS type, COUNT(*) AS n
  FROM (SELECT type FROM bronze ORDER BY row_pos LIMIT 5000) GROUP BY 1""",
    "hourly_traffic": """SELECT CAST(hour(created_at) AS INT) AS hour, COUNT(*) AS events
  FROM silver GROUP BY 1""",
    "pr_action_share": f"""SELECT action, n, {_SHARE} AS percent FROM
  (SELECT action, COUNT(*) AS n FROM silver WHERE type = 'PullRequestEvent'
   AND action IS NOT NULL GROUP BY action)""",
    "repo_timeline": """SELECT id, type, actor_login, created_at FROM bronze
  WHERE repo_name = 'org/repo7'""",
    "explorer_search": """SELECT id, type, actor_login, repo_name, created_at, action, ref,
  commit_count, pr_number, issue_number FROM silver
  WHERE type = 'PushEvent' AND contains(lower(actor_login), '[bot]')
  ORDER BY created_at, id, type LIMIT 250""",
    "explorer_match_count": """SELECT COUNT(*) AS matches FROM silver
  WHERE type = 'PushEvent' AND contains(lower(actor_login), '[bot]')""",
    "explorer_search_pattern": """SELECT id, type, actor_login, repo_name, created_at, action, ref,
  commit_count, pr_number, issue_number FROM silver
  WHERE regexp_matches(lower(actor_login), '^(ci|auto)[0-9]*3')""",
    "distinct_types": "SELECT DISTINCT type FROM silver WHERE type IS NOT NULL",
    "bot_flag": """SELECT actor_login, is_bot, COUNT(*) AS n FROM (SELECT actor_login,
   COALESCE(suffix(lower(actor_login), '[bot]') OR suffix(lower(actor_login), '-bot'), FALSE)
   AS is_bot FROM silver) GROUP BY actor_login, is_bot""",
    "late_events": """SELECT * FROM (SELECT id, type, created_at, transformed_at,
   epoch_us(transformed_at) - epoch_us(created_at) AS lag_micros FROM silver)
  WHERE lag_micros > 86400000000""",
    "future_events": """SELECT row_pos, id, created_at, ingested_at FROM bronze
  WHERE created_at > ingested_at""",
    "layer_totals": """SELECT 'bronze' AS table_name, COUNT(*) AS n FROM bronze
  UNION ALL SELECT 'silver', COUNT(*) FROM silver
  UNION ALL SELECT 'quarantine', COUNT(*) FROM quarantine
  UNION ALL SELECT 'gold_repo', COUNT(*) FROM repo_daily
  UNION ALL SELECT 'gold_actor', COUNT(*) FROM actor_daily""",
    "checks_bronze": checks_sql("bronze"),
    "checks_silver": checks_sql("silver"),
    "checks_gold": checks_sql("gold_repo", "gold_actor"),
    "check_summary": _SUMMARY,
    "pending_files": """SELECT source_file FROM audit
  WHERE source_file NOT IN (SELECT source_file FROM done)""",
    "missing_hours": """SELECT source_file, day, hour FROM spine
  WHERE source_file NOT IN (SELECT source_file FROM done)""",
    "file_status": """SELECT s.day, s.hour, s.source_file,
  COALESCE(d.status, 'pending') AS status, d.bronze_rows, d.silver_rows, d.quarantine_rows,
  d.duplicate_rows, d.ingested_at FROM spine s LEFT JOIN done d USING (source_file)""",
    "ledger_totals": """SELECT COUNT(*) AS files_done,
  CAST(COALESCE(SUM(bronze_rows), 0) AS BIGINT) AS bronze_rows,
  CAST(COALESCE(SUM(silver_rows), 0) AS BIGINT) AS silver_rows,
  CAST(COALESCE(SUM(quarantine_rows), 0) AS BIGINT) AS quarantine_rows,
  CAST(COALESCE(SUM(duplicate_rows), 0) AS BIGINT) AS duplicate_rows,
  MAX(ingested_at) AS last_ingested FROM done""",
    "ledger_by_day": """SELECT day, COUNT(*) FILTER (WHERE status = 'done') AS files_done,
  MAX(ingested_at) FILTER (WHERE status = 'done') AS last_ingested,
  CAST(COALESCE(SUM(bronze_rows) FILTER (WHERE status = 'done'), 0) AS BIGINT) AS bronze_rows,
  CAST(COALESCE(SUM(silver_rows) FILTER (WHERE status = 'done'), 0) AS BIGINT) AS silver_rows,
  CAST(24 AS BIGINT) AS files_expected,
  COUNT(*) FILTER (WHERE status = 'done') >= 24 AS complete FROM ledger GROUP BY day""",
    "freshness_by_day": """SELECT day, files_done, last_ingested, hours_ago,
  CASE WHEN us < 24 * 3600000000 THEN 'Fresh' WHEN us < 48 * 3600000000 THEN 'Stale'
   ELSE 'Old' END AS status
  FROM (SELECT *, epoch_us(TIMESTAMP '2024-02-01') - epoch_us(last_ingested) AS us,
    CAST(floor(us / 3600000000.0) AS BIGINT) AS hours_ago
   FROM (SELECT day, COUNT(*) AS files_done, MAX(ingested_at) AS last_ingested
    FROM done GROUP BY day))""",
    "version_history": """SELECT row_number() OVER (ORDER BY batch_seq) - 1 AS idx, batch_seq,
  committed_at, CAST(SUM(added_rows) OVER (ORDER BY batch_seq) AS BIGINT) AS total_rows,
  added_rows FROM committed""",
    "read_as_of": f"""SELECT {SILVER_COLUMNS}, batch_seq FROM versioned WHERE batch_seq <=
  (SELECT MAX(batch_seq) FROM committed WHERE committed_at <= TIMESTAMP '2024-01-16')""",
    "version_row_delta": """SELECT before_rows, after_rows, after_rows - before_rows AS added_rows,
  CASE WHEN before_rows > 0 THEN ROUND(CAST(after_rows - before_rows AS DOUBLE) * 100.0
   / CAST(before_rows AS DOUBLE), 6) ELSE 0.0 END AS percent
  FROM (SELECT COUNT(*) FILTER (WHERE batch_seq <= 15) AS before_rows, COUNT(*) AS after_rows
   FROM versioned)""",
    "version_type_diff": """SELECT COALESCE(x.event_type, y.event_type) AS event_type,
  COALESCE(before_n, 0) AS before_n, COALESCE(after_n, 0) AS after_n,
  COALESCE(after_n, 0) - COALESCE(before_n, 0) AS diff
  FROM (SELECT type AS event_type, COUNT(*) AS before_n FROM versioned
   WHERE batch_seq <= 15 AND type <> 'GollumEvent' GROUP BY type) x
  FULL OUTER JOIN (SELECT type AS event_type, COUNT(*) AS after_n FROM versioned GROUP BY type) y
  ON x.event_type = y.event_type""",
    "version_new_rows": """SELECT id, type, actor_login, repo_name, created_at FROM versioned
  WHERE id IS NULL OR id NOT IN
   (SELECT id FROM versioned WHERE batch_seq <= 15 AND id IS NOT NULL)""",
    "version_new_rows_sample": """SELECT id, type, actor_login, repo_name, created_at FROM versioned
  WHERE id IS NULL OR id NOT IN
   (SELECT id FROM versioned WHERE batch_seq <= 15 AND id IS NOT NULL)
  ORDER BY created_at, id LIMIT 5""",
    "version_growth": """SELECT 'silver' AS table_name, COUNT(*) AS versions,
  CAST(SUM(added_rows) AS BIGINT) AS current_rows, MAX(committed_at) AS latest_at,
  COUNT(*) > 10 AS needs_expiry FROM committed
  UNION ALL SELECT 'bronze', COUNT(DISTINCT day(created_at)), COUNT(*),
   CAST(MAX(CAST(created_at AS DATE)) AS TIMESTAMP) + INTERVAL 1 DAY,
   COUNT(DISTINCT day(created_at)) > 10 FROM bronze""",
    "schema_evolved_union": f"""SELECT {SILVER_COLUMNS}, CASE WHEN batch_seq > 15 THEN
   COALESCE(suffix(lower(actor_login), '[bot]') OR suffix(lower(actor_login), '-bot'), FALSE)
   END AS is_bot FROM versioned""",
    "partition_scan_compare": """SELECT 'full' AS scan, type, COUNT(*) AS n FROM silver GROUP BY type
  UNION ALL SELECT 'one_day', type, COUNT(*) FROM silver
  WHERE event_date = DATE '2024-01-01' GROUP BY type""",
    # at these sizes a date is one file
    "partition_scan_cost": """SELECT scan, files_read, rows_scanned,
  ROUND(100.0 * CAST(whole - rows_scanned AS DOUBLE) / whole, 6) AS percent_saved
  FROM (SELECT 'full' AS scan, COUNT(DISTINCT event_date) AS files_read, COUNT(*) AS rows_scanned FROM silver
   UNION ALL SELECT 'one_day', COUNT(DISTINCT event_date), COUNT(*) FROM silver
   WHERE event_date = DATE '2024-01-01'), (SELECT COUNT(*) AS whole FROM silver)""",
    "quarantine_replay": """SELECT source_file, row_pos, id, old_type AS raw_type, old_reason,
  CASE WHEN id IS NULL OR id = '' THEN 'missing_id' END AS new_reason
  FROM (SELECT source_file, row_pos, id, type AS old_type, error_reason AS old_reason
   FROM classified WHERE error_reason IS NOT NULL)""",
    "incremental_resume": """SELECT source_file, 'done' AS status, bronze_rows, silver_rows,
  quarantine_rows, duplicate_rows FROM audit""",
    "stored_repo_daily": "SELECT * FROM repo_daily",
    "stored_new_rows": """SELECT id, type, actor_login, repo_name, created_at FROM silver
  WHERE event_date > DATE '2024-01-15' AND id NOT IN
   (SELECT id FROM silver WHERE event_date <= DATE '2024-01-15')""",
    "stored_versions": """SELECT idx, idx + 1 AS batch_seq,
  CAST(SUM(n) OVER (ORDER BY idx) AS BIGINT) AS total_rows, n AS added_rows
  FROM (SELECT CASE WHEN event_date <= DATE '2024-01-15' THEN 0 ELSE 1 END AS idx, COUNT(*) AS n
   FROM silver GROUP BY 1)""",
    # hours 3 to 6 of every fifth day are cut short, no gzip, without a byte, and still on their way
    "corrupt_file_guard": """SELECT source_file, CASE WHEN day(day) % 5 = 0 THEN
   CASE hour WHEN 3 THEN 'truncated gzip' WHEN 4 THEN 'bad gzip' WHEN 5 THEN 'empty file' END END AS fault
  FROM ledger0 WHERE NOT (day(day) % 5 = 0 AND hour = 6)""",
    "rejected_files": """SELECT source_file, CAST(CASE hour WHEN 5 THEN 2 ELSE 1 END AS BIGINT) AS rejections,
  CASE hour WHEN 3 THEN 'truncated gzip' WHEN 4 THEN 'bad gzip' ELSE 'empty file' END AS reason,
  hour <> 5 AS done, CASE WHEN hour <> 5 THEN bronze_rows END AS bronze_rows
  FROM ledger0 WHERE day(day) % 5 = 0 AND hour IN (3, 4, 5)""",
    # hour 7 of every fifth day comes in two parts, the odd events after the first run
    "hours_in_halves": """SELECT source_file, 'done' AS status, bronze_rows, silver_rows,
  quarantine_rows, duplicate_rows,
  CAST(CASE WHEN day(day) % 5 = 0 AND hour = 7 AND odd THEN 2 ELSE 1 END AS BIGINT) AS batch_seq
  FROM ledger0 JOIN (SELECT source_file, bool_or(row_pos // 2 % 2 = 1) AS odd FROM bronze GROUP BY 1)
   USING (source_file)""",
    "gold_after_crash": "SELECT *, 0 AS batches_made FROM actor_daily",
    "full_refresh_after_crash": f"""SELECT * EXCLUDE (ingested_at), 0 AS old_generation, 2 AS generation
  FROM (SELECT {SILVER_COLUMNS} FROM silver)""",
    "run_day_twice": """SELECT source_file, 'done' AS status, bronze_rows, silver_rows,
  quarantine_rows, duplicate_rows, 1 AS first_run, 0 AS second_run FROM ledger0 WHERE day = DATE '2024-01-05'""",
    "stored_stamps": """SELECT table_name, TIMESTAMP '2024-02-01' AS stamp, n FROM (
   SELECT 'bronze' AS table_name, COUNT(*) AS n FROM bronze UNION ALL SELECT 'silver', COUNT(*) FROM silver
   UNION ALL SELECT 'quarantine', COUNT(*) FROM quarantine
   UNION ALL SELECT 'repo_daily', COUNT(*) FROM repo_daily
   UNION ALL SELECT 'actor_daily', COUNT(*) FROM actor_daily)""",
    "stored_mixed_schema": f"""SELECT {SILVER_COLUMNS}, CASE WHEN batch_seq > 15 THEN
   COALESCE(suffix(lower(actor_login), '[bot]') OR suffix(lower(actor_login), '-bot'), FALSE)
   END AS is_bot, CAST(CASE WHEN batch_seq > 15 THEN 2 ELSE 1 END AS BIGINT) AS batch_seq FROM versioned""",
    "first_records": """SELECT CASE WHEN ok THEN type END AS type,
  CASE WHEN ok THEN id END AS id, CASE WHEN ok THEN actor_login END AS actor_login,
  CASE WHEN ok THEN repo_name END AS repo_name,
  CASE WHEN ok THEN strftime(created_at, '%Y-%m-%dT%H:%M:%S.%fZ') END AS created_at,
  CASE WHEN ok THEN 'id,type,actor,repo,created_at,public,payload' END AS top_level_keys
  FROM (SELECT *, json_valid(payload) AS ok FROM bronze)
  ORDER BY CAST(created_at AS DATE), hour(created_at), row_pos LIMIT 100""",
    "first_records_by_type": """SELECT COALESCE(type, 'unknown') AS type, COUNT(*) AS n
  FROM (SELECT CASE WHEN json_valid(payload) THEN type END AS type FROM bronze
   ORDER BY CAST(created_at AS DATE), hour(created_at), row_pos LIMIT 5000) GROUP BY 1""",
    "repos_starting": """SELECT repo_name, COUNT(*) AS n FROM silver
  WHERE starts_with(repo_name, 'org/repo1') GROUP BY 1""",
    "check_errors": f"""SELECT *, FALSE AS error FROM ({checks_sql("bronze")}) UNION ALL
  SELECT layer, check_no, check_name, metric, NULL, 'error', TRUE
  FROM ({checks_sql("silver", "gold_repo", "gold_actor")})""",
    "check_gate": f"""SELECT max_failures, total, bad, bad <= max_failures AS open
  FROM (SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE outcome IN ('fail','error')) AS bad
   FROM ({checks_sql(*CHECKS)})), (VALUES (0), (3), (47)) v(max_failures)""",
    "check_report": f"""SELECT layer, total, passed, warned, failed, errors, total AS details
  FROM ({_SUMMARY}) WHERE layer <> 'all'""",
    "streaming_contributors": """SELECT event_date, repo_name, unique_contributors,
  TRUE AS within_bound, TRUE AS merged_alike FROM repo_daily""",
    "streaming_ingest": """SELECT source_file, 'done' AS status, bronze_rows, silver_rows,
  quarantine_rows, duplicate_rows FROM audit""",
    # a row is too late when its hour ended the delay before the newest row of earlier periods
    "streaming_late_counts": """SELECT date_trunc('hour', created_at) AS hour_start,
  COUNT(*) FILTER (WHERE NOT late) AS events, COUNT(*) FILTER (WHERE late) AS dropped
  FROM (SELECT created_at, COALESCE(date_trunc('hour', created_at) + INTERVAL 13 HOUR <= newest, FALSE) AS late
   FROM (SELECT created_at, date_diff('day', DATE '1970-01-01', CAST(ingested_at AS DATE)) // 10 AS period
    FROM bronze) r
   LEFT JOIN (SELECT period, MAX(MAX(created_at)) OVER (ORDER BY period
     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
    FROM (SELECT created_at, date_diff('day', DATE '1970-01-01', CAST(ingested_at AS DATE)) // 10 AS period
     FROM bronze) GROUP BY period) m USING (period)) GROUP BY 1""",
    "streaming_distinct_events": """SELECT id, type, created_at + to_days(days) AS created_at
  FROM (SELECT DISTINCT id, type, created_at, repo_id FROM bronze WHERE id NOT IN ('', 'None'))
  JOIN (VALUES (0), (20)) v(days) ON days = 0 OR CAST(repo_id AS INT) % 3 = 0""",
    "activity_half_life": """SELECT repo_name, release_date, peak_date, peak, half_date,
  date_diff('day', peak_date, half_date) AS half_life_days FROM (
   SELECT p.repo_name, ANY_VALUE(p.release_date) AS release_date, ANY_VALUE(p.peak_date)
     AS peak_date, ANY_VALUE(p.peak) AS peak,
    MIN(CASE WHEN 2 * COALESCE(a.activity, 0) <= p.peak THEN s.day END) AS half_date
   FROM (SELECT r.repo_name, r.release_date, MAX(a.activity) AS peak,
      MIN_BY(a.event_date, (-a.activity, a.event_date)) AS peak_date
     FROM (SELECT repo_name, MIN(event_date) AS release_date FROM silver
       WHERE type = 'ReleaseEvent' AND repo_name IS NOT NULL GROUP BY repo_name) r
     JOIN (SELECT repo_name, event_date, COUNT(*) AS activity FROM silver GROUP BY ALL) a
      ON a.repo_name = r.repo_name AND a.event_date >= r.release_date
     GROUP BY r.repo_name, r.release_date) p
   JOIN (SELECT CAST(g.day AS DATE) AS day FROM generate_series(
      (SELECT CAST(MIN(event_date) AS TIMESTAMP) FROM silver),
      (SELECT CAST(MAX(event_date) AS TIMESTAMP) FROM silver), INTERVAL 1 DAY) g(day)) s
    ON s.day >= p.peak_date
   LEFT JOIN (SELECT repo_name, event_date, COUNT(*) AS activity FROM silver GROUP BY ALL) a
    ON a.repo_name = p.repo_name AND a.event_date = s.day
   GROUP BY p.repo_name)""",
    "streaming_hourly_counts": """SELECT date_trunc('hour', created_at) AS hour_start,
  COUNT(*) AS events, COUNT(*) FILTER (WHERE epoch_us(ingested_at) - epoch_us(created_at)
   > 86400000000) AS late_events FROM bronze GROUP BY 1""",
}


def statements() -> dict[str, str]:
    return {name: PREFIX + body for name, body in STATEMENTS.items()}
