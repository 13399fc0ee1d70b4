"""Event rows and landed hours that several tests make."""

import datetime as dt
import gzip
import json
from pathlib import Path

UTC = dt.timezone.utc
NOW = dt.datetime(2024, 1, 8, tzinfo=UTC)


def bronze_rows(spark, rows):
    """Rows given as dicts; everything not given has a plain default."""
    full = []
    for i, r in enumerate(rows):
        base = {
            "id": str(i), "type": "PushEvent", "actor_login": "ann", "actor_id": "1",
            "repo_name": "org/a", "repo_id": "7",
            "created_at": dt.datetime(2024, 1, 1, 0, 30, tzinfo=UTC), "payload": "{}",
            "ingested_at": dt.datetime(2024, 1, 1, 2, tzinfo=UTC),
            "source_file": "2024-01-01-0.json.gz", "row_pos": i,
        }
        full.append({**base, **r})
    schema = (
        "id STRING, type STRING, actor_login STRING, actor_id STRING, repo_name STRING, "
        "repo_id STRING, created_at TIMESTAMP, payload STRING, ingested_at TIMESTAMP, "
        "source_file STRING, row_pos BIGINT"
    )
    names = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in full], schema)


def event(id_, type_="PushEvent", login="ann", repo="org/a", day=1, hour=0, payload=None):
    return {
        "id": id_, "type": type_, "actor": {"id": 5, "login": login},
        "repo": {"id": 7, "name": repo}, "public": True,
        "created_at": f"2024-01-{day:02d}T{hour:02d}:30:00Z",
        "payload": {"size": 2, "ref": "refs/heads/main"} if payload is None else payload,
    }


def write_hour(root: Path, day: int, hour: int, lines) -> Path:
    root.mkdir(parents=True, exist_ok=True)
    path = root / f"2024-01-{day:02d}-{hour}.json.gz"
    with gzip.open(path, "wt") as f:
        for line in lines:
            f.write((line if isinstance(line, str) else json.dumps(line)) + "\n")
    return path


def write_part(hour: Path, part: int, lines) -> Path:
    """A gzip part of an hour landed as a folder."""
    hour.mkdir(parents=True, exist_ok=True)
    path = hour / f"part-{part}.gz"
    with gzip.open(path, "wt") as f:
        for line in lines:
            f.write((line if isinstance(line, str) else json.dumps(line)) + "\n")
    return path
