import gzip
import json
from collections import Counter

from events_cases import NOW, event, write_hour
from pyspark.sql import functions as F

from cairnlake import fixtures
from cairnlake.sources import raw


def parse(spark, lines):
    rows = [(x if isinstance(x, str) else json.dumps(x), i) for i, x in enumerate(lines)]
    df = spark.createDataFrame(rows, "value STRING, row_pos BIGINT")
    return raw.to_bronze(df, NOW).orderBy("row_pos").collect()


def test_flattening(spark):
    rows = parse(spark, [
        {**event("1"), "id": 123},
        {"id": None, "type": "PushEvent", "actor": None, "payload": None},
        {"type": "PushEvent"},
        {"id": "4", "actor": "odd", "payload": {"b": 1.50, "a": [1, {"c": None}]}},
        {"id": "5", "created_at": "not a time", "payload": {}},
        *[{"id": "6", "payload": nothing} for nothing in ([], "", 0, False)],
    ])
    assert [r.payload for r in rows[5:]] == ["{}"] * 4
    first = rows[0]
    assert (first.id, first.actor_login, first.actor_id, first.repo_id) == ("123", "ann", "5", "7")
    assert str(first.created_at) == "2024-01-01 00:30:00"
    assert json.loads(first.payload) == {"size": 2, "ref": "refs/heads/main"}
    assert (rows[1].id, rows[1].actor_login, rows[1].payload) == (None, None, "{}")
    assert rows[2].id is None
    assert json.loads(rows[3].payload) == {"b": 1.5, "a": [1, {"c": None}]}
    assert rows[3].actor_login is None
    assert rows[4].created_at is None
    assert all(r.corrupt_record is None for r in rows)


def test_lines_that_are_not_json_stay_whole(spark):
    broken = ['{"id":"1","type":"PushEvent","payload":', "plain text", '{"id":"2"']
    rows = parse(spark, broken)
    assert [r.corrupt_record for r in rows] == broken
    assert all(r.id is None and r.type is None and r.payload is None for r in rows)


def test_scan_positions_follow_the_lines(spark, tmp_path):
    root = tmp_path / "raw"
    for hour in range(3):
        write_hour(root, 1, hour, [event(f"{hour}-{i:04d}") for i in range(500)])
    lines = raw.read_lines(spark, [str(p) for p in root.iterdir()])
    bronze = raw.to_bronze(lines, NOW).orderBy("source_file", "row_pos").collect()
    assert [r.id for r in bronze] == [f"{h}-{i:04d}" for h in range(3) for i in range(500)]
    assert {r.source_file for r in bronze} == {f"2024-01-01-{h}.json.gz" for h in range(3)}


def test_an_hour_may_be_a_folder_of_parts(spark, tmp_path):
    hour = tmp_path / "raw" / "2024-01-01-5.json.gz"
    for part in range(2):
        write_hour(hour, 2, part, [event(str(part))]).rename(hour / f"part-{part}.gz")
    listed = raw.list_files(spark, str(tmp_path / "raw"))
    assert {r.source_file for r in listed.collect()} == {"2024-01-01-5.json.gz"}
    lines = raw.read_lines(spark, [r.path for r in listed.collect()])
    assert lines.count() == 2


def test_gzip_faults(spark, tmp_path):
    root = tmp_path / "raw"
    good = write_hour(root, 1, 0, [event(str(i)) for i in range(2000)])
    data = good.read_bytes()
    (root / "2024-01-01-1.json.gz").write_bytes(data[: len(data) // 2])
    (root / "2024-01-01-2.json.gz").write_bytes(b"")
    (root / "2024-01-01-3.json.gz").write_bytes(data + gzip.compress(b"{}\n"))
    (root / "2024-01-01-4.json.gz").write_bytes(b"no gzip at all")
    (root / "2024-01-01-5.json.gz").write_bytes(data[:-6] + b"\0" * 6)  # wrong checksum
    faults = raw.gzip_faults(spark, raw.list_files(spark, str(root)))
    got = {r.source_file.split("-")[3].split(".")[0]: r.fault for r in faults.collect()}
    assert set(got) == {"1", "4", "5"}
    assert got["1"] == "truncated gzip"
    # a file listing of Spark leaves out files without a byte, so these are asked for by name
    names = [f"2024-01-01-{h}.json.gz" for h in range(24)]
    empty = raw.zero_byte_files(spark, str(root), names)
    assert empty == {"2024-01-01-2.json.gz": "empty file"}


def test_declared_scan_and_preview(spark, tmp_path):
    path = write_hour(tmp_path, 1, 0, [event("1"), event("2", "WatchEvent")])
    rows = raw.read_declared(spark, [str(path)]).orderBy("id").collect()
    assert [(r.id, r.actor_login, r.public) for r in rows] == [("1", "ann", True), ("2", "ann", True)]
    assert json.loads(rows[0].payload)["size"] == 2
    broken = write_hour(tmp_path, 1, 1, [event("3"), "{half"])
    rows = raw.read_declared(spark, [str(broken)]).collect()
    assert sorted((r.id or "", r.corrupt_record or "") for r in rows) == [("", "{half"), ("3", "")]
    head = raw.preview(raw.read_lines(spark, [str(path)]), 1).collect()
    assert len(head) == 1
    assert head[0].top_level_keys == "id,type,actor,repo,public,created_at,payload"


def test_line_scan_reads_each_text_once(spark):
    df = spark.createDataFrame([("{}", 1)], "value STRING, row_pos BIGINT")
    plan = raw.to_bronze(df, NOW).where(F.col("corrupt_record").isNull())
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("json_tuple(value") == 1


def test_gzip_faults_of_many_files_in_few_tasks(spark, tmp_path):
    root = tmp_path / "raw"
    whole = write_hour(root, 1, 0, [event(str(i)) for i in range(3000)]).read_bytes()
    for hour in range(1, 20):
        data = whole + gzip.compress(b"") * hour  # members without content
        cut = len(data) - 3 if hour % 4 == 0 else len(data)
        (root / f"2024-01-01-{hour}.json.gz").write_bytes(data[:cut])
    (root / "2024-01-02-0.json.gz").write_bytes(b"\n")
    (root / "2024-01-02-1.json.gz").write_bytes(whole + b"\n")  # something after the last member
    (root / "2024-01-02-2.json.gz.tmp").write_bytes(whole[:10])
    got = {r.source_file: r.fault.split(":")[0] for r in raw.faulty_parts(spark, str(root)).collect()}
    cut = {f"2024-01-01-{h}.json.gz": "truncated gzip" for h in range(4, 20, 4)}
    assert got.items() >= cut.items()
    assert set(got) - set(cut) == {"2024-01-02-0.json.gz", "2024-01-02-1.json.gz"}


def test_first_lines_read_no_more_hours_than_needed(spark, tmp_path):
    root = tmp_path / "raw"
    for hour in (10, 2, 3):
        write_hour(root, 1, hour, [event(f"{hour}-{i}") for i in range(10)])
    write_hour(root, 2, 0, ["{}"] * 10)

    def ids(n):
        rows = raw.first_lines(spark, str(root), n)
        return [json.loads(r.value).get("id") for r in rows.collect()], len(rows.inputFiles())

    in_order = [f"{h}-{i}" for h in (2, 3, 10) for i in range(10)]
    assert ids(4) == (in_order[:4], 1)
    assert ids(15) == (in_order[:15], 2)
    assert ids(30)[0] == in_order
    assert len(ids(100)[0]) == 40
    assert raw.first_lines(spark, str(tmp_path / "raw" / "2024-01-02-0.json.gz"), 3).count() == 3


def test_a_landed_hour_is_one_part_unless_it_is_large(spark, tmp_path, monkeypatch):
    """However far apart the positions of its rows lie; a large hour is cut by position."""
    hours = [("2024-01-01-0.json.gz", 3), ("2024-01-01-1.json.gz", 9)]
    rows = [(f"{h} {i}", h, i * 70_000_000) for h, n in hours for i in range(n)]
    lines = spark.createDataFrame(rows, "value STRING, source_file STRING, row_pos BIGINT")
    parts = {}
    for limit in (5_000_000, 5):
        monkeypatch.setattr(fixtures, "ROWS_PER_PART", limit)
        root = f"{tmp_path}/{limit}"
        fixtures.write_hour_files(lines, root)
        found = raw.list_files(spark, root).collect()
        parts[limit] = Counter(r.source_file for r in found)
        read = raw.read_lines(spark, [r.path for r in found]).select("value", "source_file")
        assert sorted(map(tuple, read.collect())) == sorted((v, h) for v, h, _ in rows)
    assert parts[5_000_000] == {h: 1 for h, _ in hours}
    assert parts[5][hours[0][0]] == 1 and parts[5][hours[1][0]] > 1
