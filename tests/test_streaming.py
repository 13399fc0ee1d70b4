import datetime as dt

from events_cases import UTC, bronze_rows

from cairnlake.streaming import hourly

T0 = dt.datetime(2024, 1, 1, tzinfo=UTC)


def batch(spark, path, rows):
    made = bronze_rows(spark, [
        {"id": i, "created_at": T0 + dt.timedelta(minutes=m),
         "ingested_at": T0 + dt.timedelta(minutes=m) + dt.timedelta(hours=late)}
        for i, m, late in rows
    ])
    made.coalesce(1).write.mode("append").parquet(str(path))
    return made.schema


def test_stream_equals_batch_over_several_micro_batches(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "chk"))
    schema = batch(spark, source, [("1", 5, 1), ("2", 30, 30), ("3", 70, 1)])

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        hourly.write_updates(
            hourly.hourly_counts(stream, "10 days"), sink, checkpoint).awaitTermination()

    run()
    batch(spark, source, [("4", 10, 1), ("5", 200, 25)])  # an hour already counted gets a row
    run()
    got = sorted(map(tuple, hourly.latest(spark.read.parquet(sink)).collect()))
    want = sorted(map(tuple, hourly.hourly_counts(spark.read.parquet(source)).collect()))
    assert got == want
    assert [r[1:] for r in got] == [(3, 1), (1, 0), (1, 1)]


def test_distinct_within_a_delay(spark, tmp_path):
    source = str(tmp_path / "in")
    schema = batch(spark, source, [("1", 5, 0), ("1", 6, 0), ("2", 7, 0)])
    stream = spark.readStream.schema(schema).parquet(source)
    query = (
        hourly.distinct_within(stream, "1 hour").writeStream.format("parquet")
        .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "chk"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["1", "2"]


def arriving(spark, rows):
    """Rows (id, created hour, arrived hour) that came at the hours given."""
    made = [
        {"id": i, "created_at": T0 + dt.timedelta(hours=h), "ingested_at": T0 + dt.timedelta(hours=a)} for i, h, a in rows
    ]
    return bronze_rows(spark, made).select("id", "created_at", "ingested_at")


def test_rows_behind_the_watermark_are_counted(spark, tmp_path):
    day = 24
    rows = [("1", 1, 2), ("2", 30, 31), ("3", 29, 2 * day), ("4", 12, 2 * day), ("5", 2 * day, 2 * day), ("6", 1, 4 * day)]
    counts = []
    for name, watermark in (("kept", "12 hours"), ("total", "1000 days")):
        base = str(tmp_path / name)

        def start(stream):
            return hourly.write_updates(hourly.hourly_counts(stream, watermark), f"{base}/updates", f"{base}/checkpoint")

        hourly.run_by_arrival(arriving(spark, rows), base, 1, start)
        counts.append(hourly.latest(spark.read.parquet(f"{base}/updates")))
    got = {int((r.hour_start - T0.replace(tzinfo=None)).total_seconds() // 3600): (r.events, r.dropped)
           for r in hourly.with_dropped(*counts).collect()}
    # 4 is more than 12 hours behind 2, which had come a day before; 3 is not; 6 is behind 5
    assert got == {1: (1, 1), 12: (0, 1), 29: (1, 0), 30: (1, 0), 48: (1, 0)}


def test_repeats_are_forgotten_after_the_delay(spark, tmp_path):
    day = 24
    rows = [("a", 1, 2), ("a", 2, 3), ("b", 5, 6), ("b", 20, day + 1), ("x", 3 * day, 3 * day), ("y", 5 * day, 5 * day),
            ("a", 6 * day, 6 * day), ("a", 6 * day + 1, 6 * day + 1)]
    base = str(tmp_path)

    def start(stream):
        return hourly.write_rows(hourly.distinct_within(stream, "30 hours"), f"{base}/rows", f"{base}/checkpoint")

    hourly.run_by_arrival(arriving(spark, rows), base, 1, start)
    assert sorted(r.id for r in spark.read.parquet(f"{base}/rows").collect()) == ["a", "a", "b", "x", "y"]
