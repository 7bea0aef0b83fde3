"""Hourly volumes: the stream gives the batch answer, whatever the batches and restarts."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from oncallmart.streaming import hourly as H

START = datetime(2024, 1, 1)


def write(spark, folder, minutes, first=0):
    rows = [(first + k, None if m is None else START + timedelta(minutes=m), "ab"[k % 2]) for k, m in enumerate(minutes)]
    spark.createDataFrame(rows, H.EVENTS).coalesce(1).write.mode("append").parquet(folder)


def run(spark, source, out, state):
    H.load_volume(H.event_stream(spark, source, 1), out, state).awaitTermination()


def rows(frame):
    return sorted((r.hour.isoformat(), r.event_type, r.volume) for r in frame.collect())


def batch(spark, source, keep):
    """Counts of the events that `keep` selects."""
    return (
        spark.read.schema(H.EVENTS).parquet(source).where(keep).where("ts is not null")
        .groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour"), "event_type")
        .agg(F.count("*").alias("volume"))
    )


def test_late_rows_restart_and_open_windows(spark, tmp_path):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    write(spark, source, [5, 20, 59, None])
    run(spark, source, out, state)
    assert rows(H.volume(spark, out)) == []
    # Out of order, but inside the watermark; the newest closes the first hour.
    write(spark, source, [55, 65, 130], 100)
    run(spark, source, out, state)
    first = rows(H.volume(spark, out))
    assert first == rows(batch(spark, source, "ts < timestamp'2024-01-01 02:00:00'"))
    # Three rows of closed hours come too late, one of an open hour does not.
    write(spark, source, [1, 3, 70, 125, 260], 200)
    run(spark, source, out, state)
    late = "event_id in (200, 201, 202)"
    done = rows(H.volume(spark, out))
    assert done == rows(batch(spark, source, f"ts < timestamp'2024-01-01 04:00:00' and not {late}"))
    assert set(first) <= set(done)
    assert rows(H.open_volume(spark, state)) == rows(batch(spark, source, "ts >= timestamp'2024-01-01 04:00:00'"))
    assert H.late_rows(spark.read.schema(H.EVENTS).parquet(source), out, state) == 3
    # Nothing new: nothing is published twice.
    run(spark, source, out, state)
    assert rows(H.volume(spark, out)) == done


def test_whole_table_gives_the_batch_answer(spark, small, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    source = f"{small}/events.parquet*"
    run(spark, source, out, state)
    found = rows(H.volume(spark, out)) + rows(H.open_volume(spark, state))
    assert sorted(found) == rows(batch(spark, source, "true"))
    assert H.late_rows(spark.read.schema(H.EVENTS).parquet(source), out, state) == 0
