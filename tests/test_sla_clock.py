"""SLA clock: the stream gives the batch answer, whatever the batches and restarts."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from oncallmart.sources import fixtures
from oncallmart.streaming import sla_clock as C

START = datetime(2024, 1, 1)
LATE = timedelta(hours=1)
HOURS = {"1 - Crítica": 4, "2 - Alta": 4, "3 - Moderada": 12, "4 - Baixa": 24, "5 - Muito Baixa": 96, "?": 96, None: 96}


def hour(n):
    return None if n is None else START + timedelta(hours=n)


def write(spark, folder, records):
    rows = [(number, priority, hour(opened), hour(stopped)) for number, priority, opened, stopped in records]
    spark.createDataFrame(rows, C.RECORDS).coalesce(1).write.mode("append").parquet(folder)


def run(spark, source, out, state):
    C.load_alerts(C.record_stream(spark, source, 1), out, state).awaitTermination()
    found = [tuple(r) for r in C.told(spark, out).collect()]
    assert len(found) == len(set(found))
    return sorted(found)


def batch(records, until):
    """Alerts of all records once the newest of them is of hour `until`."""
    running, stopped = set(), {}
    for number, priority, opened, end in records:
        if number is None or opened is None:
            continue
        running.add((number, opened, HOURS[priority]))
        if end is not None:
            stopped[number, opened] = min(end, stopped.get((number, opened), end))
    return sorted(
        (number, hour(opened), hour(opened + limit), limit)
        for number, opened, limit in running
        if hour(opened + limit) <= hour(until) - LATE
        and stopped.get((number, opened), opened + limit + 1) > opened + limit
    )


def test_late_repeated_and_never_closed_tickets(spark, tmp_path):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    first = [
        ("in-time", "1 - Crítica", 0, None), ("never", "2 - Alta", 0, None), ("after", "1 - Crítica", 0, None),
        ("late", "1 - Crítica", 0.5, None), (None, "1 - Crítica", 0, None), ("no-time", "1 - Crítica", None, None),
        ("long", "?", 0, None), ("no-priority", None, 0, None), ("in-time", "1 - Crítica", 0, 3),
    ]
    write(spark, source, first)
    assert run(spark, source, out, state) == []
    # The watermark stands at 4.2 hours after this batch: `late` has until 4.5.
    second = [("clock", "4 - Baixa", 5.2, None), ("after", "1 - Crítica", 0, 4.8)]
    write(spark, source, second)
    assert run(spark, source, out, state) == batch(first + second, 5.2)
    # `late` was resolved in time and its record is out of order, but inside the bound; the
    # openings and a resolution are repeated and change nothing.
    third = [("late", "1 - Crítica", 0.5, 4.4), ("after", "1 - Crítica", 0, 4.8), *first, ("clock2", "4 - Baixa", 9, None)]
    write(spark, source, third)
    done = run(spark, source, out, state)
    assert done == batch(first + second + third, 9) and [r[0] for r in done] == ["after", "never"]
    # The ticket is decided: its resolution comes too late.
    fourth = [("never", "2 - Alta", 0, 3), ("clock3", "1 - Crítica", 200, None)]
    write(spark, source, fourth)
    done = run(spark, source, out, state)
    assert done == batch(first + second + third + fourth[1:], 200)
    assert [r[0] for r in done] == ["after", "clock", "clock2", "long", "never", "no-priority"]
    # Resolved long after the alert: no second one, nor when it is repeated.
    write(spark, source, [("never", "2 - Alta", 0, 250), ("never", "2 - Alta", 0, 250)])
    write(spark, source, [("never", "2 - Alta", 0, 250), ("end", "1 - Crítica", 400, None)])
    write(spark, source, [("never", "2 - Alta", 0, 250), ("end", "1 - Crítica", 400, None)])
    again = run(spark, source, out, state)
    assert again == sorted(done + [("clock3", hour(200), hour(204), 4)])
    assert run(spark, source, out, state) == again


def test_any_batches_give_the_batch_answer(spark, tmp_path):
    drawn = random.Random(7)
    records = []
    for k in range(150):
        opened = drawn.randrange(0, 400) / 4
        priority = drawn.choice(list(HOURS))
        records.append((f"T{k}", priority, opened, None))
        if drawn.random() < 0.7:
            records.append((f"T{k}", priority, opened, opened + drawn.choice([0.5, 3.75, 4, 4.25, 12, 12.25, 30, 100])))
    # Delivered by time, up to 50 minutes out of order, some twice.
    records += drawn.choices(records, k=30)
    delivered = sorted(records, key=lambda r: (r[2] if r[3] is None else r[3]) + drawn.random() * 0.8)
    newest = max(r[2] if r[3] is None else r[3] for r in records)
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    for k in range(4):
        write(spark, source, delivered[k * len(delivered) // 4:(k + 1) * len(delivered) // 4])
        if k % 2:
            done = run(spark, source, out, state)
    assert done == batch(records, newest) and len(done) > 30
    once = run(spark, source, str(tmp_path / "out1"), str(tmp_path / "state1"))
    assert once == done


def test_changed_priority_runs_two_clocks(spark, tmp_path):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    records = [
        ("up", "4 - Baixa", 0, None), ("up", "1 - Crítica", 0, None), ("up", "1 - Crítica", 0, 10),
        ("down", "1 - Crítica", 0, None), ("down", "4 - Baixa", 0, 3), ("clock", "4 - Baixa", 50, None),
    ]
    write(spark, source, records)
    # Resolved after the strict limit and before the other; the second in time for both.
    assert run(spark, source, out, state) == [("up", hour(0), hour(4), 4)] == batch(records, 50)


def test_empty_table_and_whole_tickets(spark, small, tmp_path):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    spark.createDataFrame([], C.RECORDS).write.parquet(source)
    assert run(spark, source, out, state) == []
    tickets = fixtures.bronze(spark, small)
    made = C.ticket_records(tickets)
    assert made.count() == tickets.count() + tickets.where("Resolvido is not null").count()
    assert made.where(F.col("Resolvido").isNull()).count() == tickets.count()
