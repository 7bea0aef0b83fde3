"""Versioned tables: merges against a dictionary, aborted loads, clean-up."""

import json
import random

import pytest
from pyspark.sql import functions as F

from oncallmart.sources import versions as V

SHAPE = "Numero string, Ano_Mes string, Aberto int, Resolvido int, Encerrado int, x string"


def load(spark, rows, path):
    return V.merge(spark.createDataFrame(rows, SHAPE), path)


def rows_of(spark, path, number=None):
    return sorted((tuple(r) for r in V.read(spark, path, number).collect()), key=str)


def test_merges_equal_a_dictionary(spark, tmp_path):
    path, pick, held = str(tmp_path / "t"), random.Random(3), {}
    for turn in range(5):
        rows = []
        for _ in range(60):
            k = pick.choice([None, *range(40)])
            key = None if k is None else f"INC{k}"
            rows.append((key, f"1998-{pick.randint(1, 6):02d}", 1, 2, pick.choice([None, 3, 4]), f"{turn}-{pick.randint(0, 2)}"))
        best = {}
        for r in rows:
            key = r[0] or ("row", r)
            rank = [(v is not None, v or 0) for v in (r[4], r[3], r[2])] + [r[0] or "", r[1], r[5]]
            if key not in best or rank > best[key][0]:
                best[key] = (rank, r)
        before, replaced = len(held), sum(k in held for k in best)
        held.update({k: r for k, (_, r) in best.items()})
        done = load(spark, rows, path)
        assert rows_of(spark, path) == sorted(held.values(), key=str)
        assert (done.before, done.replaced, done.brought) == (before, replaced, len(best))
        assert done.version.rows == len(held) and done.version.number == turn


def test_a_ticket_that_changes_its_month_moves(spark, tmp_path):
    path = str(tmp_path / "t")
    load(spark, [("a", "1998-01", 1, 1, 1, "old"), ("b", "1998-02", 1, 1, 1, "old")], path)
    load(spark, [("a", "1998-02", 1, 1, 1, "new")], path)
    assert rows_of(spark, path) == [("a", "1998-02", 1, 1, 1, "new"), ("b", "1998-02", 1, 1, 1, "old")]
    # The emptied month is no part of the table any more.
    assert list(V.version(spark, path).parts) == ["Ano_Mes=1998-02"]


def test_untouched_months_are_not_written_again(spark, tmp_path):
    path = str(tmp_path / "t")
    first = load(spark, [(f"k{m}", f"1998-{m:02d}", 1, 1, 1, "x") for m in range(1, 8)] + [("n", None, 1, 1, 1, "x")], path)
    second = load(spark, [("k3", "1998-03", 2, 2, 2, "y")], path)
    changed = {p for p in first.version.parts if first.version.parts[p] != second.version.parts[p]}
    assert changed == {"Ano_Mes=1998-03"} and len(second.version.parts) == 8
    load(spark, [("n", "1998-01", 1, 1, 1, "z")], path)
    assert [r[1] for r in rows_of(spark, path) if r[0] == "n"] == ["1998-01"]


def test_an_empty_load_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    load(spark, [("a", "1998-01", 1, 1, 1, "x")], path)
    done = load(spark, [], path)
    assert done.brought == 0 and rows_of(spark, path) == [("a", "1998-01", 1, 1, 1, "x")]
    assert load(spark, [], str(tmp_path / "new")).version.rows == 0
    assert rows_of(spark, str(tmp_path / "new")) == []


def test_a_new_column_is_null_in_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    load(spark, [("a", "1998-01", 1, 1, 1, "x"), ("b", "1998-02", 1, 1, 1, "x")], path)
    wider = spark.createDataFrame([("b", "1998-02", 1, 1, 1, "x", 5)], SHAPE + ", y int")
    V.merge(wider, path)
    assert {r.Numero: r.y for r in V.read(spark, path).collect()} == {"a": None, "b": 5}


@pytest.mark.parametrize("kind", ["publish", "merge"])
def test_readers_see_the_old_rows_whole_if_a_load_stops(spark, tmp_path, monkeypatch, kind):
    path = str(tmp_path / "t")
    rows = [(f"k{k}", "1998-01", k, k, k, "old") for k in range(50)]
    frame = spark.createDataFrame(rows, SHAPE)
    V.publish(frame, path, "Ano_Mes")
    reader = V.read(spark, path)

    def stop(*_):
        raise RuntimeError("the driver is lost")

    with monkeypatch.context() as broken:
        broken.setattr(V, "_commit", stop)
        with pytest.raises(RuntimeError):
            getattr(V, kind)(frame.withColumn("x", F.lit("new")), path, **({"month": "Ano_Mes"}))
    assert rows_of(spark, path) == sorted(rows, key=str)
    # The files of the stopped load are there and belong to no version until they are deleted.
    assert len(list((tmp_path / "t" / "data").glob("load=*"))) == 2
    V.publish(frame.withColumn("x", F.lit("new")), path, "Ano_Mes")
    assert reader.where("x = 'old'").count() == 50 and {r[5] for r in rows_of(spark, path)} == {"new"}
    assert V.clean(spark, path, keep=1, older_than=0) == 2
    assert len(rows_of(spark, path)) == 50 and len(list((tmp_path / "t" / "data").glob("load=*"))) == 1


def test_executors_that_fail_leave_the_old_version(spark, tmp_path):
    path = str(tmp_path / "t")
    V.publish(spark.range(10), path)
    broken = spark.range(10).select((F.col("id") + F.raise_error(F.lit("no"))).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        V.publish(broken, path)
    assert V.read(spark, path).count() == 10


def test_of_two_loads_at_once_one_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    made = V.publish(spark.range(3), path)
    late = V.Version(path, made.number, 1, made.parts, made.shape)
    with pytest.raises(V.Conflict):
        V._commit(spark, late)
    assert V.version(spark, path) == made
    assert not list((tmp_path / "t" / "_versions").glob("*.tmp"))


def test_lost_files_are_noticed_before_readers_see_them(spark, tmp_path):
    path = str(tmp_path / "t")
    load(spark, [("a", "1998-01", 1, 1, 1, "x"), ("b", "1998-02", 1, 1, 1, "x")], path)
    note = tmp_path / "t" / "_versions" / "0000000000.json"
    told = json.loads(note.read_text())
    told["rows"] += 1
    for old in note.parent.iterdir():
        old.unlink()
    note.write_text(json.dumps(told))
    with pytest.raises(V.LoadMismatch):
        load(spark, [("c", "1998-02", 1, 1, 1, "x")], path)
    assert V.version(spark, path).number == 0


def test_old_versions_can_be_read_until_they_are_cleaned(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (3, 5, 7):
        V.publish(spark.range(n), path)
    assert [V.read(spark, path, k).count() for k in (0, 1, 2)] == [3, 5, 7]
    assert V.clean(spark, path, keep=2, older_than=0) == 1
    assert V.read(spark, path, 1).count() == 5 and V.clean(spark, path, keep=2) == 0
    with pytest.raises(FileNotFoundError):
        V.read(spark, str(tmp_path / "none"))
