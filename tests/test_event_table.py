"""The event table: which months an append writes, rival appends, keys without a time, reading a month back."""

import datetime as dt
import hashlib
import pathlib

import pytest
from pyspark.sql import functions as F

from foghorn.plans import events
from foghorn.sources import event_table, readers, sinks

SCHEMA = "company_id string, url string, ts timestamp, signal_strength double"


def day(month, n=1):
    return dt.datetime(2024, month, n, 12)


@pytest.fixture()
def frame(spark):
    return lambda *rows: spark.createDataFrame(list(rows), SCHEMA)


def files(table):
    found = pathlib.Path(table).rglob("*.parquet")
    return {str(p): hashlib.sha256(p.read_bytes()).hexdigest() for p in found if p.is_file()}


def state(spark, table):
    return {(r["company_id"], r["url"], r["ts"]): r["signal_strength"] for r in event_table.read(spark, table).collect()}


def test_append_rewrites_only_the_months_it_touches(spark, frame, tmp_path):
    table = str(tmp_path / "t")
    first = frame(("1", "a", day(1), 1.0), ("1", "a", day(2), 2.0), ("2", "b", day(3), 3.0), ("3", "c", None, 4.0))
    assert event_table.append(spark, table, first) == 4
    before = files(table)
    assert event_table.append(spark, table, frame(("1", "a", day(2), 9.0), ("5", "n", day(2, 5), 5.0))) == 1
    after = files(table)
    assert {p: h for p, h in before.items() if "month=2024-02" not in p}.items() <= after.items()
    assert all("month=2024-02" in p for p in set(before) ^ set(after))
    assert state(spark, table) == {
        ("1", "a", day(1)): 1.0, ("1", "a", day(2)): 9.0, ("2", "b", day(3)): 3.0,
        ("3", "c", None): 4.0, ("5", "n", day(2, 5)): 5.0,
    }
    assert event_table.latest(spark, table).rows == 5


def test_rival_appends_lose_nothing(spark, frame, tmp_path):
    table = str(tmp_path / "t")
    event_table.append(spark, table, frame(("1", "a", day(1), 1.0)))
    pending = [frame(("2", "b", day(1), 2.0)), frame(("3", "c", day(4), 3.0))]

    def rival():
        if pending:
            event_table.append(spark, table, pending.pop())

    assert event_table.append(spark, table, frame(("4", "d", day(1), 4.0)), before_commit=rival) == 1
    assert {k[0]: v for k, v in state(spark, table).items()} == {"1": 1.0, "2": 2.0, "3": 3.0, "4": 4.0}
    folders = {p.name.split("=")[1] for p in pathlib.Path(table).glob("month=*/version=*")}
    assert folders == {m["version"] for m in event_table.latest(spark, table).months.values()}
    assert not list(pathlib.Path(table).glob("_manifest/*.tmp"))


def test_key_without_a_time_finds_its_month(spark, frame, tmp_path):
    table = str(tmp_path / "t")
    rows = [(str(i), f"u{i}", day(1 + i % 6, 1 + i % 20), float(i)) for i in range(60)]
    event_table.append(spark, table, frame(*rows), key=["url"])
    before = files(table)
    assert event_table.append(spark, table, frame(("x", "u7", day(8), -1.0), ("y", "new", day(8), -2.0)), key=["url"]) == 1
    after = files(table)
    months = {p.split("month=")[1][:7] for p in set(before) ^ set(after)}
    assert months == {"2024-02", "2024-08"}
    got = {r["url"]: r["signal_strength"] for r in event_table.read(spark, table).collect()}
    assert got == {f"u{i}": float(i) for i in range(60)} | {"u7": -1.0, "new": -2.0}


def test_other_key_rewrites_all_months(spark, frame, tmp_path):
    table = str(tmp_path / "t")
    event_table.append(spark, table, frame(("1", "a", day(1), 1.0), ("2", "b", day(2), 2.0)))
    assert event_table.append(spark, table, frame(("9", "a", day(3), 3.0)), key=["url"]) == 0
    assert {k[:2] for k in state(spark, table)} == {("9", "a"), ("2", "b")}
    assert "2024-01" not in event_table.latest(spark, table).months


def test_months_are_read_by_time(spark, frame, tmp_path):
    table = str(tmp_path / "t")
    event_table.append(spark, table, frame(*[("1", f"u{m}-{d}", day(m, d), 1.0) for m in (1, 2, 3) for d in (1, 15)], ("0", "z", None, 0.0)))
    part = event_table.read(spark, table, "2024-02-01", "2024-03-02")
    assert sorted(r["url"] for r in part.collect()) == ["u2-1", "u2-15", "u3-1"]
    assert len(part.inputFiles()) < len(event_table.read(spark, table).inputFiles())
    assert all("2024-02" in f or "2024-03" in f for f in part.inputFiles())
    assert event_table.read(spark, table, "2025-01-01").count() == 0
    assert event_table.read(spark, str(tmp_path / "none")).count() == 0


def test_plain_folder_is_taken_over(spark, frame, tmp_path):
    table = str(tmp_path / "t")
    frame(("1", "a", day(1), 1.0)).withColumn("signal_type", F.lit("")).write.parquet(table)
    assert sinks.append_events(spark, table, frame(("1", "a", day(1), 2.0), ("2", "b", day(2), 3.0))) == 1
    assert {k[0]: v for k, v in state(spark, table).items()} == {"1": 2.0, "2": 3.0}
    assert readers.read_events(spark, table).count() == 2 == spark.read.parquet(table).count()


def test_nothing_to_append(spark, frame, tmp_path):
    table = str(tmp_path / "t")
    assert event_table.append(spark, table, frame()) == 0
    event_table.append(spark, table, frame(("1", "a", day(1), 1.0)))
    before = files(table)
    assert event_table.append(spark, table, frame()) == 0
    assert files(table) == before


def test_append_moves_rows_once_and_leaves_nothing_behind(spark, frame, tmp_path):
    from foghorn.session import ensure_checkpoint_dir

    table, shared = str(tmp_path / "t"), pathlib.Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(shared.iterdir())
    rows = [(str(i % 50), f"u{i}", day(1 + i % 3, 1 + i % 9), float(i)) for i in range(400)]
    event_table.append(spark, table, frame(*rows))
    assert event_table.append(spark, table, frame(*rows)) == 0
    assert set(shared.iterdir()) == before
    # also where a column of the batch is a constant, and for a first append
    batch = events.canonical_events(frame(*rows).drop("url"))
    for old in (event_table.read(spark, table), event_table.read(spark, str(tmp_path / "none"))):
        ranged = event_table._ranged(events.both_batches(old, batch), "v", events.EVENT_KEY)
        plan = ranged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        assert (plan.count("Exchange "), plan.count("Sort ")) == (1, 1)


@pytest.mark.parametrize("hot", [1_000_000, 3])
def test_last_of_equal_keys_stays_whatever_their_number(spark, frame, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(event_table, "HOT_ROWS", hot)
    table = str(tmp_path / "t")
    many = [("h", "u", day(1), float(i)) for i in range(50)] + [("n", None, None, float(i)) for i in range(40)]
    some = [(None, "u", day(2, 1 + i % 3), float(i)) for i in range(9)]
    assert event_table.append(spark, table, frame(*many, *some), source="a") == 5
    assert event_table.append(spark, table, frame(("h", "u", day(1), -5.0), ("n", "", None, 7.0)), source="b") == 0
    assert state(spark, table) == {
        ("h", "u", day(1)): -5.0, ("n", "", None): 7.0,
        ("", "u", day(2, 1)): 6.0, ("", "u", day(2, 2)): 7.0, ("", "u", day(2, 3)): 8.0,
    }
    assert sorted(r["source"] for r in event_table.read(spark, table).collect()) == ["a", "a", "a", "b", "b"]


def test_key_of_fewer_columns_and_frame_without_event_columns(spark, frame, tmp_path):
    table, key = str(tmp_path / "t"), ["company_id", "ts"]
    rows = [("1", "a", day(1), 1.0), ("1", "b", day(1), 2.0), ("2", "a", day(1), 3.0)]
    assert event_table.append(spark, table, frame(*rows)) == 3
    assert event_table.append(spark, table, frame(("3", "c", day(1), 4.0)), key=key) == 0
    assert state(spark, table) == {("1", "b", day(1)): 2.0, ("2", "a", day(1)): 3.0, ("3", "c", day(1)): 4.0}
    assert event_table.append(spark, table, frame(("1", "z", day(1), 9.0), ("1", "y", day(1), 9.5)), key=key) == 0
    assert state(spark, table) == {("1", "y", day(1)): 9.5, ("2", "a", day(1)): 3.0, ("3", "c", day(1)): 4.0}
    assert event_table.append(spark, table, spark.range(2).select(F.lit("x").alias("other"))) == 1
