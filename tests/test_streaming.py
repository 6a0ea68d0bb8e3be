"""Streams over files, run to their end, against what a batch gives."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewell.streaming import stream

SCHEMA = "client_id string, source_record_id string, ts timestamp, action string, event_type string"


@pytest.fixture
def feed(spark, tmp_path):
    def put(batches):
        for i, rows in enumerate(batches):
            (tmp_path / "in").mkdir(exist_ok=True)
            file = tmp_path / "in" / f"{i:03}.json"
            file.write_text("".join(json.dumps(r) + "\n" for r in rows))
            os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))  # files are taken in order of their time
        return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))

    return put


def run(df, tmp_path, mode="append"):
    name = f"q{abs(hash(str(tmp_path))) % 10**9}"
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return df.sparkSession.table(name).collect()


def row(i, minute, action="open", client="c"):
    at = datetime(2024, 1, 1) + timedelta(minutes=minute)
    return {"client_id": client, "source_record_id": i, "ts": at.isoformat() + "Z", "action": action, "event_type": "T"}


def test_copies_go_once(feed, tmp_path):
    df = feed([[row("1", 0), row("1", 0)], [row("1", 0), row("2", 1)]])
    got = run(stream.deduplicated(stream.keyed(df, "s"), "1 hour"), tmp_path)
    assert sorted(r.source_record_id for r in got) == ["1", "2"]


def test_windows_close_behind_the_watermark(feed, tmp_path):
    df = feed([[row("1", 0), row("2", 5)], [row("3", 200)], [row("4", 201)]])
    got = run(stream.counts(df, "10 minutes", "1 hour", ["event_type"]), tmp_path)
    assert [r.n for r in got if r.window.start == min(x.window.start for x in got)] == [2]


def test_gap_sessions(feed, tmp_path):
    df = feed([[row("1", 0), row("2", 30)], [row("3", 61)], [row("4", 500)], [row("5", 501)]])
    got = run(stream.gap_sessions(df, "1 minute"), tmp_path)
    assert sorted(r.n_actions for r in got) == [1, 2]


def test_sessions_take_late_actions_in_order(feed, tmp_path):
    df = feed([[row("2", 10), row("1", 0, "LOGIN")], [row("4", 30, "LOGIN"), row("3", 20)], [row("9", 900)], [row("10", 901)]])
    got = sorted((r.source_record_id, r.n_actions) for r in run(stream.sessions(df, ["LOGIN"], "5 minutes"), tmp_path))
    assert got == [("1", 3), ("4", 1)]


def test_late(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), datetime(2024, 1, 1, 2)), (datetime(2024, 1, 1), datetime(2024, 1, 1, 2, 0, 1))], "a timestamp, b timestamp")
    assert [r[0] for r in df.select(stream.late(F.col("a"), F.col("b"), 2)).collect()] == [False, True]
