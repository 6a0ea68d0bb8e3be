"""The row-wise and windowed parts of the preparation as a stream."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import hashing


def keyed(events: DataFrame, source: str, record_id: str = "source_record_id", ts: str = "ts") -> DataFrame:
    """Typed events with their stable ids; ``ts`` is an instant (TIMESTAMP) so that it can carry a watermark."""
    utc = F.to_utc_timestamp(F.col(ts), F.current_timezone()).cast("timestamp_ntz")
    return events.withColumn("event_id", hashing.event_id(F.lit(source), F.col(record_id), F.col("event_type"), utc))


def deduplicated(events: DataFrame, delay: str, ts: str = "ts") -> DataFrame:
    """Each event id once, as far as its copies come within ``delay``; state is dropped behind the watermark."""
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark(["event_id"])


def counts(events: DataFrame, delay: str, every: str, by: list[str], ts: str = "ts") -> DataFrame:
    """Events in tumbling windows by ``by``, final once the watermark has passed."""
    return events.withWatermark(ts, delay).groupBy(F.window(ts, every), *by).agg(F.count("*").alias("n"))


def gap_sessions(actions: DataFrame, delay: str, gap_seconds: int = 1800, client: str = "client_id", ts: str = "ts") -> DataFrame:
    """Sessions by gap alone, which Spark closes itself. A gap equal to the limit stays within a session."""
    # session_window ends a session at the gap: one more microsecond keeps the equal gap inside
    window = F.session_window(ts, f"{gap_seconds} seconds 1 microsecond")
    return actions.withWatermark(ts, delay).groupBy(client, window).agg(F.count("*").alias("n_actions"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


def sessions(actions: DataFrame, starts: list[str], delay: str, gap_seconds: int = 1800, client: str = "client_id", record_id: str = "source_record_id", action: str = "action", ts: str = "ts") -> DataFrame:
    """Sessions cut by start actions and gaps: ``client_id, source_record_id, first_ts, last_ts, n_actions``.

    Actions wait in the client's state until the watermark has passed them, so
    they are taken in order of time however they arrive; a session is emitted
    once a later one has begun or the watermark is past its gap.
    """
    schema = "client_id string, source_record_id string, first_ts timestamp, last_ts timestamp, n_actions long"
    # the state is one JSON text: actions that wait as [microseconds, id, starts], and the open session

    def step(key, batches: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        rows, first, last, first_id, n = json.loads(held.get[0]) if held.exists else ([], 0, 0, "", 0)
        for b in batches:
            rows += [[t.value // 1000, i, a in starts] for t, i, a in zip(b[ts], b[record_id], b[action])]
        mark = held.getCurrentWatermarkMs() * 1000
        gap = gap_seconds * 1_000_000
        rows.sort()
        out = []
        while rows and rows[0][0] <= mark:
            at, rid, start = rows.pop(0)
            if n and (start or at - last > gap):
                out.append((key[0], first_id, first, last, n))
                n = 0
            if not n:
                first, first_id = at, rid
            last, n = at, n + 1
        if n and mark - last > gap:  # whatever still waits is beyond the watermark, so beyond the gap
            out.append((key[0], first_id, first, last, n))
            n = 0
        if n or rows:
            held.update((json.dumps([rows, first, last, first_id, n]),))
            soon = rows[0][0] if rows else last + gap
            held.setTimeoutTimestamp(max(soon, mark) // 1000 + 1)
        elif held.exists:
            held.remove()
        done = pd.DataFrame(out, columns=["client_id", "source_record_id", "first_ts", "last_ts", "n_actions"]).astype({"n_actions": "int64"})
        yield done.assign(first_ts=pd.to_datetime(done["first_ts"], unit="us"), last_ts=pd.to_datetime(done["last_ts"], unit="us"))

    use = actions.select(client, record_id, ts, action).withWatermark(ts, delay)
    return use.groupBy(client).applyInPandasWithState(step, schema, "held string", "append", GroupStateTimeout.EventTimeTimeout)


def late(event_time: Column, processing_time: Column, hours: int) -> Column:
    """Whether an event came later than allowed; strict."""
    return processing_time > event_time + F.expr(f"interval {hours} hours")
