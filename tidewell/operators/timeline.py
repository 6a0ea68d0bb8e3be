"""Ordered timelines, calendar features, time deltas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import times
from . import ranges

ORDER = ["ts", "source_priority", "source_record_id"]


def ordering_key() -> Column:
    """A text whose order is that of ``ORDER``."""
    return F.concat_ws("|", times.render(F.col("ts")), F.lpad(F.col("source_priority").cast("string"), 6, "0"), F.col("source_record_id"))


def order_timeline(events: DataFrame, client: str = "client_id", heavy: int = ranges.HEAVY) -> DataFrame:
    """``events`` with ``position`` (from 0), ``ordering_key`` and ``tied`` (same instant as the event before).

    The key's text order is the position's: the instant has a fixed width.
    Clients of more than ``heavy`` events are put in order by several tasks.
    """
    key = ordering_key()
    tied = lambda before: F.coalesce(before == F.col("ts"), F.lit(False))

    def window(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(client).orderBy(*ORDER)
        return rows.withColumns({"position": (F.row_number().over(w) - 1).cast("long"), "ordering_key": key, "tied": tied(F.lag("ts").over(w))})

    def scan(rows: DataFrame) -> DataFrame:
        r = ranges.ranged(rows, client, ORDER).numbered("position").before("ts", "__before")
        return r.with_column("ordering_key", key).with_column("tied", tied(F.col("__before"))).done().drop("__before")

    return ranges.by_weight(events, client, window, scan, heavy)


def calendar(events: DataFrame) -> DataFrame:
    """``hour_of_day_local`` (0-23), ``day_of_week_local`` (Monday 0), ``lifetime_first``, ``calendar_shifted`` (differs from UTC)."""
    local = times.to_local(F.col("ts"), F.col("calendar_zone"))
    return events.withColumns({
        "hour_of_day_local": F.hour(local).cast("long"),
        "day_of_week_local": F.weekday(local).cast("long"),
        "lifetime_first": F.col("position") == 0,
        "calendar_shifted": (F.hour(local) != F.hour("ts")) | (F.weekday(local) != F.weekday("ts")),
    })


def deltas(events: DataFrame, client: str = "client_id", heavy: int = ranges.HEAVY) -> DataFrame:
    """``client, event_id, delta_seconds`` for every event but a client's first; a negative one is an error.

    Clients of more than ``heavy`` events are looked at by several tasks.
    """
    rows = events.select(client, "event_id", "ts", "position")

    def window(rows: DataFrame) -> DataFrame:
        return rows.withColumn("__before", F.lag("ts").over(Window.partitionBy(client).orderBy("position")))

    rows = ranges.by_weight(rows, client, window, lambda r: ranges.ranged(r, client, ["position"]).before("ts", "__before").done(), heavy)
    rows = rows.where("__before is not null")
    d = times.seconds_between(F.col("__before"), F.col("ts"))
    return rows.select(client, "event_id", F.when(d < 0, F.raise_error(F.lit("a timeline runs backwards"))).otherwise(d).cast("long").alias("delta_seconds"))
