"""Sessions from client actions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import times
from . import ranges


def numbered(actions: DataFrame, starts: list[str], gap_seconds: int = 1800, *, action: str = "action", client: str = "client_id", record_id: str = "source_record_id", heavy: int = ranges.HEAVY) -> DataFrame:
    """``actions`` with ``session_no``, the number of their session within the client."""
    new = F.col("__before").isNull() | F.col(action).isin(starts) | (times.micros_between(F.col("__before"), F.col("ts")) > gap_seconds * 1_000_000)
    new = F.coalesce(new, F.lit(True)).cast("long")

    def window(rows: DataFrame) -> DataFrame:
        order = Window.partitionBy(client).orderBy("ts", record_id)
        rows = rows.withColumn("__before", F.lag("ts").over(order)).withColumn("__new", new)
        return rows.withColumn("session_no", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)))

    def scan(rows: DataFrame) -> DataFrame:
        r = ranges.ranged(rows, client, ["ts", record_id]).before("ts", "__before").with_column("__new", new)
        return r.summed("__new", "session_no").done()

    return ranges.by_weight(actions, client, window, scan, heavy)


def sessionize(actions: DataFrame, starts: list[str], gap_seconds: int = 1800, *, action: str = "action", screen: str = "screen", client: str = "client_id", record_id: str = "source_record_id", carry: list[str] = (), heavy: int = ranges.HEAVY) -> DataFrame:
    """One row for each session: ``client, session_no, source_record_id, ts, duration_seconds, n_actions, screens_count,
    first_screen, last_screen, screens`` and the first action's ``carry`` columns.

    Actions of a client in order of (ts, record id). A session begins at the
    client's first action, at a start action, and after a gap strictly longer
    than ``gap_seconds``. ``screens`` are the distinct non-null screens as first
    seen; the last screen is the last *new* one. Rows with a null client form
    one client of their own; no actions, no sessions. Clients of more than
    ``heavy`` actions are cut into sessions by several tasks, and what a session
    gathers is one entry for each of its screens, however often it was seen.
    """
    rows = numbered(actions, starts, gap_seconds, action=action, client=client, record_id=record_id, heavy=heavy)
    key = F.struct("ts", record_id)
    each = rows.groupBy(client, "session_no", F.col(screen).alias("__screen")).agg(
        F.min(key).alias("__key"),
        F.max("ts").alias("__end"),
        F.count("*").alias("__n"),
        *[F.min_by(c, key).alias(c) for c in carry],
    )
    seen = F.array_sort(F.collect_list(F.when(F.col("__screen").isNotNull(), F.struct("__key", "__screen"))))
    out = each.groupBy(client, "session_no").agg(
        F.min("__key")[record_id].alias(record_id),
        F.min("__key")["ts"].alias("ts"),
        times.seconds_between(F.min("__key")["ts"], F.max("__end")).alias("duration_seconds"),
        F.sum("__n").alias("n_actions"),
        F.transform(seen, lambda s: s["__screen"]).alias("screens"),
        *[F.min_by(c, "__key").alias(c) for c in carry],
    )
    out = out.withColumn("screens_count", F.size("screens").cast("long"))
    return out.withColumn("first_screen", F.try_element_at("screens", F.lit(1))).withColumn("last_screen", F.try_element_at("screens", F.lit(-1)))
