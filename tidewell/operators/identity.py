"""Identity and event-type look-ups against dictionaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A dictionary of at most so many rows is broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for a dictionary whose size was checked."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def resolve_identity(records: DataFrame, dictionary: DataFrame, source: str, ref: str, optional: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(records with ``client_id``, rejects with ``reason``).

    ``dictionary``: source, ref, client_id, one row for each pair. An empty or
    unknown reference is rejected; rows for which ``optional`` holds (reference
    data without a client) pass with a null ``client_id``.
    """
    d = small(dictionary.select(F.col("source").alias("__s"), F.col("ref").alias("__r"), "client_id"))
    joined = records.join(d, (F.col(source) == F.col("__s")) & (F.col(ref) == F.col("__r")), "left").drop("__s", "__r")
    fine = F.col("client_id").isNotNull() & (F.trim(F.col(ref)) != "")
    keep = F.coalesce(fine, F.lit(False)) | (optional if optional is not None else F.lit(False))
    return joined.where(keep), joined.where(~keep).drop("client_id").withColumn("reason", F.lit("unresolved_client_id"))


def map_events(records: DataFrame, codes: dict[str, str | None], code: str) -> tuple[DataFrame, DataFrame]:
    """(records with ``event_type``, rejects).

    A code that maps to None is known, and its row has no type of its own (a
    session's action, say); an unknown or null code is rejected.
    """
    known = F.coalesce(F.col(code).isin(list(codes)), F.lit(False))
    target = F.lit(None).cast("string")
    for c, t in codes.items():
        if t is not None:
            target = F.when(F.col(code) == c, t).otherwise(target)
    return records.where(known).withColumn("event_type", target), records.where(~known).withColumn("reason", F.lit("unknown_event_type"))
