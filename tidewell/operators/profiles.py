"""Client profiles at the cutoff."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import times


def age_days(since: Column, cutoff: str) -> Column:
    """Whole days from an instant to the cutoff."""
    return F.floor(times.micros_between(since, F.lit(cutoff).cast("timestamp_ntz")) / F.lit(86_400_000_000)).cast("long")


def lifelong(events: DataFrame, cutoff: str, transactions: list[str], topup: Column, client: str = "client_id") -> DataFrame:
    """``event_count, transaction_count, first_seen_days, first_topup_days`` of each client, in one aggregation."""
    return events.groupBy(client).agg(
        F.count("*").alias("event_count"),
        F.count_if(F.col("event_type").isin(transactions)).alias("transaction_count"),
        age_days(F.min("ts"), cutoff).alias("first_seen_days"),
        age_days(F.min(F.when(topup, F.col("ts"))), cutoff).alias("first_topup_days"),
    )


def latest(snapshots: DataFrame, by: list[str], columns: list[str], client: str = "client_id") -> DataFrame:
    """Each client's last snapshot in the order of ``by``."""
    return snapshots.groupBy(client).agg(F.max_by(F.struct(*columns), F.struct(*by)).alias("s")).select(client, "s.*")


def build(snapshots: DataFrame, events: DataFrame, cutoff: str, by: list[str], columns: list[str], transactions: list[str], topup: Column, client: str = "client_id") -> DataFrame:
    """A row for each client with a snapshot or an event.

    Without a snapshot its columns are null and ``profile_ts`` is the cutoff;
    without events the two counts are 0 and the first-seen ages null.
    """
    last = latest(snapshots, by, list(dict.fromkeys(["ts", *columns])), client).withColumnRenamed("ts", "profile_ts")
    life = lifelong(events, cutoff, transactions, topup, client)
    both = last.join(life, client, "full_outer")
    return both.withColumns({
        "profile_missing": F.col("profile_ts").isNull(),
        "profile_ts": F.coalesce("profile_ts", F.lit(cutoff).cast("timestamp_ntz")),
        "event_count": F.coalesce("event_count", F.lit(0)),
        "transaction_count": F.coalesce("transaction_count", F.lit(0)),
    })
