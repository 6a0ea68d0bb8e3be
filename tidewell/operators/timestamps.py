"""Calendar zones, instants, cutoff."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import times
from .identity import small

PARSERS = {"epoch_millis": times.from_millis, "date_iso": times.from_date, "iso_utc": times.from_iso_utc, "day_first": times.from_day_first, "iso_local": times.from_iso}


def zone_of(region: Column, mapping: dict[str, str]) -> Column:
    """The zone of a region, null where it is unknown."""
    out = F.lit(None).cast("string")
    for r, z in mapping.items():
        out = F.when(region == r, z).otherwise(out)
    return out


def client_zones(snapshots: DataFrame, cutoff: str, mapping: dict[str, str], zone: str, order: list[str], date: str = "snapshot_date", region: str = "region") -> DataFrame:
    """``client_id, client_zone``: the zone of the region in each client's last snapshot up to the cutoff.

    A snapshot's instant is its local midnight in ``zone``. Snapshots of an
    unknown region do not count; of equal instants the first in ``order`` wins.
    """
    at = times.to_utc(F.col(date), F.lit(zone))
    rows = snapshots.withColumn("__at", at).withColumn("__zone", zone_of(F.col(region), mapping))
    rows = rows.where(F.col("__zone").isNotNull() & (F.col("__at") <= F.lit(cutoff).cast("timestamp_ntz")))
    best = rows.groupBy("client_id", "__at").agg(F.min_by("__zone", F.struct(*order)).alias("z"))
    return best.groupBy("client_id").agg(F.max_by("z", "__at").alias("client_zone"))


def normalize(
    records: DataFrame, raw: str, kind: str, *, zone: Column | None = None, zone_is_given: bool = False, client_zones: DataFrame | None = None, default_zone: str | None = None,
    cutoff: str, horizon_days: int = 90, processed: Column | None = None, max_delay_hours: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(records with ``ts, calendar_zone, zone_fallback, is_future, is_late``, rejects).

    The zone is ``zone`` (a column; null means unknown and is rejected if
    ``zone_is_given``), else the client's, else the default, which sets
    ``zone_fallback``. ``is_future``: more than the horizon after the cutoff;
    ``is_late``: processed strictly later than the allowed delay.
    """
    rows = records
    if client_zones is not None:
        rows = rows.join(small(client_zones), "client_id", "left")
        chosen = F.coalesce("client_zone", F.lit(default_zone))
        rows = rows.withColumn("calendar_zone", chosen).withColumn("zone_fallback", F.col("client_zone").isNull()).drop("client_zone")
    else:
        chosen = zone if zone is not None else F.lit(default_zone)
        if not zone_is_given:
            chosen = F.coalesce(chosen, F.lit(default_zone))
        rows = rows.withColumn("calendar_zone", chosen.cast("string")).withColumn("zone_fallback", F.lit(False))
    local = PARSERS[kind](F.col(raw))
    instant = local if kind in ("epoch_millis", "iso_utc") else times.to_utc(local, F.col("calendar_zone"))
    rows = rows.withColumn("ts", instant)
    reason = F.when(F.col("calendar_zone").isNull(), "unknown_timezone").when(F.col("ts").isNull(), "missing_event_time")
    rows = rows.withColumn("reason", reason)
    good = rows.where("reason is null").drop("reason")
    limit = F.lit(cutoff).cast("timestamp_ntz") + F.expr(f"interval {horizon_days} days")
    late = F.lit(False)
    if processed is not None and max_delay_hours is not None:
        late = F.coalesce(times.micros_between(F.col("ts"), processed) > max_delay_hours * 3_600_000_000, F.lit(False))
    good = good.withColumn("is_future", F.col("ts") > limit).withColumn("is_late", late)
    return good, rows.where("reason is not null").drop("ts", "calendar_zone", "zone_fallback")


def up_to(records: DataFrame, cutoff: str) -> DataFrame:
    """Rows at or before the cutoff. A null instant is an error, not a dropped row."""
    checked = F.when(F.col("ts").isNull(), F.raise_error(F.lit("a record without an instant reached the cutoff"))).otherwise(F.col("ts"))
    return records.where(checked <= F.lit(cutoff).cast("timestamp_ntz"))
