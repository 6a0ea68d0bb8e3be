"""Currency amounts in the base currency by a backward as-of join with a tolerance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .identity import small


def rate_table(rates: DataFrame, providers: list[str], *, date: str = "rate_date", currency: str = "currency", rate: str = "rate", provider: str = "provider", order: list[str]) -> DataFrame:
    """``currency, rate_date, rate``: approved, positive rates, the last in ``order`` for each currency and day."""
    good = rates.where(F.col(provider).isin(providers) & (F.col(rate) > 0) & F.col(date).isNotNull() & F.col(currency).isNotNull())
    return good.groupBy(F.col(currency).alias("currency"), F.col(date).cast("date").alias("rate_date")).agg(F.max_by(rate, F.struct(*order)).alias("rate"))


def daily(rates: DataFrame, days: int = 3) -> DataFrame:
    """``currency, day, day_rate``: for each day the latest rate that is at most ``days`` days old.

    Each rate is laid out over the days it may serve, so the as-of join
    becomes an equi-join on a table of (days + 1) rows a rate at most.
    """
    laid = rates.withColumn("day", F.explode(F.sequence("rate_date", F.date_add("rate_date", days))))
    return laid.groupBy("currency", "day").agg(F.max_by("rate", "rate_date").alias("day_rate"))


def convert(records: DataFrame, rates: DataFrame, base: str, *, amount: str = "amount", currency: str = "currency", ts: str = "ts", days: int = 3, into: str = "amount_base") -> DataFrame:
    """``records`` with ``into``: the amount itself in the base currency, times the as-of rate of the instant's UTC date
    in another one, null (the record stays) without amount, currency or a rate that is recent enough; and ``fx_missing``."""
    d = small(daily(rates, days).select(F.col("currency").alias("__c"), F.col("day").alias("__d"), "day_rate"))
    joined = records.join(d, (F.col(currency) == F.col("__c")) & (F.to_date(ts) == F.col("__d")), "left").drop("__c", "__d")
    value = F.when(F.col(currency) == base, F.col(amount).cast("decimal(33,8)")).otherwise((F.col(amount).cast("decimal(20,4)") * F.col("day_rate").cast("decimal(12,4)")).cast("decimal(33,8)"))
    return joined.withColumn(into, value).withColumn("fx_missing", F.col(amount).isNotNull() & F.col(into).isNull()).drop("day_rate")
