"""Exact, conflicting and business duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import digest_hex, tagged


def exact(records: DataFrame, key: list[str], signature: Column, order: list[str], version: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, rejects): one row for each key.

    Rows of a key with one ``signature`` (the payload without its version) are
    copies: the first in ``order`` stays, not the highest version. Rows that
    differ are a conflict: with a ``version`` column that every row fills, the
    highest version wins when one signature alone has it (its first row in
    ``order``); else the whole group is rejected.

    Rows are merged by key and payload, partial results first, so many copies of
    one record do not meet in one task; then the payloads of a key, each with
    bounded results. The row that stays travels with these, and nothing is joined
    back but the keys that are rejected.
    """
    rows = records.withColumn("__sig", F.xxhash64(signature, F.lit(1))).withColumn("__sig2", F.xxhash64(signature, F.lit(2)))
    v = F.col(version).cast("long") if version else F.lit(None).cast("long")
    row = F.struct(*records.columns)
    names = [f"__k{i}" for i in range(len(key))]
    keyed = rows.select("*", *[F.col(k).alias(n) for k, n in zip(key, names)])
    per = keyed.groupBy(*names, "__sig", "__sig2").agg(
        F.min(F.struct(F.struct(*order).alias("o"), row.alias("row"))).alias("first"), F.max(v).alias("top"), F.count_if(v.isNull()).alias("unversioned"),
        F.min(F.struct((-F.coalesce(v, F.lit(0))).alias("v"), F.struct(*order).alias("o"), row.alias("row"))).alias("first_top"),
    )
    rank, turned = F.struct("top", "__sig", "__sig2"), F.struct("top", F.bitwise_not("__sig"), F.bitwise_not("__sig2"))
    # of several payloads with the top version, the greatest by one order is not the greatest by the other
    whole = per.groupBy(*names).agg(F.count("*").alias("kinds"), F.sum("unversioned").alias("unversioned"), F.min("first").alias("first"), F.max_by("first_top", rank).alias("win"), F.max_by("__sig", rank).alias("a"), F.max_by("__sig", turned).alias("b"), F.max_by("__sig2", rank).alias("a2"), F.max_by("__sig2", turned).alias("b2"))
    alone = (F.col("a") == F.col("b")) & (F.col("a2") == F.col("b2"))
    keep = F.when(F.col("kinds") == 1, F.col("first.row")).when((F.col("unversioned") == 0) & alone, F.col("win.row"))
    told = whole.select(*names, keep.alias("__keep"))
    good = told.where("__keep is not null").select("__keep.*")
    lost = told.where("__keep is null").select(*[F.col(n).alias(f"{n}_") for n in names])
    same = None
    for n in names:
        c = keyed[n].eqNullSafe(F.col(f"{n}_"))
        same = c if same is None else same & c
    bad = keyed.join(lost, same, "left_semi").select(*records.columns)
    return good, bad.withColumn("reason", F.lit("unresolved_duplicate_conflict"))


def fingerprint(source: Column, version: str, fields: list[Column]) -> Column:
    """SHA-256 of what makes two records the same business fact; null differs from empty."""
    return digest_hex(F.lit(version), source, *[tagged(f) for f in fields])


def business(records: DataFrame, fields: list[str], source: str = "source", record_id: str = "source_record_id", version: str = "1.0.0") -> DataFrame:
    """One row for each business fact within a source: the one with the smallest record id."""
    fp = fingerprint(F.col(source), version, [F.col(f) for f in fields])
    rows = records.select(F.col(source).alias("__source"), fp.alias("__fp"), F.struct(F.col(record_id).alias("id"), F.struct(*records.columns).alias("row")).alias("__row"))
    return rows.groupBy("__source", "__fp").agg(F.min("__row").alias("__row")).select("__row.row.*")
