"""Order within clients that no task holds whole: positions, neighbours and running sums carried over ranges.

A window over one client's rows is one task. Where a client has very many rows
they are sorted by client and order into ranges of about equal size instead.
Each range numbers and sums its own part of a client; only the clients that go on
from one range into the next need more, and these are at most one a range. Of
them each range tells its part's size, sum or last value, and what the
ranges before it told is added: a table of at most two rows a range.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.storage import stored

#: Clients of more rows are put in order by ranges, others by a window of their own.
HEAVY = 2_000_000


@dataclass(frozen=True)
class Ranged:
    """Rows in ranges; each method adds a column."""

    rows: DataFrame
    client: str
    order: tuple[str, ...]
    spanning: DataFrame

    def _own(self, backward: bool = False):
        return Window.partitionBy("__range", self.client).orderBy(*[F.desc(c) if backward else F.asc(c) for c in self.order])

    def _parts(self, told: Column) -> DataFrame:
        """``__range, __client, __told`` of the clients that span ranges."""
        span = self.spanning.select(F.col("__client").alias("__c"))
        rows = self.rows.join(F.broadcast(span), F.col(self.client).eqNullSafe(F.col("__c")), "left_semi")  # a row a range at most
        return rows.groupBy("__range", F.col(self.client).alias("__client")).agg(told.alias("__told"))

    def _carried(self, carry: DataFrame) -> DataFrame:
        """All rows with ``__carry``, null where nothing came before."""
        small = F.broadcast(carry.select(F.col("__range").alias("__r"), F.col("__client").alias("__c"), "__carry"))  # two rows a range at most
        return self.rows.join(small, (F.col("__range") == F.col("__r")) & F.col(self.client).eqNullSafe(F.col("__c")), "left").drop("__r", "__c")

    def _added(self, name: str, own: Column, told: Column, backward: bool, kind: str) -> Ranged:
        """A running total: that within the range, and the sum of the ranges before (after, ``backward``)."""
        edge = Window.partitionBy("__client").orderBy(F.desc("__range") if backward else F.asc("__range")).rowsBetween(Window.unboundedPreceding, -1)
        carry = self._parts(told).withColumn("__carry", F.sum("__told").over(edge))
        rows = self._carried(carry).withColumn(name, (own + F.coalesce("__carry", F.lit(0))).cast(kind)).drop("__carry")
        return replace(self, rows=rows)

    def numbered(self, name: str) -> Ranged:
        """The position within the client, from 0."""
        return self._added(name, F.row_number().over(self._own()) - 1, F.count("*"), False, "long")

    def summed(self, value: str, name: str, backward: bool = False) -> Ranged:
        """The sum of a whole-number column up to and with the row, or from the row to the client's end."""
        own = F.sum(value).over(self._own(backward).rowsBetween(Window.unboundedPreceding, 0))
        return self._added(name, own, F.sum(value), backward, "long")

    def before(self, value: str, name: str) -> Ranged:
        """The value of the client's row before; null at its first one."""
        edge = Window.partitionBy("__client").orderBy("__range")
        last = F.max_by(value, F.struct(*self.order))
        carry = self._parts(last).withColumn("__carry", F.lag("__told").over(edge))
        w = self._own()
        rows = self._carried(carry).withColumn(name, F.when(F.row_number().over(w) == 1, F.col("__carry")).otherwise(F.lag(value).over(w))).drop("__carry")
        return replace(self, rows=rows)

    def with_column(self, name: str, value: Column) -> Ranged:
        return replace(self, rows=self.rows.withColumn(name, value))

    def done(self) -> DataFrame:
        return self.rows.drop("__range")


def ranged(rows: DataFrame, client: str, order: list[str], ranges: int | None = None) -> Ranged:
    """``rows`` in ``ranges`` ranges (as many as shuffles have partitions) of client and order, written once.

    ``order`` has to tell a client's rows apart; rows that agree in all of it stay in one range.
    """
    n = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(rows.repartitionByRange(n, client, *order).withColumn("__range", F.spark_partition_id()))
    ends = dealt.groupBy("__range").agg(F.min(F.struct(F.col(client).alias("c"))).alias("low"), F.max(F.struct(F.col(client).alias("c"))).alias("high"))
    after = F.lead("low").over(Window.partitionBy(F.lit(0)).orderBy("__range"))  # a row a range
    spanning = stored(ends.withColumn("after", after).where("high = after").select(F.col("high.c").alias("__client")).distinct().coalesce(1))
    return Ranged(dealt, client, tuple(order), spanning)


def divided(rows: DataFrame, client: str, most: int = HEAVY) -> tuple[DataFrame, DataFrame | None]:
    """(rows of clients that a task can hold, those of the others or None where there are none).

    Rows are counted a client, before the shuffle where they are.
    """
    heavy = rows.groupBy(F.col(client).alias("__c")).agg(F.count("*").alias("__n")).where(F.col("__n") > most).select("__c")
    if heavy.isEmpty():
        return rows, None
    heavy = stored(heavy.coalesce(1))
    same = F.col(client).eqNullSafe(F.col("__c"))
    few = F.broadcast(heavy)  # fewer than all rows divided by ``most``
    return rows.join(few, same, "left_anti"), rows.join(few, same, "left_semi")


def by_weight(rows: DataFrame, client: str, plain, heavy, most: int = HEAVY) -> DataFrame:
    """``plain`` of the clients that a task can hold and ``heavy`` of the others, in one table."""
    light, rest = divided(rows, client, most)
    out = plain(light)
    return out if rest is None else out.unionByName(heavy(rest).select(*out.columns))
