"""Deterministic samples, bucket edges, bucket labels."""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from decimal import Context, Decimal, localcontext

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import hashing
from ..sources.storage import stored
from .identity import small


#: Steps of the priority histogram for each doubling of the priority.
STEPS = 1024


def sample(values: DataFrame, k: int, seed: int = 0, *, field: str = "field", key: str = "key") -> DataFrame:
    """For each field the ``k`` rows of least priority (a hash of the key and the seed), ties by key.

    It depends on content only, not on partitions. A first pass counts the
    rows of each field by the logarithm of their priority, at most 64 * STEPS
    counts a field whatever its size; they tell below which step the sample
    lies. Only the rows up to that step, hardly more than ``k``, are ranked.
    ``values`` is read twice.
    """
    rows = values.withColumn("__p", hashing.priority(F.col(key).cast("string"), seed))
    rows = rows.withColumn("__step", F.floor(F.log2(F.col("__p").cast("double") + F.lit(2.0**63 + 1)) * STEPS).cast("int"))
    near = rows.join(small(stored(cut_steps(rows, k, field).coalesce(1))), F.col(field).eqNullSafe(F.col("__f")) & (F.col("__step") <= F.col("__cut")), "left_semi")
    ranked = near.withColumn("__n", F.row_number().over(Window.partitionBy(field).orderBy("__p", F.col(key).cast("string"))))
    return ranked.where(F.col("__n") <= k).drop("__p", "__n", "__step")


def cut_steps(rows: DataFrame, k: int, field: str) -> DataFrame:
    """``__f, __cut``: of each field the step (``__step``) that its ``k``-th row is in, its last one where it has fewer."""
    counted = rows.groupBy(field, "__step").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(field).orderBy("__step").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return counted.withColumn("__before", before).where(F.col("__before") < k).groupBy(F.col(field).alias("__f")).agg(F.max("__step").alias("__cut"))


def quantile_edges(values: DataFrame, counts: dict[str, int], *, field: str = "field", value: str = "value") -> DataFrame:
    """``field, edge_no, edge``: inner edges at the zero-based ranks floor(n * i / k), without repeats or the least value.

    ``values`` is a bounded sample (``sample``'s output).
    """
    n_buckets = F.lit(None).cast("long")
    for f, k in counts.items():
        n_buckets = F.when(F.col(field) == f, k).otherwise(n_buckets)
    by = Window.partitionBy(field)
    rows = values.withColumn("__r", F.row_number().over(by.orderBy(value)) - 1).withColumn("__n", F.count("*").over(by)).withColumn("__least", F.min(value).over(by)).withColumn("__k", n_buckets)
    # rank r is an edge when some i in 1..k-1 has floor(n * i / k) = r: the first i with n * i >= k * r is the one to try
    i = F.ceil(F.col("__r") * F.col("__k") / F.col("__n"))
    hit = (i >= 1) & (i < F.col("__k")) & (F.floor(F.col("__n") * i / F.col("__k")) == F.col("__r"))
    edges = rows.where(hit & (F.col(value) > F.col("__least"))).select(field, F.col(value).alias("edge")).distinct()
    return edges.withColumn("edge_no", (F.row_number().over(Window.partitionBy(field).orderBy("edge")) - 1).cast("long"))


def equal_width_edges(least: Decimal, most: Decimal, k: int) -> list[Decimal]:
    """Inner edges of equal steps between the extremes, exact to 28 digits."""
    with localcontext(Context(prec=28)):
        edges = sorted({least + (most - least) * i / k for i in range(1, k)})
    return [e for e in edges if least < e <= most]


@dataclass(frozen=True)
class Edges:
    """Frozen inner edges of one field, and what they were fitted on: the least and the greatest training value, how many, by which method."""

    edges: tuple[Decimal, ...]
    least: Decimal | None = None
    most: Decimal | None = None
    n_values: int = 0
    method: str = "quantile"
    asked: int = 0

    def domain(self) -> list[str]:
        return [f"bucket_{i}" for i in range(len(self.edges) + 1)]

    def label(self, value: Decimal | None) -> str:
        return "MISSING" if value is None else f"bucket_{bisect_right(self.edges, value)}"

    def column(self, value: Column) -> Column:
        """Left-closed buckets: the number of edges at or below the value; MISSING for null."""
        at = F.filter(F.array(*[F.lit(str(e)).cast("decimal(38,8)") for e in self.edges]), lambda e: e <= value) if self.edges else F.array()
        return F.when(value.isNull(), "MISSING").otherwise(F.concat(F.lit("bucket_"), F.size(at).cast("string")))


def clip_counts(df: DataFrame, edges: dict[str, Edges]) -> DataFrame:
    """``field, assigned, clipped_low, clipped_high, missing`` of each field: a value beyond the training range keeps the outer
    bucket's label and is counted. One aggregation."""
    parts = []
    for n, e in edges.items():
        v = F.col(n).cast("decimal(38,8)")
        below = F.count_if(v < F.lit(str(e.least)).cast("decimal(38,8)")) if e.least is not None else F.lit(0).cast("long")
        above = F.count_if(v > F.lit(str(e.most)).cast("decimal(38,8)")) if e.most is not None else F.lit(0).cast("long")
        parts.append(F.struct(F.lit(n).alias("field"), F.count(n).alias("assigned"), below.alias("clipped_low"), above.alias("clipped_high"), F.count_if(F.col(n).isNull()).alias("missing")))
    return df.agg(F.array(*parts).alias("x")).select(F.explode("x").alias("x")).select("x.*")


def fit(values: DataFrame, methods: dict[str, tuple[str, int]], k: int = 50_000, seed: int = 0) -> dict[str, Edges]:
    """Edges of each field from (field, key, value) rows: ``methods`` is field -> (quantile | equal_width, buckets).

    What comes to the driver is at most one edge a bucket, and two extremes and a count a field.
    """
    picked = sample(values.where("value is not null"), k, seed)
    counts = {f: n for f, (m, n) in methods.items() if m == "quantile"}
    seen = {r["field"]: r for r in picked.groupBy("field").agg(F.min("value").alias("a"), F.max("value").alias("b"), F.count("*").alias("n")).collect()}
    inner: dict[str, tuple] = {f: () for f in methods}
    if counts:
        rows = quantile_edges(picked.where(F.col("field").isin(list(counts))), counts).collect()
        for f in counts:
            inner[f] = tuple(r["edge"] for r in sorted((r for r in rows if r["field"] == f), key=lambda r: r["edge_no"]))
    for f, (m, n) in methods.items():
        if m == "equal_width" and f in seen:
            inner[f] = tuple(equal_width_edges(Decimal(seen[f]["a"]), Decimal(seen[f]["b"]), n))
    return {f: Edges(inner[f], *((Decimal(seen[f]["a"]), Decimal(seen[f]["b"]), seen[f]["n"]) if f in seen else (None, None, 0)), m, n) for f, (m, n) in methods.items()}
