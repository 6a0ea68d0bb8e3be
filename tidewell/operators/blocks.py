"""Lines in one order, a hash tree over blocks of them, and the first byte in which two such texts differ.

A text of very many lines is never put into one file or one task: ranges of
lines are numbered, a block's hash is of the hashes of its lines in order, and a
hash above is of a block's worth of hashes below. Two texts are compared from
the top down, a block of hashes at a time, and only the lines of the first
block that differs are looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.storage import stored
from .tokens import numbered

#: Lines of a block, and hashes that one above is made of.
BLOCK = 1000


@dataclass(frozen=True)
class Text:
    """``lines``: no (from 0), line; ``tree``: level (from 1), no, sha256; ``levels``: how many, ``n``: lines."""

    lines: DataFrame
    tree: DataFrame
    levels: int
    n: int
    block: int

    def root(self) -> str | None:
        """The hash of everything; None of an empty text."""
        row = self.tree.where(F.col("level") == self.levels).first() if self.n else None
        return row["sha256"] if row else None


def _above(hashes: DataFrame, block: int) -> DataFrame:
    """``no, sha256`` of every block of ``no, sha256`` rows; a block is at most ``block`` hashes."""
    parts = hashes.groupBy(F.floor(F.col("no") / block).cast("long").alias("__b")).agg(F.array_sort(F.collect_list(F.struct("no", "sha256"))).alias("p"))
    return parts.select(F.col("__b").alias("no"), F.sha2(F.array_join(F.transform("p", lambda x: x["sha256"]), "").cast("binary"), 256).alias("sha256"))


def text(rows: DataFrame, order: list[str], line: Column, block: int = BLOCK) -> Text:
    """``rows`` as lines in ``order``, which has to tell them apart."""
    ordered = numbered(rows.select(*order, line.alias("__line")), order, 0, "no")
    return _with_tree(stored(ordered.select("no", F.col("__line").alias("line"))), block)


def _with_tree(lines: DataFrame, block: int) -> Text:
    n = lines.count()
    hashes = lines.select("no", F.sha2(F.col("line").cast("binary"), 256).alias("sha256"))
    levels, left, every = 0, n, None
    while left > 1 or (left and not levels):
        hashes = stored(_above(hashes, block))
        levels, left = levels + 1, -(-left // block)
        one = hashes.select(F.lit(levels).alias("level"), "no", "sha256")
        every = one if every is None else every.unionByName(one)
    if every is None:
        every = lines.sparkSession.createDataFrame([], "level int, no long, sha256 string")
    return Text(lines, every, levels, n, block)


def freeze(t: Text, path: str) -> None:
    """Write lines (in files of whole ranges) and tree."""
    t.lines.repartitionByRange("no").sortWithinPartitions("no").write.parquet(f"{path}/lines")
    t.tree.write.parquet(f"{path}/tree")


def frozen(spark, path: str, block: int = BLOCK) -> Text:
    """What ``freeze`` wrote, as it was: the tree is not made again."""
    tree = spark.read.schema("level int, no long, sha256 string").parquet(f"{path}/tree")
    lines = spark.read.schema("no long, line string").parquet(f"{path}/lines")
    return Text(lines, tree, tree.agg(F.max("level")).first()[0] or 0, lines.count(), block)


@dataclass(frozen=True)
class Difference:
    """The first line that differs, its block, the first byte in it that differs (both from 0), and either line (None where there is none)."""

    block: int
    line: int
    byte: int
    got: str | None
    want: str | None


def first_difference(got: Text, want: Text) -> Difference | None:
    """None where both are byte for byte the same. A block of hashes of each level is compared, then the lines of one block."""
    if got.block != want.block:
        raise ValueError("texts in blocks of different sizes")
    size = got.block
    if got.n == want.n and got.root() == want.root():
        return None
    at = 0  # the first node of a level that differs, from the top
    for level in range(max(got.levels, want.levels), 0, -1):
        mine, theirs = (t.tree.where((F.col("level") == level) & F.col("no").between(at * size, at * size + size - 1)).select("no", F.col("sha256").alias(name)) for t, name in ((got, "a"), (want, "b")))
        row = mine.join(theirs, "no", "full").where(~F.col("a").eqNullSafe(F.col("b"))).agg(F.min("no").alias("no")).first()
        at = row["no"]
    inside = F.col("no").between(at * size, at * size + size - 1)
    one, two = (t.lines.where(inside).select("no", F.col("line").alias(name)) for t, name in ((got, "a"), (want, "b")))
    row = one.join(two, "no", "full").where(~F.col("a").eqNullSafe(F.col("b"))).orderBy("no").limit(1).first()
    a, b = ((x or "").encode() for x in (row["a"], row["b"]))
    byte = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return Difference(at, row["no"], byte, row["a"], row["b"])
