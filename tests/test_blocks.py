"""Texts of many lines compared by hash trees."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tidewell.operators import blocks


def made(spark, n, block=10, change=None, parts=5):
    rows = spark.range(n).withColumn("line", F.concat(F.lit("line é "), F.col("id").cast("string"))).repartition(parts)
    if change is not None:
        rows = rows.withColumn("line", F.when(F.col("id") == change, F.concat("line", F.lit("x"))).otherwise(F.col("line")))
    return blocks.text(rows, ["id"], F.col("line"), block)


def plain_root(lines, block):
    sha = lambda b: hashlib.sha256(b).hexdigest()
    level = [sha(x.encode()) for x in lines]
    first = True
    while len(level) > 1 or first:
        level, first = [sha("".join(level[i : i + block]).encode()) for i in range(0, len(level), block)], False
    return level[0]


@pytest.mark.parametrize(("n", "levels"), [(1, 1), (10, 1), (11, 2), (1234, 4)])
def test_the_tree_is_that_of_a_plain_version(spark, n, levels):
    t = made(spark, n)
    assert t.levels == levels and t.n == n and t.root() == plain_root([f"line é {i}" for i in range(n)], 10)
    assert blocks.first_difference(t, made(spark, n, parts=2)) is None


@pytest.mark.parametrize("change", [0, 9, 10, 777, 1233])
def test_the_first_byte_that_differs_is_named(spark, change):
    got = blocks.first_difference(made(spark, 1234, change=change), made(spark, 1234))
    text = f"line é {change}"
    assert got == blocks.Difference(change // 10, change, len(text.encode()), text + "x", text)


def test_lines_that_one_side_has_not(spark, tmp_path):
    want = made(spark, 100)
    blocks.freeze(want, f"file://{tmp_path}/g")
    back = blocks.frozen(spark, f"file://{tmp_path}/g", 10)
    assert blocks.first_difference(want, back) is None
    assert blocks.first_difference(made(spark, 101), back) == blocks.Difference(10, 100, 0, "line é 100", None)
    assert blocks.first_difference(made(spark, 95), back) == blocks.Difference(9, 95, 0, None, "line é 95")
    assert blocks.first_difference(made(spark, 0), back) == blocks.Difference(0, 0, 0, None, "line é 0")
    assert blocks.first_difference(made(spark, 0), made(spark, 0)) is None and made(spark, 0).root() is None
    with pytest.raises(ValueError, match="different sizes"):
        blocks.first_difference(made(spark, 5, block=7), back)
