"""Tables of calls that run side by side."""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

from tidewell.llm import common


def test_calls_side_by_side_leave_each_other_their_tables(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")

    def run(_):
        got = {r.node: r.root for r in common.components(chain).collect()}
        return got == {i: 0 for i in range(41)}

    with ThreadPoolExecutor(4) as pool:
        assert all(pool.map(run, range(8)))


def test_discard_deletes_what_the_thread_wrote_since_the_mark(spark):
    first = common.materialize(spark.range(3))
    since = common.mark()
    second, third = common.materialize(spark.range(4)), common.materialize(spark.range(5))
    with ThreadPoolExecutor(1) as pool:
        other = pool.submit(lambda: (common.mark(), common.materialize(spark.range(6)))).result()
    common.discard(spark, since, keep=1)
    there = [os.path.exists(d.inputFiles()[0].removeprefix("file://")) for d in (first, second, third, other[1])]
    assert other[0] == 0 and there == [True, False, True, True]


def test_operators_side_by_side(spark, tmp_path):
    """Each gives what it gives alone, and deletes no other one's tables."""
    import random

    from tests.llm import data
    from tidewell.llm import decontam, line_dedup, simhash

    rng = random.Random(3)
    base = [data.words(rng, 60) for _ in range(12)]
    texts = [*base, *(b + " more" for b in base), *(f"a common line\n{data.words(rng, 20)}" for _ in range(12))]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], data.DOC)
    items = spark.createDataFrame([(1, base[0])], "item_id long, text string")
    ways = {
        "lines": lambda: sorted(tuple(r) for r in line_dedup.drop_lines(docs, min_docs=10).select("doc_id", "n_dropped").collect()),
        "classes": lambda: sorted(tuple(r) for r in simhash.classes(docs).collect()),
        "near": lambda: sorted(r.doc_id for r in simhash.keep_one(docs).collect()),
        "leaks": lambda: sorted(r.doc_id for r in decontam.decontaminate(docs, items).collect()),
    }
    alone = {n: f() for n, f in ways.items()}
    with ThreadPoolExecutor(4) as pool:
        beside = {n: pool.submit(f) for n, f in ways.items()}
    assert {n: r.result() for n, r in beside.items()} == alone
