"""Clients that no task holds whole: the same rows as by a window of one task."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewell.functions import hashing
from tidewell.operators import buckets, ranges, sessions, timeline, tokens

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def actions(spark):
    """Client 1 has half of all rows; instants repeat; a client is null."""
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        client = 1 if i % 2 else rng.choice([None, 0, 2, 3, *range(10, 60)])
        rows.append((client, START + timedelta(seconds=rng.randrange(200_000)), rng.choice([10, 30]), f"r{i:05d}", rng.choice(["open", "tap", "tap", "tap"]), rng.choice(["a", "b", "c", None]), rng.randint(1, 9)))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "client_id long, ts timestamp_ntz, source_priority int, source_record_id string, action string, screen string, n_tokens int")
    return df.withColumn("event_id", F.col("source_record_id"))


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def test_timeline_and_deltas(actions):
    plain = timeline.order_timeline(actions)
    assert rows(timeline.order_timeline(actions, heavy=20)) == rows(plain)
    assert rows(timeline.deltas(plain, heavy=20)) == rows(timeline.deltas(plain))


def test_sessions(actions):
    carry = {"carry": ["n_tokens"]}
    one = sessions.sessionize(actions, ["open"], 900, **carry)
    assert rows(sessions.sessionize(actions, ["open"], 900, heavy=20, **carry)) == rows(one)
    assert rows(sessions.sessionize(actions, [], 10**9, heavy=0)) == rows(sessions.sessionize(actions, [], 10**9))  # sessions over all ranges


def test_windows_and_their_deltas(actions):
    t = timeline.order_timeline(actions)
    for most in (0, 5, 100, 3000, 10**6):
        assert rows(tokens.window(t, most, heavy=20)) == rows(tokens.window(t, most))
    kept = tokens.window(t, 100)
    edges = buckets.Edges((Decimal(60), Decimal(3600)))
    assert rows(tokens.deltas_after(kept, edges, heavy=3)) == rows(tokens.deltas_after(kept, edges))


def test_half_of_all_rows_spread_over_the_ranges(actions):
    r = ranges.ranged(actions, "client_id", timeline.ORDER, 24)
    each = {x["__range"]: x["n"] for x in r.rows.groupBy("__range").agg(F.count("*").alias("n")).collect()}
    assert len(each) > 20 and max(each.values()) < 2.5 * 3000 / 24
    own = r.rows.where("client_id = 1").select("__range").distinct().count()
    assert own >= 10
    assert 1 in {x[0] for x in r.spanning.collect()} and r.spanning.count() < len(each)
    assert r._parts(F.count("*")).count() <= 2 * len(each)


@pytest.mark.parametrize("n", [0, 1])
def test_few_rows(actions, n):
    got = ranges.ranged(actions.limit(n), "client_id", timeline.ORDER).numbered("no").before("ts", "b").summed("n_tokens", "s").done()
    assert [(r.no, r.b, r.s == r.n_tokens) for r in got.collect()] == [(0, None, True)] * n


def test_the_sample_ranks_hardly_more_than_it_keeps(spark):
    values = spark.range(60_000).select(F.when(F.col("id") % 10 > 0, "big").when(F.col("id") % 100 > 0, "mid").otherwise("small").alias("field"), F.col("id").cast("string").alias("key"), F.col("id").alias("value"))
    ranked = values.withColumn("p", hashing.priority(F.col("key"), 7)).toPandas()
    for k in (1, 10, 500, 700, 10**6):
        got = buckets.sample(values, k, 7).toPandas()
        want = ranked.sort_values(["p", "key"]).groupby("field").head(k)
        assert set(got.key) == set(want.key) and len(got) == len(want)
    rows_ = values.withColumn("__p", hashing.priority(F.col("key"), 7)).withColumn("__step", F.floor(F.log2(F.col("__p").cast("double") + F.lit(2.0**63 + 1)) * buckets.STEPS).cast("int"))
    near = rows_.join(buckets.cut_steps(rows_, 500, "field"), (F.col("field") == F.col("__f")) & (F.col("__step") <= F.col("__cut"))).groupBy("field").count().collect()
    assert all(min(500, 600) <= r["count"] <= 2 * 500 for r in near)
