"""Operators on small frames: the edge cases that are easy to lose."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewell.functions import hashing, numbers, text, times
from tidewell.operators import buckets, checks, dedup, fields, fx, identity, profiles, sessions, timeline, timestamps, tokens


def ntz(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


# --- functions ---


def test_event_id_is_length_prefixed(spark):
    a = one(spark, hashing.digest_hex(F.lit("ab"), F.lit("c")).alias("x"), hashing.digest_hex(F.lit("a"), F.lit("bc")).alias("y"))
    assert a.x != a.y and len(a.x) == 64
    import hashlib

    raw = b"".join(len(p.encode()).to_bytes(8, "big") + p.encode() for p in ("é", ""))
    assert one(spark, hashing.digest_hex(F.lit("é"), F.lit("")).alias("x")).x == hashlib.sha256(raw).hexdigest()


def test_priority_is_unsigned_and_depends_on_the_seed(spark):
    import hashlib

    keys = [f"k{i}" for i in range(60)]

    def want(seed):
        mix = (seed * hashing.SEED_MIXER) % 2**64
        return sorted(keys, key=lambda k: int.from_bytes(hashlib.sha256(len(k).to_bytes(8, "big") + k.encode()).digest()[:8], "big") ^ mix)

    df = spark.createDataFrame([(k,) for k in keys], "k string")
    for seed in (0, 1, 7):
        assert [r.k for r in df.orderBy(hashing.priority(F.col("k"), seed)).collect()] == want(seed)
    assert want(0)[:10] != want(1)[:10]


def test_missing_and_strip(spark):
    rows = [(" n/A ",), (" ",), ("-",), ("x",), (None,), ("",)]
    got = spark.createDataFrame(rows, "v string").select(text.is_missing(F.col("v"), ["N/A", "-"]).alias("m")).collect()
    assert [r.m for r in got] == [True, True, True, False, True, True]


def test_nfkc_of_full_width(spark):
    assert one(spark, text.nfkc(F.lit("ＵＳＤ")).alias("x")).x == "USD"


@pytest.mark.parametrize(
    ("raw", "kw", "value", "reason"),
    [
        ("20 284,95", {"locale": "ru_KZ", "numeric_type": "decimal"}, Decimal("20284.95"), None),
        ("59642.66", {"locale": "ru_KZ", "numeric_type": "decimal"}, Decimal("59642.66"), None),
        ("1.234,5", {"locale": "ru_KZ", "numeric_type": "decimal"}, None, "parse_error"),
        ("1,5", {"locale": "plain", "numeric_type": "decimal"}, None, "parse_error"),
        ("NaN", {"locale": "plain", "numeric_type": "decimal"}, None, "non_finite"),
        ("-Inf", {"locale": "plain", "numeric_type": "decimal"}, None, "non_finite"),
        ("1.5", {"locale": "plain", "numeric_type": "integer"}, None, "parse_error"),
        ("798122", {"locale": "plain", "numeric_type": "integer", "scale": "0.01"}, Decimal("7981.22"), None),
        ("-1", {"locale": "plain", "numeric_type": "integer"}, None, "business_range"),
        ("13", {"locale": "plain", "numeric_type": "integer", "least": "14", "most": "120"}, None, "business_range"),
        ("0", {"locale": "plain", "numeric_type": "integer", "least": "0"}, Decimal(0), None),
        ("1_000", {"locale": "plain", "numeric_type": "integer"}, Decimal(1000), None),
        ("1e3", {"locale": "plain", "numeric_type": "integer"}, Decimal(1000), None),
        (None, {"locale": "plain", "numeric_type": "integer"}, None, None),
    ],
)
def test_numbers(spark, raw, kw, value, reason):
    got = numbers.validated(spark.range(1), F.lit(raw).cast("string"), "n", **kw).first()
    assert (got.n, got.n__reason) == (value, reason)


def test_local_times(spark):
    got = one(
        spark,
        times.from_day_first(F.lit("11.12.2023 15:16")).alias("a"),
        times.from_day_first(F.lit("1.2.2023 5:06")).alias("b"),
        times.from_day_first(F.lit("32.12.2023 15:16")).alias("c"),
        times.to_utc(times.from_iso(F.lit("2024-01-18T12:00:00")), F.lit("Asia/Almaty")).alias("d"),
        times.to_utc(times.from_iso(F.lit("2024-05-18T12:00:00")), F.lit("Asia/Almaty")).alias("e"),
        times.from_millis(F.lit(1709975128000)).alias("f"),
    )
    assert got.a == datetime(2023, 12, 11, 15, 16) and got.b == datetime(2023, 2, 1, 5, 6) and got.c is None
    assert got.d == datetime(2024, 1, 18, 6) and got.e == datetime(2024, 5, 18, 7)  # the zone's offset changed in March 2024
    assert got.f == datetime(2024, 3, 9, 9, 5, 28)


# --- look-ups and time ---


def test_identity(spark):
    rows = spark.createDataFrame([("a", "1"), ("a", "2"), ("a", ""), ("b", "1")], "source string, ref string")
    d = spark.createDataFrame([("a", "1", "C1"), ("a", "", "C9")], "source string, ref string, client_id string")
    good, bad = identity.resolve_identity(rows, d, "source", "ref")
    assert [(r.source, r.ref, r.client_id) for r in good.collect()] == [("a", "1", "C1")]
    assert {(r.source, r.ref, r.reason) for r in bad.collect()} == {("a", "2", "unresolved_client_id"), ("a", "", "unresolved_client_id"), ("b", "1", "unresolved_client_id")}


def test_event_map_tells_null_targets_from_misses(spark):
    rows = spark.createDataFrame([("x",), ("y",), ("z",), (None,)], "code string")
    good, bad = identity.map_events(rows, {"x": "T", "y": None}, "code")
    assert sorted((r.code, r.event_type) for r in good.collect()) == [("x", "T"), ("y", None)]
    assert bad.count() == 2


def test_client_zone_uses_local_midnight_and_ties_keep_the_first(spark):
    rows = spark.createDataFrame([("C1", "2026-02-01 00:00:00", "A", 2), ("C1", "2026-01-01 00:00:00", "B", 1), ("C1", "2026-02-01 00:00:00", "B", 3), ("C1", "2026-02-02 00:00:00", "B", 4), ("C1", "2026-02-01 00:00:00", "?", 0)], "client_id string, snapshot_date string, region string, n int")
    z = timestamps.client_zones(ntz(rows, "snapshot_date"), "2026-01-31 23:59:59", {"A": "Asia/Almaty", "B": "Asia/Oral"}, "Asia/Almaty", ["n"])
    assert [(r.client_id, r.client_zone) for r in z.collect()] == [("C1", "Asia/Almaty")]


def test_timestamps_reject_and_flag(spark):
    rows = spark.createDataFrame([("2024-01-01T10:00:00", "A"), ("bad", "A"), ("2024-01-01T10:00:00", "?"), ("2024-05-01T10:00:00", "A")], "raw string, region string")
    zone = timestamps.zone_of(F.col("region"), {"A": "UTC"})
    good, bad = timestamps.normalize(rows, "raw", "iso_local", zone=zone, zone_is_given=True, cutoff="2024-01-01 10:00:00")
    assert [(r.ts, r.is_future) for r in good.orderBy("ts").collect()] == [(datetime(2024, 1, 1, 10), False), (datetime(2024, 5, 1, 10), True)]
    assert sorted(r.reason for r in bad.collect()) == ["missing_event_time", "unknown_timezone"]
    assert timestamps.up_to(good, "2024-01-01 10:00:00").count() == 1
    assert timestamps.up_to(good, "2024-01-01 09:59:59").count() == 0


def test_late_is_strict(spark):
    rows = ntz(spark.createDataFrame([("2024-01-01T10:00:00", "2024-01-01 12:00:00"), ("2024-01-01T10:00:00", "2024-01-01 12:00:01")], "raw string, p string"), "p")
    good, _ = timestamps.normalize(rows, "raw", "iso_local", default_zone="UTC", cutoff="2025-01-01 00:00:00", processed=F.col("p"), max_delay_hours=2)
    assert [r.is_late for r in good.orderBy("p").collect()] == [False, True]


def test_cutoff_refuses_null_instants(spark):
    rows = spark.createDataFrame([(None,)], "ts string").select(F.col("ts").cast("timestamp_ntz"))
    with pytest.raises(Exception, match="without an instant"):
        timestamps.up_to(rows, "2024-01-01 00:00:00").collect()


# --- duplicates ---


def _exact(spark, rows, version="v"):
    df = spark.createDataFrame(rows, "id string, payload string, v int, line int")
    good, bad = dedup.exact(df, ["id"], F.col("payload"), ["line"], version)
    return sorted((r.id, r.line) for r in good.collect()), sorted((r.id, r.line) for r in bad.collect())


def test_exact_copies_keep_the_first_line_not_the_top_version(spark):
    assert _exact(spark, [("a", "x", 1, 5), ("a", "x", 2, 7), ("b", "y", 1, 1)]) == ([("a", 5), ("b", 1)], [])


def test_conflicts(spark):
    assert _exact(spark, [("a", "x", 1, 1), ("a", "y", 2, 2)]) == ([("a", 2)], [])
    assert _exact(spark, [("a", "x", 2, 1), ("a", "y", 2, 2)]) == ([], [("a", 1), ("a", 2)])
    assert _exact(spark, [("a", "x", None, 1), ("a", "y", 2, 2)]) == ([], [("a", 1), ("a", 2)])
    assert _exact(spark, [("a", "x", 1, 1), ("a", "y", 2, 2)], None) == ([], [("a", 1), ("a", 2)])
    assert _exact(spark, [("a", "x", 1, 1), ("a", "y", 2, 3), ("a", "y", 2, 2)]) == ([("a", 2)], [])


def test_business_dedup_keeps_the_smallest_id_and_tells_null_from_empty(spark):
    df = spark.createDataFrame([("s", "2", "x", None), ("s", "10", "x", None), ("s", "3", "x", ""), ("t", "1", "x", None)], "source string, source_record_id string, a string, b string")
    assert sorted(r.source_record_id for r in dedup.business(df, ["a", "b"]).collect()) == ["1", "10", "3"]


# --- sessions ---


def _sessions(spark, rows, **kw):
    df = ntz(spark.createDataFrame(rows, "client_id string, source_record_id string, ts string, action string, screen string"), "ts")
    out = sessions.sessionize(df, ["LOGIN"], **kw).orderBy("client_id", "session_no").collect()
    return [(r.source_record_id, r.duration_seconds, r.n_actions, r.screens_count, r.first_screen, r.last_screen) for r in out]


def test_gap_of_exactly_the_limit_keeps_a_session(spark):
    rows = [("c", "1", "2024-01-01 00:00:00", "open", "A"), ("c", "2", "2024-01-01 00:30:00", "open", "B"), ("c", "3", "2024-01-01 01:00:01", "open", "A")]
    assert _sessions(spark, rows) == [("1", 1800, 2, 2, "A", "B"), ("3", 0, 1, 1, "A", "A")]


def test_login_splits_and_last_screen_is_the_last_new_one(spark):
    rows = [("c", "1", "2024-01-01 00:00:00", "LOGIN", None), ("c", "2", "2024-01-01 00:00:10", "open", "A"), ("c", "3", "2024-01-01 00:00:20", "open", "B"), ("c", "4", "2024-01-01 00:00:30", "open", "A"), ("c", "5", "2024-01-01 00:00:40", "LOGIN", None)]
    assert _sessions(spark, rows) == [("1", 30, 4, 2, "A", "B"), ("5", 0, 1, 0, None, None)]


def test_sessions_do_not_depend_on_partitions(spark):
    rows = [(f"c{i % 3}", f"{i:03}", f"2024-01-01 {i // 6:02}:{i % 6}0:00", "open", f"S{i % 5}") for i in range(120)]
    df = ntz(spark.createDataFrame(rows, "client_id string, source_record_id string, ts string, action string, screen string"), "ts")
    a = sessions.sessionize(df, ["LOGIN"], 600).orderBy("client_id", "session_no").collect()
    assert a == sessions.sessionize(df.repartition(7), ["LOGIN"], 600).orderBy("client_id", "session_no").collect()


# --- fields ---


def test_categories(spark):
    rule = fields.Category({"978": "EUR", "ЕВРО": "EUR"}, ("KZT", "EUR"))
    df = spark.createDataFrame([(" евро ", ["978", "x", "kzt"]), ("978", []), ("ＫＺＴ", None), ("GBP", ["x"]), (None, None)], "c string, l array<string>")
    got = [(r.c, r.l) for r in fields.categories(df, {"c": rule, "l": rule}).collect()]
    assert got == [("EUR", ["EUR", "KZT"]), ("EUR", None), ("KZT", None), (None, None), (None, None)]


def test_strict_categories_reject_and_list_items_are_normalised(spark):
    rule = fields.Category({"978": "EUR"}, ("KZT", "EUR"), strict=True)
    df = spark.createDataFrame([(1, "978", ["ＫＺＴ"]), (2, "GBP", ["kzt"]), (3, None, ["x", "eur"]), (4, " ", None)], "id int, c string, l array<string>")
    good, bad = fields.checked_categories(df, {"c": rule, "l": rule})
    assert sorted((r.id, r.c, r.l) for r in good.collect()) == [(1, "EUR", ["KZT"]), (4, None, None)]
    assert sorted((r.id, r.reason, r.details) for r in bad.collect()) == [(2, "source_contract_violation", ["domain:c"]), (3, "source_contract_violation", ["domain:l"])]
    loose = fields.Category({}, ("KZT",))
    assert fields.checked_categories(df, {"c": loose})[1].count() == 0


def test_clip_counters(spark):
    rows = [("f", f"k{i}", Decimal(i)) for i in range(10, 20)]
    e = buckets.fit(spark.createDataFrame(rows, "field string, key string, value decimal(38,8)"), {"f": ("quantile", 4), "none": ("equal_width", 4)})
    assert (e["f"].least, e["f"].most, e["f"].n_values, e["f"].asked) == (10, 19, 10, 4) and e["none"].least is None
    df = spark.createDataFrame([(Decimal(9), None), (Decimal(10), None), (Decimal(19), Decimal(1)), (Decimal(25), None), (None, None)], "f decimal(38,8), none decimal(38,8)")
    got = {r.field: (r.assigned, r.clipped_low, r.clipped_high, r.missing) for r in buckets.clip_counts(df, e).collect()}
    assert got == {"f": (4, 1, 1, 1), "none": (1, 0, 0, 4)}
    assert [r[0] for r in df.select(e["f"].column(F.col("f"))).collect()][0] == "bucket_0"


def test_policies(spark):
    df = spark.createDataFrame([(list("zyxwvutsrqp"), list("cba"), 1)], "u array<string>, o array<string>, secret int")
    got = fields.apply_policies(df, ["secret"], {"u": (False, 8), "o": (True, 2)}).first()
    assert got.u == list("pqrstuvw") and got.o == ["c", "b"] and "secret" not in got


def test_fx(spark):
    rates = spark.createDataFrame([("USD", "2024-01-05", "450", "NB", 1), ("USD", "2024-01-05", "460", "NB", 2), ("USD", "2024-01-06", "1", "XX", 3), ("USD", "2024-01-01", "-1", "NB", 4)], "currency string, rate_date string, rate string, provider string, n int").withColumn("rate_date", F.to_date("rate_date")).withColumn("rate", F.col("rate").cast("decimal(12,4)"))
    rt = fx.rate_table(rates, ["NB"], order=["n"])
    assert [(r.currency, r.rate) for r in rt.collect()] == [("USD", Decimal("460.0000"))]
    rows = ntz(spark.createDataFrame([(1, "USD", "10", "2024-01-08 23:59:59"), (2, "USD", "10", "2024-01-09 00:00:00"), (3, "KZT", "10", "2024-01-09 00:00:00"), (4, None, "10", "2024-01-08 00:00:00"), (5, "USD", None, "2024-01-08 00:00:00"), (6, "USD", "10", "2024-01-04 00:00:00")], "id int, currency string, amount string, ts string"), "ts").withColumn("amount", F.col("amount").cast("decimal(20,4)"))
    got = {r.id: (r.amount_base, r.fx_missing) for r in fx.convert(rows, rt, "KZT").collect()}
    assert got == {1: (Decimal(4600), False), 2: (None, True), 3: (Decimal(10), False), 4: (None, True), 5: (None, False), 6: (None, True)}


def test_profiles_of_clients_without_snapshot_or_events(spark):
    snaps = ntz(spark.createDataFrame([("A", "2024-01-01 00:00:00", "1", "x"), ("A", "2024-01-02 00:00:00", "2", "y"), ("B", "2024-01-01 00:00:00", "1", "z")], "client_id string, ts string, rid string, region string"), "ts")
    events = ntz(spark.createDataFrame([("A", "2024-01-03 00:00:00", "TRANSFER", "IN"), ("A", "2024-01-04 00:00:00", "PUSH", None), ("C", "2024-01-04 12:00:00", "PUSH", None)], "client_id string, ts string, event_type string, direction string"), "ts")
    p = profiles.build(snaps, events, "2024-01-05 00:00:00", ["ts", "rid"], ["region"], ["TRANSFER"], F.col("direction") == "IN")
    got = {r.client_id: (r.region, r.profile_missing, r.event_count, r.transaction_count, r.first_seen_days, r.first_topup_days) for r in p.collect()}
    assert got == {"A": ("y", False, 2, 1, 2, 2), "B": ("z", False, 0, 0, None, None), "C": (None, True, 1, 0, 0, None)}


# --- buckets ---


def test_quantile_edges_against_ranks(spark):
    import random

    rng = random.Random(3)
    for n, k in ((1, 4), (5, 8), (40, 8), (41, 7), (100, 16)):
        values = [rng.randrange(12) for _ in range(n)]
        s = sorted(values)
        want = sorted({s[n * i // k] for i in range(1, k)} - {s[0]})
        df = spark.createDataFrame([("f", v) for v in values], "field string, value long")
        assert [r.edge for r in buckets.quantile_edges(df, {"f": k}).orderBy("edge_no").collect()] == want


def test_labels_are_left_closed(spark):
    e = buckets.Edges((Decimal(10), Decimal(20)))
    df = spark.createDataFrame([(Decimal(9),), (Decimal(10),), (Decimal(20),), (None,)], "v decimal(38,8)")
    assert [r[0] for r in df.select(e.column(F.col("v"))).collect()] == ["bucket_0", "bucket_1", "bucket_2", "MISSING"] == [e.label(Decimal(9)), e.label(Decimal(10)), e.label(Decimal(20)), e.label(None)]
    assert e.domain() == ["bucket_0", "bucket_1", "bucket_2"]


def test_equal_width():
    assert buckets.equal_width_edges(Decimal(0), Decimal(8), 4) == [Decimal(2), Decimal(4), Decimal(6)]
    assert buckets.equal_width_edges(Decimal(5), Decimal(5), 4) == []


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame([("f", f"k{i}", i) for i in range(500)], "field string, key string, value long")
    a = sorted(r.key for r in buckets.sample(df, 20, 5).collect())
    assert len(a) == 20 and a == sorted(r.key for r in buckets.sample(df.repartition(9), 20, 5).collect())


# --- timeline ---


def _timeline(spark):
    rows = [("A", "2024-01-01 00:00:05.123", 20, "b"), ("A", "2024-01-01 00:00:05", 30, "a"), ("A", "2024-01-01 00:00:05", 10, "z"), ("A", "2024-01-01 00:00:05", 10, "y"), ("B", "2024-01-01 23:00:00", 10, "q")]
    df = ntz(spark.createDataFrame(rows, "client_id string, ts string, source_priority int, source_record_id string"), "ts")
    return timeline.order_timeline(df.withColumn("event_id", F.concat("client_id", "source_record_id")).withColumn("calendar_zone", F.lit("Asia/Almaty")).withColumn("event_type", F.lit("T")))


def test_order_keys_and_ties(spark):
    got = _timeline(spark).where("client_id = 'A'").orderBy("position").collect()
    assert [r.source_record_id for r in got] == ["y", "z", "a", "b"]
    assert [r.ordering_key for r in got] == sorted(r.ordering_key for r in got)
    assert [r.tied for r in got] == [False, True, True, False]


def test_calendar_and_deltas(spark):
    t = timeline.calendar(_timeline(spark))
    b = t.where("client_id = 'B'").first()
    assert (b.hour_of_day_local, b.day_of_week_local, b.lifetime_first, b.calendar_shifted) == (5, 1, True, True)
    assert sorted(r.delta_seconds for r in timeline.deltas(t).collect()) == [0, 0, 0]


def test_contract_counts_and_raises(spark):
    t = timeline.calendar(_timeline(spark))
    clean = {r.check: r.violations for r in checks.violations(t, "2024-02-01 00:00:00", {"event_type": ["T"]}).collect()}
    assert set(clean.values()) == {0}
    bad = t.unionByName(t.where("source_record_id = 'q'")).withColumn("calendar_zone", F.lit("+05:00"))
    found = checks.violations(bad, "2024-01-01 00:00:00", {"event_type": ["U"]})
    got = {r.check: r.violations for r in found.collect()}
    assert got["event_id_repeated"] == 1 and got["after_cutoff"] == 6 and got["no_zone"] == 6 and got["domain_event_type"] == 6 and got["position_gap"] == 1
    with pytest.raises(ValueError, match="after_cutoff"):
        checks.require(found)


def test_metrics_of_nothing_are_null(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0)], "s string, x int")
    got = {r.metric: (r.hits, r.total, r.rate) for r in checks.metrics(df, {"one": (F.col("x") == 1, F.lit(True)), "none": (F.lit(True), F.lit(False))}, "s").collect()}
    assert got == {"one_rate": (1, 2, 0.5), "none_rate": (0, 0, None)}


# --- tokens ---


def test_vocabulary_and_encoding(spark):
    df = spark.createDataFrame([(1, ["[EVT]", "key:a", "value:a:x", "key:b", "value:b:1"]), (2, ["[EVT]", "key:a", "value:a:x", "key:b", "value:b:2"]), (3, ["[EVT]", "key:a", "value:a:odd"])], "id int, tokens array<string>")
    v = tokens.vocabulary(df, ["a"], [], 2)
    names = [r.token for r in v.where("id is not null").orderBy("id").collect()]
    assert names == [*tokens.SPECIAL, "key:a", "key:b", "value:b:1", "value:b:2", "value:a:MISSING", "value:a:x", "value:a:RARE"]
    assert [r.token for r in v.where("id is null").collect()] == ["value:a:odd"]
    other = spark.createDataFrame([(3, ["[EVT]", "value:a:new", "value:a:odd", "value:a:MISSING", "value:b:2"])], "row int, tokens array<string>")
    coded = tokens.encode(other, v, ["a"], ["row"])
    assert [(r.id, r.fate) for r in coded.orderBy("pos").collect()] == [(3, "known"), (1, "unk"), (11, "rare"), (9, "known"), (8, "known")]
    assert tokens.decode(coded, v, ["row"]).first().tokens == ["[EVT]", "[UNK]", "value:a:RARE", "value:a:MISSING", "value:b:2"]


def test_a_value_outside_its_domain_stops_the_encoding(spark):
    df = spark.createDataFrame([(1, ["[EVT]", "key:b", "value:b:bucket_9", "value:b:7"])], "row int, tokens array<string>")
    v = tokens.vocabulary(df, ["a"], ["key:b", "value:b:bucket_0"], 1)
    assert "value:b:bucket_9" not in {r.token for r in v.collect()}
    with pytest.raises(Exception, match="no token of the vocabulary"):
        tokens.encode(df, v, ["a"], ["row"]).collect()
    got = {r.token: (r.id, r.fate) for r in tokens.encode(df, v, ["a"], ["row"], strict=False).collect()}
    assert got["value:b:bucket_9"] == (None, "violation") and got["key:b"] == (5, "known")


def test_ids_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(i, ["key:k", f"value:k:{i % 300}"]) for i in range(900)], "id int, tokens array<string>")
    a = sorted(tuple(r) for r in tokens.vocabulary(df, ["k"], [], 2).collect())
    assert a == sorted(tuple(r) for r in tokens.vocabulary(df.repartition(9), ["k"], [], 2).collect())
    ids = [r.id for r in tokens.vocabulary(df, ["k"], [], 2).orderBy("block", "token").collect() if r.block]
    assert ids == list(range(5, 5 + len(ids)))


SLOTS = [tokens.Slot("t", required=True), tokens.Slot("l", multivalue=True), tokens.Slot("x"), tokens.Slot("m", multivalue=True), tokens.Slot("r", required=True, multivalue=True)]


def plain_limit(row, most):
    """The rule step by step, one value at a time."""
    blocks = [[s, list(row[s.name]) if s.multivalue and row[s.name] else [row[s.name] or "MISSING"] if not s.multivalue else ["MISSING"]] for s in SLOTS]
    size = lambda: 1 + sum(1 + len(v) for _, v in blocks)
    for s, v in reversed(blocks):
        while s.multivalue and not s.required and len(v) > 1 and size() > most:
            v.pop()
    for b in list(reversed(blocks)):
        if size() > most and not b[0].required:
            blocks.remove(b)
    return None if size() > most else " ".join(["[EVT]", *(t for s, v in blocks for t in [f"key:{s.name}", *(f"value:{s.name}:{x}" for x in v)])])


def test_limit_against_plain_steps(spark):
    import random

    rng = random.Random(5)
    some = lambda p, k: None if rng.random() < 0.1 else [f"{p}{i}" for i in range(rng.randint(0, k))]
    rows = [(i, rng.choice(["a", None]), some("l", 5), rng.choice(["x", None]), some("m", 4), some("r", 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, t string, l array<string>, x string, m array<string>, r array<string>")
    for most in (24, 14, 11, 9):
        want = {r[0]: plain_limit(dict(zip(("id", "t", "l", "x", "m", "r"), r)), most) for r in rows}
        fit = [i for i, w in want.items() if w is not None]
        got = {r.id: r.s for r in df.where(F.col("id").isin(fit)).select("id", F.array_join(tokens.limited(SLOTS, most), " ").alias("s")).collect()}
        assert got == {i: want[i] for i in fit} and fit


def test_required_fields_that_do_not_fit_are_an_error(spark):
    df = spark.createDataFrame([("a", ["1"], "x", ["1"], ["1", "2", "3"])], "t string, l array<string>, x string, m array<string>, r array<string>")
    assert df.select(tokens.limited(SLOTS, 7).alias("s")).first().s == ["[EVT]", "key:t", "value:t:a", "key:r", "value:r:1", "value:r:2", "value:r:3"]
    with pytest.raises(Exception, match="do not fit in 6"):
        df.select(tokens.limited(SLOTS, 6)).collect()


def test_the_default_policy_fits_the_limit():
    from tidewell.plans.config import DEFAULT

    most = max(3 + sum(1 + (f.most_values if f.multivalue else 1) for f in model.values() if f.vocabulary != "excluded") for model in DEFAULT.sections.values())
    assert most <= tokens.EVENT_LIMIT


def test_masking_takes_tokens_of_the_same_field(spark):
    df = spark.createDataFrame([(i, ["[EVT]", "key:event_type", "value:event_type:T", "key:c", f"value:c:{i % 7}", "key:o", f"value:o:{i % 10 if i % 3 else i}"]) for i in range(1500)], "row int, tokens array<string>")
    v = tokens.vocabulary(df, ["o"], ["key:event_type", "key:c", "key:o", "value:event_type:T", *(f"value:c:{i}" for i in range(7)), "value:c:MISSING"], 20)
    names = {r.id: r.token for r in v.where("id is not null").collect()}
    fresh = df.unionByName(spark.createDataFrame([(9999, ["key:o", "value:o:new"])], df.schema))
    rows = tokens.masked(tokens.encode(fresh, v, ["o"], ["row"]), v, F.col("row").cast("string"), 3, 0.5).collect()
    chosen = [r for r in rows if r.action != "keep"]
    assert all(r.token.startswith(("value:c:", "value:o:")) and r.label == r.id != 1 for r in chosen)
    assert all(r.label is None and r.masked_id == r.id for r in rows if r.action == "keep")
    assert all(r.masked_id == {"mask": 2, "same": r.id}.get(r.action, r.masked_id) for r in chosen)
    swapped = [r for r in chosen if r.action == "random"]
    assert all(names[r.masked_id].split(":")[1] == r.token.split(":")[1] and not names[r.masked_id].endswith("MISSING") for r in swapped) and any(names[r.masked_id] == "value:o:RARE" for r in swapped)
    share = {a: sum(r.action == a for r in chosen) / len(chosen) for a in ("mask", "random", "same")}
    assert abs(len(chosen) / 3000 - 0.5) < 0.05 and abs(share["mask"] - 0.8) < 0.05 and abs(share["random"] - 0.1) < 0.04


def test_window_keeps_the_latest_whole_events(spark):
    df = ntz(spark.createDataFrame([("A", 0, 5, "2024-01-01 00:00:00"), ("A", 1, 5, "2024-01-01 00:00:10"), ("A", 2, 5, "2024-01-01 00:00:30")], "client_id string, position long, n_tokens int, ts string"), "ts")
    cut = tokens.window(df, 12)
    assert sorted((r.position, r.delta) for r in tokens.deltas_after(cut).collect()) == [(1, "WINDOW_START"), (2, "20")]
    edges = buckets.Edges((Decimal(10), Decimal(20)))
    assert sorted((r.position, r.delta) for r in tokens.deltas_after(df, edges).collect()) == [(0, "FIRST_EVENT"), (1, "bucket_1"), (2, "bucket_2")]
