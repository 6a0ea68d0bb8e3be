"""The generated data set: all edge cases, the same in any partitioning, and what the plan makes of them."""

import json

import pytest

from tidewell.plans import generate, preparation
from tidewell.plans.config import DEFAULT, check
from tidewell.sources import jsonl

CLIENTS = 8


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("made")
    manifest = generate.write(spark, f"file://{path}", CLIENTS, 0.1)
    return f"file://{path}", path, manifest


def test_every_case_is_there(root):
    _, path, manifest = root
    assert set(manifest["cases"]) == set(generate.CASES) and len(generate.CASES) == 32
    assert json.loads((path / "_meta" / "manifest.json").read_text()) == manifest
    assert {p.name for p in path.iterdir()} == {*DEFAULT.contracts, "_meta"}
    assert all(f.suffix in (".jsonl", ".crc") for d in DEFAULT.contracts for f in (path / d).iterdir())


def test_the_same_rows_in_any_partitioning(spark):
    a = {n: sorted(r.payload for r in df.collect()) for n, df in generate.dataset(spark, 6, 0.05).items()}
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "3")
    try:
        b = {n: sorted(r.payload for r in df.collect()) for n, df in generate.dataset(spark, 6, 0.05).items()}
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    assert a == b and all(a.values())


def test_background_records_keep_their_contracts(spark):
    for name, df in generate.dataset(spark, 6, 0.05).items():
        lines = df.where("case is null").selectExpr("'x' AS partition", "1L AS line_number", "payload AS value")
        assert jsonl.validate(lines, DEFAULT.contracts[name])[1].count() == 0, name


def test_what_the_plan_makes_of_the_cases(spark, root):
    path = root[0]
    artifacts = preparation.build(spark, path, check(DEFAULT))
    e = preparation.encode(spark, path, artifacts, artifacts.sha256())
    events = {r.ordering_key.rsplit("|", 1)[1]: r for r in e.events.collect()}
    letters = {r.source_record_id: r.reason for r in e.quarantine.collect()}
    profiles = {r.client_id: json.loads(r.fields) for r in e.profiles.collect()}
    made = {}
    for name, rows in generate._injected().items():
        for case, r in rows:
            made.setdefault(case, []).append(r.get("source_record_id") or r.get("rec_id") or r.get("event_uid"))
    fields = lambda case: json.loads(events[made[case][0]].fields)
    assert fields("null_given")["amount_base_bucket"] == fields("nan_text")["amount_base_bucket"] == fields("infinite_text")["amount_base_bucket"] == fields("rate_too_old")["amount_base_bucket"] == "MISSING"
    assert fields("dash_or_na")["direction"] == fields("key_left_out")["direction"] == "MISSING" and fields("blank_text")["currency"] == "MISSING"
    assert fields("foreign_money")["amount_base_bucket"] != "MISSING" != fields("rate_of_friday")["amount_base_bucket"]
    assert fields("below_training")["amount_base_bucket"] == "bucket_0" and fields("above_training")["amount_base_bucket"] == f"bucket_{len(artifacts.edges['amount_base_bucket'].edges)}"
    assert letters[made["code_unknown"][0]] == "unknown_event_type" and made["years_ahead"][0] not in events
    assert "CPX-BUSINESS-a" in events and "CPX-BUSINESS-b" not in events and "CPX-EXACT" in events and "CPX-CONFLICT" in events
    at_t, after_t = made["on_the_cutoff"][0], [x for x in made["past_the_cutoff"]]
    assert at_t in events and not set(after_t) & set(events)
    assert events[made["only_event"][0]].lifetime_first and events[made["old_zone_rule"][0]].hour_of_day_local == 12
    crossing = json.loads(events[made["session_cut_off"][0]].fields)
    assert len(crossing["screens"]) < 11 and events[made["session_cut_off"][0]].event_type == "APP_SESSION"
    assert profiles["C000005"]["age_bucket"] == "MISSING" and profiles["C000004"]["products"] == [f"P{i:02}" for i in range(1, 9)]
    assert "C000003" in profiles and profiles["C000003"]["first_seen_age_bucket"] == "MISSING" and profiles["C000002"]["region"] == "MISSING"
    assert {r.metric: r.level for r in e.metrics.where("label is null").collect()}["cutoff_violation_rate"] == "normal"
