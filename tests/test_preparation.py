"""The whole plan over a small raw data set."""

import json
from dataclasses import replace
from datetime import datetime

import pytest

from tests import fixtures
from tidewell.plans import preparation
from tidewell.plans.config import DEFAULT, PolicyError, check
from tidewell.sources import jsonl, storage


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return fixtures.write(tmp_path_factory.mktemp("raw"))


@pytest.fixture(scope="module")
def artifacts(spark, root):
    return preparation.build(spark, root)


@pytest.fixture(scope="module")
def encoded(spark, root, artifacts):
    e = preparation.encode(spark, root, artifacts, artifacts.sha256())
    return {
        "events": {r.ordering_key.rsplit("|", 1)[1]: r for r in e.events.collect()},
        "profiles": {r.client_id: r for r in e.profiles.collect()},
        "quarantine": {(r.source, r.source_record_id, r.reason, r.detail) for r in e.quarantine.collect()},
        "metrics": {(r.label, r.metric): (r.hits, r.total) for r in e.metrics.collect()},
        "levels": {(r.label, r.metric): r.level for r in e.metrics.collect()},
        "raw": e,
    }


def fields(r):
    return json.loads(r.fields)


def test_which_records_become_events(encoded):
    assert set(encoded["events"]) == {"P1", "P2", "P3", "P4", "P7", "P8-a", "P9", "P10", "P11", "P12", "P18", "R1", "R4", "R5", "A1", "A4", "A5", "A7"}


def test_quarantine(encoded):
    got = {(s, i, r) for s, i, r, _ in encoded["quarantine"]}
    assert got == {
        ("core_payments", "P5", "unknown_event_type"), ("core_payments", "P14", "unresolved_client_id"), ("core_payments", "P15", "unknown_timezone"),
        ("core_payments", "P16", "source_contract_violation"), ("core_payments", "P17", "source_contract_violation"), ("core_payments", " ", "source_contract_violation"),
        ("core_payments", "", "source_contract_violation"), ("card_processing", "R2", "incompatible_schema_version"), ("card_processing", "R3", "source_contract_violation"),
    }
    details = {i: d for _, i, _, d in encoded["quarantine"]}
    assert details["P16"] == "type:payload_version" and details["P17"] == "unknown_field" and details[" "] == "blank_key:source_record_id" and details[""] == "not_an_object" and details["R3"] == "null:amount_minor"


def test_missing_values(encoded):
    e = encoded["events"]
    assert fields(e["P2"]) == {"amount_base_bucket": "MISSING", "currency": "MISSING", "direction": "MISSING"}
    assert fields(e["P3"])["direction"] == "MISSING" and fields(e["P4"])["amount_base_bucket"] == "MISSING"
    assert fields(e["R5"])["amount_base_bucket"] == "MISSING"
    assert fields(e["P18"])["currency"] == "EUR" and fields(e["P18"])["amount_base_bucket"] == "MISSING"


def test_rates_are_used_for_three_days(encoded):
    e = encoded["events"]
    assert fields(e["P10"])["amount_base_bucket"] != "MISSING" and fields(e["P11"])["amount_base_bucket"] == "MISSING"
    assert encoded["metrics"][None, "fx_missing_rate"][0] == 2


def test_excluded_fields_are_gone(encoded):
    assert set(fields(encoded["events"]["R1"])) == {"amount_base_bucket", "currency", "merchant_category", "terminal_country"}
    assert fields(encoded["events"]["R4"])["block_reason"] == "EXPIRED"


def test_sessions_and_the_cutoff(encoded):
    e = encoded["events"]
    assert fields(e["A1"])["screens"] == ["HOME", "CARDS"] and fields(e["A1"])["device_category"] == "IOS"
    assert fields(e["A4"])["screens"] == ["HOME"] and fields(e["A5"])["screens"] == ["HOME"]
    assert e["A7"].event_type == "PUSH_NOTIFICATION"


def test_profiles(encoded):
    p = encoded["profiles"]
    assert set(p) == {"C000000", "C000001", "C000002"}
    assert p["C000000"].profile_ts == datetime(2026, 1, 31, 19) and fields(p["C000000"])["products"] == [f"P{i:02}" for i in range(1, 9)]
    assert fields(p["C000000"])["age_bucket"] == "MISSING" and fields(p["C000000"])["region"] == "ALMATY"
    assert fields(p["C000001"])["region"] == "MISSING" and fields(p["C000001"])["products"] == "MISSING" and p["C000001"].profile_ts == datetime(2026, 1, 31, 23, 59, 59)
    assert fields(p["C000002"])["first_seen_age_bucket"] == "MISSING" and fields(p["C000002"])["lifetime_event_count_bucket"] != "MISSING"


def test_timeline(encoded):
    mine = sorted((r for r in encoded["events"].values() if r.client_id == "C000000"), key=lambda r: r.position)
    assert [r.position for r in mine] == list(range(len(mine))) and [r.lifetime_first for r in mine].count(True) == 1
    assert [r.ordering_key for r in mine] == sorted(r.ordering_key for r in mine)
    assert encoded["events"]["P1"].hour_of_day_local == 15 and encoded["events"]["P1"].day_of_week_local == 1


def test_frozen_state(spark, root, artifacts, encoded, tmp_path):
    sha = storage.freeze(spark, artifacts, f"file://{tmp_path}/a")
    assert storage.thaw(spark, f"file://{tmp_path}/a", DEFAULT).sha256() == sha == artifacts.sha256()
    with pytest.raises(preparation.StateMismatch):
        storage.thaw(spark, f"file://{tmp_path}/a", DEFAULT.at(fx_days=4))
    with pytest.raises(preparation.StateMismatch):
        preparation.encode(spark, root, artifacts, "0" * 64)
    storage.write_outputs(encoded["raw"], f"file://{tmp_path}/out")
    assert spark.read.json(f"file://{tmp_path}/out/prepared_events").count() == len(encoded["events"])
    assert spark.read.json(f"file://{tmp_path}/out/quarantine").count() == 9


def test_metrics_of_the_run(encoded):
    m = encoded["metrics"]
    from tidewell.operators.checks import RATES

    assert {n for _, n in m} == set(RATES)
    assert m[None, "late_arriving_rate"][1] == m[None, "calendar_timezone_fallback_rate"][1] + 2 or m[None, "late_arriving_rate"][1] > 30
    assert m[None, "schema_violation_rate"][0] == 6 and m[None, "schema_violation_rate"][1] == len(encoded["events"]) + 3
    assert m[None, "unknown_event_type_rate"][0] == 1 and m[None, "timestamp_error_rate"][0] == 1 and m[None, "dedup_conflict_rate"][0] == 0
    assert m[None, "dedup_conflict_rate"][1] == 2  # P7 and P9 come twice
    assert m[None, "numeric_nan_rate"][0] == 1 and m["age_bucket", "numeric_business_range_error_rate"][0] == 1 and m["amount_base_bucket", "numeric_business_range_error_rate"][0] == 1
    assert m["direction", "missing_rate"][0] == 2 and m["screens", "missing_rate"] == (0, 3)
    assert m[None, "profile_missing_rate"] == (1, 3) and m[None, "session_anomaly_rate"] == (0, 3) and m[None, "bucket_domain_violation_rate"][0] == 0
    assert m[None, "numeric_clip_rate"][0] == 0 and m[None, "numeric_clip_rate"][1] > 20
    assert encoded["levels"][None, "unknown_event_type_rate"] == "critical" and encoded["levels"][None, "cutoff_violation_rate"] == "normal"


def test_the_state_has_22_sections_and_each_change_is_seen(artifacts):
    from decimal import Decimal

    assert len(artifacts.document()) == 22
    edges = {n: replace(e, edges=(*e.edges, Decimal(10**12))) if n == "age_bucket" else e for n, e in artifacts.edges.items()}
    others = [
        replace(artifacts, edges=edges), replace(artifacts, identity={}), replace(artifacts, delta=replace(artifacts.delta, edges=())),
        *(replace(artifacts, policy=DEFAULT.at(**c)) for c in ({"seed": 1}, {"cutoff": "2026-01-30 23:59:59"}, {"fx_days": 1}, {"session_gap_seconds": 1}, {"placeholders": ()}, {"topup_direction": "OUT"}, {"default_bucket": ("quantile", 8)}, {"horizon_days": 1}, {"zones": {}})),
    ]
    assert len({artifacts.sha256(), *(x.sha256() for x in others)}) == 1 + len(others)


def test_documents_of_a_build_and_of_an_output(spark, artifacts, encoded, tmp_path):
    from tidewell.plans import documents

    built = documents.artifacts(artifacts, "t", "2026-02-01T00:00:00Z")
    assert len(built) == 22 + 14 + 1 and json.loads(built["preprocessing_state_sha256.json"]) == artifacts.sha256()
    storage.freeze(spark, artifacts, f"file://{tmp_path}/a", built)
    docs = documents.prepared(artifacts, encoded["raw"], "t")
    manifest = json.loads(docs["contract.json"])
    assert len(manifest) == 19 and len(docs) == 15
    storage.write_outputs(encoded["raw"], f"file://{tmp_path}/out", docs)
    for item in manifest.values():
        if item["file"].endswith(".json"):
            doc = json.loads((tmp_path / "out" / item["file"]).read_text())
            assert item.get("key") is None or item["key"] in doc
        else:
            lines = [json.loads(x) for f in sorted((tmp_path / "out" / item["file"]).glob("part-*")) for x in f.read_text().splitlines()]
            assert lines and all(item.get("key") is None or item["key"] in x for x in lines)
    first = next(json.loads(x) for f in sorted((tmp_path / "out" / "prepared_events").glob("part-*")) for x in f.read_text().splitlines())
    assert set(first) == {"client_id", "event_id", "event_type", "timestamp_utc", "calendar_timezone", "ordering_key", "fields", "calendar_time_features", "lifetime_first"} and isinstance(first["fields"], dict)
    assert documents.code_state()["sha256"] == documents.code_state()["sha256"] and len(documents.code_state()["files"]) > 20


def test_golden_names_the_first_difference(spark, root, artifacts, encoded, tmp_path):

    from pyspark.sql import functions as F

    from tidewell.plans import golden

    path = f"file://{tmp_path}/golden"
    raw = encoded["raw"]
    with pytest.raises(golden.GoldenMismatch, match="no frozen"):
        golden.compare(spark, raw, artifacts, path)
    golden.freeze(spark, raw, artifacts, path, "1", "t")
    golden.compare(spark, raw, artifacts, path)
    with pytest.raises(golden.GoldenMismatch, match="already"):
        golden.freeze(spark, raw, artifacts, path, "1", "t")
    changed = replace(raw, events=raw.events.withColumn("lifetime_first", F.lit(False)), profiles=raw.profiles.where("client_id != 'C000001'"))
    found = golden.differences(spark, changed, artifacts, path)
    assert found == {"prepared_events": "row ('C000000', 0): lifetime_first is false for true", "prepared_profile": "row ('C000001',): * is None for a row"}
    with pytest.raises(golden.GoldenMismatch, match="preprocessing_state_sha256"):
        golden.compare(spark, raw, replace(artifacts, policy=DEFAULT.at(seed=1)), path)


def test_the_output_contract_sees_every_kind_of_break(spark):
    from pyspark.sql import functions as F

    from tidewell.operators import checks

    rows = spark.createDataFrame([("A", "bucket_1", ["X"], None, "id"), ("A", "bucket_9", ["X", "Z"], None, None), ("B", None, None, 1.5, None), ("B", "bucket_0", None, None, None)], "event_type string, b string, l array<string>, f double, secret string")
    sections = {"A": {"b": checks.Declared(("bucket_0", "bucket_1"), True), "l": checks.Declared(("X", "Y"), multivalue=True)}, "B": {"f": checks.Declared(), "gone": checks.Declared()}}
    got = {r.check: r.violations for r in checks.field_violations(rows, sections, ["secret"]).collect()}
    assert got == {"domain:A.b": 1, "domain:A.l": 1, "undeclared:b": 1, "undeclared:l": 0, "undeclared:f": 0, "float:f": 1, "absent:gone": 4, "excluded:secret": 1}
    n = checks.checked_values(rows, {k: {f: d for f, d in v.items() if f != "gone"} for k, v in sections.items()}).first()
    assert (n.fields_checked, n.bucket_values, n.closed_set_values) == (6, 2, 3)
    p = spark.createDataFrame([("c", "2024-01-01 00:00:00"), ("c", None), ("d", "2025-01-01 00:00:00"), (None, "2024-01-01 00:00:00")], "client_id string, profile_ts string").withColumn("profile_ts", F.col("profile_ts").cast("timestamp_ntz"))
    assert {r.check: r.violations for r in checks.profile_violations(p, "2024-06-01 00:00:00").collect()} == {"profile_repeated": 1, "profile_no_client": 1, "profile_no_time": 1, "profile_after_cutoff": 1}


def test_only_training_sets_build(spark, tmp_path):
    with pytest.raises(PolicyError, match="training set"):
        preparation.build(spark, fixtures.write(tmp_path, role="golden_input"))


@pytest.mark.parametrize("split", ["64m", "200"])
def test_line_numbers_do_not_depend_on_splits(spark, tmp_path, split):
    lines = [f"{i} " + "x" * (i % 37) for i in range(300)]
    lines[5] = lines[6] = ""
    for name in ("a.jsonl", "b.jsonl"):
        (tmp_path / "s").mkdir(exist_ok=True)
        (tmp_path / "s" / name).write_text("\r\n".join(lines[:150]) + "\n" + "\n".join(lines[150:]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = sorted(tuple(r) for r in jsonl.read_lines(spark, f"file://{tmp_path}", "s").collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == sorted((n, i + 1, x) for n in ("a.jsonl", "b.jsonl") for i, x in enumerate(lines) if x)


def test_layout(spark, tmp_path):
    root = fixtures.write(tmp_path)
    (tmp_path / "core_payments" / "x.csv").write_text("")
    with pytest.raises(jsonl.ContractError, match="x.csv"):
        jsonl.check_layout(spark, root, DEFAULT.contracts)
    (tmp_path / "core_payments" / "x.csv").unlink()
    (tmp_path / "unknown").mkdir()
    with pytest.raises(jsonl.ContractError, match="unknown"):
        jsonl.check_layout(spark, root, DEFAULT.contracts)


@pytest.mark.parametrize(
    ("change", "why"),
    [
        ({"zones": {"A": "Mars/Base"}}, "IANA"),
        ({"fingerprints": {}}, "fingerprints"),
        ({"fingerprints": DEFAULT.fingerprints | {"app_logs": ("client_id",)}}, "two distinct"),
        ({"fingerprints": DEFAULT.fingerprints | {"profile_snapshots": ("client_id", "products")}}, "list"),
        ({"fingerprints": DEFAULT.fingerprints | {"fx_rates": ("client_id", "ts")}}, "no client"),
        ({"codes": {}}, "event sources"),
        ({"codes": DEFAULT.codes | {"app_logs": {"x": "NEW"}}}, "unapproved"),
        ({"session_starts": ("push_received",)}, "session"),
        ({"session_actions": ("LOGIN",)}, "no actions"),
        ({"session_actions": (*DEFAULT.session_actions, "swipe")}, "without a code"),
        ({"session_actions": (*DEFAULT.session_actions, "push_received")}, "events of their own"),
        ({"codes": DEFAULT.codes | {"card_processing": {"PUR": None}}}, "only session actions"),
        ({"session_gap_seconds": 0}, "gap"),
        ({"profile": DEFAULT.profile | {"region": replace(DEFAULT.profile["region"], source="nothing")}}, "no column nothing"),
        ({"sections": DEFAULT.sections | {"CARD_BLOCK": {"block_reason": replace(DEFAULT.sections["CARD_BLOCK"]["block_reason"], source="nothing")}}}, "no event source"),
        ({"profile": {n: f for n, f in DEFAULT.profile.items() if n != "account_age_bucket"}}, "life-long"),
        ({"version": "1"}, "version"),
        ({"delta_buckets": 1}, "ranges"),
        ({"sections": {}}, "section"),
        ({"aliases": {"nothing": {}}}, "unknown field"),
        ({"aliases": {"currency": {"A": "B", "B": "KZT"}}}, "alias of an alias"),
        ({"aliases": {"currency": {"A": "GBP"}}}, "outside the domain"),
        ({"buckets": {"currency": ("quantile", 4)}}, "that is none"),
        ({"buckets": {"age_bucket": ("quantile", 1)}}, "two buckets"),
        ({"fx_providers": ()}, "provider"),
        ({"topup_types": ("NOTHING",)}, "approved"),
        ({"cutoff": "2026-01-31"}, "cutoff"),
    ],
)
def test_policy_checks(change, why):
    with pytest.raises(PolicyError, match=why):
        check(DEFAULT.at(**change))


@pytest.mark.parametrize(
    ("change", "why"),
    [
        ({"primary_key": ()}, "primary key"),
        ({"primary_key": ("nothing",)}, "not declared"),
        ({"primary_key": ("age",)}, "required string"),
        ({"client_field": None}, "client"),
        ({"time_field": "nothing"}, "not declared"),
        ({"zone_policy": "from_field_mapping"}, "zone field"),
        ({"default_zone": None}, "default zone"),
    ],
)
def test_contract_checks(change, why):

    with pytest.raises(jsonl.ContractError, match=why):
        replace(DEFAULT.contracts["profile_snapshots"], **change)


def test_default_policy_is_sound():
    assert check(DEFAULT) is DEFAULT


def test_a_frozen_state_needs_no_policy_from_code(spark, root, artifacts, encoded, tmp_path):
    import subprocess
    import sys

    sha = storage.freeze(spark, artifacts, f"file://{tmp_path}/a")
    back = storage.thaw(spark, f"file://{tmp_path}/a")
    assert back.sha256() == sha and back.policy == artifacts.policy and list(back.policy.profile) == list(artifacts.policy.profile)
    code = f"""
from pyspark.sql import SparkSession
from tidewell.sources import storage
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", "{tmp_path}/shared").getOrCreate()
print("HASH", storage.thaw(spark, "file://{tmp_path}/a").sha256())
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=str(tmp_path.parent), env={**__import__("os").environ, "PYTHONPATH": ":".join(sys.path)})
    assert f"HASH {sha}" in out.stdout
    with pytest.raises(preparation.StateMismatch):
        storage.thaw(spark, f"file://{tmp_path}/a", DEFAULT.at(seed=1))
    spark.read.parquet(f"{tmp_path}/a/identity").limit(1).write.mode("append").parquet(f"{tmp_path}/a/identity")
    with pytest.raises(preparation.StateMismatch):
        storage.thaw(spark, f"file://{tmp_path}/a")


@pytest.mark.parametrize(
    ("change", "why"),
    [
        (lambda d: d.update(form=2), "form 2"),
        (lambda d: d.pop("fx_config"), "without"),
        (lambda d: d.update(more={}), "unknown parts"),
        (lambda d: d["feature_schema"]["TRANSFER"]["currency"].update(priority=1), "priorities"),
        (lambda d: d["feature_schema"]["TRANSFER"]["currency"].update(vocabulary="bucket_closed_set"), "numeric"),
        (lambda d: d["feature_schema"]["PROFILE"].pop("account_age_bucket"), "priorities"),
        (lambda d: d["feature_schema"].update(OTHER={}), "without an event type"),
        (lambda d: d["source_contracts"]["core_payments"].update(kind="none"), "unknown kind"),
        (lambda d: d["source_contracts"]["core_payments"].update(unheard_of=1), "unheard_of"),
        (lambda d: d["source_contracts"]["core_payments"]["column_order"].pop(), "other columns"),
        (lambda d: d["sessionization_config"].update(gap_seconds=0), "positive"),
        (lambda d: d["run_policy"].update(version="1"), "three numbers"),
        (lambda d: d["calendar_timezone_policy"]["zones"].update(X="Mars/Base"), "IANA"),
        (lambda d: d["cutoff_policy"].update(cutoff="yesterday"), "instant"),
    ],
)
def test_policy_documents_are_checked(change, why):
    from tidewell.plans import documents

    d = json.loads(documents.canonical(documents.policy_sections(DEFAULT)))
    assert documents.policy_of(json.loads(json.dumps(d))) == DEFAULT
    change(d)
    with pytest.raises(PolicyError, match=why):
        documents.policy_of(d)


def test_the_order_of_fields_is_part_of_the_state(artifacts):
    turned = DEFAULT.sections | {"TRANSFER": dict(reversed(DEFAULT.sections["TRANSFER"].items()))}
    assert replace(artifacts, policy=DEFAULT.at(sections=turned)).sha256() != artifacts.sha256()


def test_identity_is_a_table_of_any_form(spark, root, artifacts, tmp_path):
    lines = [{"section": s, "ref": r, "client_id": c} for s, refs in fixtures.IDS.items() for r, c in refs.items()]
    (tmp_path / "ids").mkdir()
    for i in range(3):
        (tmp_path / "ids" / f"{i}.json").write_text("".join(json.dumps(x) + "\n" for x in reversed(lines[i::3])))
    one = preparation.read_identity(spark, f"file://{tmp_path}/ids", DEFAULT)
    assert one.document() == artifacts.identity.document() and one.rows == len(lines)

    def read(doc):
        (tmp_path / "bad.json").write_text(doc)
        return preparation.read_identity(spark, f"file://{tmp_path}/bad", DEFAULT)

    names = list(fixtures.IDS)
    whole = lambda **more: json.dumps(fixtures.IDS | more)
    for doc, why in (
        (json.dumps({names[0]: {}}), "sections"), (whole(**{names[0]: {"": "C000001"}}), "empty reference"), (whole(**{names[0]: {"x": "nobody"}}), "malformed"),
        (whole(**{names[0]: {"x": "C000001", "y": "C000001"}}), "two references"), (whole().replace(f'"{names[0]}": {{', f'"{names[0]}": {{"x": "C000008", "x": "C000009", ', 1), "repeats"),
    ):
        with pytest.raises(PolicyError, match=why):
            read(doc)
    assert read(whole(**{names[0]: {}})).rows == len(lines) - len(fixtures.IDS[names[0]])


def test_prepared_clients_become_sequences(spark, root, artifacts, encoded, tmp_path):
    from tidewell.plans import documents
    from tidewell.plans import tokenizer as tz

    docs = documents.prepared(artifacts, encoded["raw"], "t")
    layout = tz.layout_of(docs, min_count=1)
    assert layout.events["TRANSFER"] == tuple(DEFAULT.sections["TRANSFER"]) and "atm_id" not in layout.events["CASH_WITHDRAWAL"] and layout.lists == ("products", "screens")
    own = tz.of_encoded(encoded["raw"], artifacts)
    frozen = tz.fit(own, layout)
    folder = storage.publish(encoded["raw"], f"file://{tmp_path}/out", docs)
    back, read = tz.read_prepared(spark, storage.current(spark, f"file://{tmp_path}/out", verify=True))
    assert folder and tz.layout_of(read, min_count=1) == layout and tz.fit(back, layout).sha256() == frozen.sha256()
    rows = lambda p: {r.client_id: r for r in tz.encode(p, frozen, 256).collect()}
    one = rows(own)
    assert rows(back) == one and set(one) == set(encoded["profiles"]) | {r.client_id for r in encoded["events"].values()}
    names = {r.id: r.token for r in frozen.vocab.where("id is not null").collect()}
    mine = one["C000000"]
    told = [names[i] for i in mine.input_ids[: mine.n_ids]]
    assert told[0] == "[USR]" and told.count("[EVT]") == mine.n_events == sum(r.client_id == "C000000" for r in encoded["events"].values()) and mine.n_unk == 0
    assert [told[i] for i in mine.event_at] == ["[EVT]"] * mine.n_events and mine.delta[0] == "FIRST_EVENT" and mine.attention_mask == [1] * mine.n_ids + [0] * (256 - mine.n_ids)
    with pytest.raises(preparation.StateMismatch):
        tz.encode(replace(back, state_sha256="0" * 64), frozen)


def test_the_ledger_has_a_fate_for_every_line(spark, root, encoded):
    from tidewell.plans import ledger

    p = preparation.prepare(spark, root, DEFAULT, fixtures.IDS)
    rows = ledger.of(p, DEFAULT).collect()
    read = sum(s["read"].count() for s in p.steps.values())
    assert len(rows) == len({(r.source, r.partition, r.line_number) for r in rows}) == read
    fates = {f: [r for r in rows if r.fate == f] for f in {r.fate for r in rows}}
    assert set(fates) <= {"rejected", "cut", "version", "same_fact", "event", "action", "snapshot", "rate"} and len(fates["rejected"]) == 9
    ids = {r.event_id: r.event_type for r in encoded["events"].values()}
    assert {r.event_id for r in fates["event"] + fates["action"]} == set(ids)
    assert {ids[r.event_id] for r in fates["action"]} == {"APP_SESSION"} and all(ids[r.event_id] != "APP_SESSION" for r in fates["event"])
    lines = {f"{r.partition}#{r.line_number}": r for r in rows if r.source == "core_payments"}
    assert fates["version"] and fates["same_fact"] and all(lines[r.superseded_by].fate in ("event", "same_fact") for r in fates["version"] + fates["same_fact"] if r.source == "core_payments")


def test_golden_bytes_name_the_first_byte(spark, encoded, tmp_path):
    from pyspark.sql import functions as F

    from tidewell.plans import golden

    raw = encoded["raw"]
    roots = golden.freeze_bytes(raw, f"file://{tmp_path}/g", 4)
    assert set(roots) == {"prepared_events", "prepared_profile"} and golden.byte_differences(raw, f"file://{tmp_path}/g", 4) == {}
    with pytest.raises(golden.GoldenMismatch, match="already"):
        golden.freeze_bytes(raw, f"file://{tmp_path}/g", 4)
    last = max(encoded["events"].values(), key=lambda r: (r.client_id, r.position))
    changed = replace(raw, events=raw.events.withColumn("event_type", F.when(F.col("event_id") == last.event_id, "X").otherwise(F.col("event_type"))))
    (d,) = golden.byte_differences(changed, f"file://{tmp_path}/g", 4).values()
    assert d.line == len(encoded["events"]) - 1 and d.block == d.line // 4 and d.want[: d.byte] == d.got[: d.byte] and d.want[d.byte] != d.got[d.byte]
