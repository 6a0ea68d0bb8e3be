"""The documents beside the tables: the state in its sections, a build's artifacts, what a reader of the output needs."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict
from decimal import Decimal
from pathlib import Path

from ..functions.hashing import SEED_MIXER
from ..operators.buckets import Edges
from ..operators.fields import MISSING
from ..sources.jsonl import ColumnSpec, Contract, ContractError
from .config import Field, Numeric, Policy, PolicyError, check

TEXT_POLICY = {"trim": True, "unicode": "NFKC", "case": "upper", "missing": MISSING}
SERIALIZATION = {"format": "json", "encoding": "utf-8", "keys": "sorted", "white_space": "none", "decimals": "plain text"}
HASHES = {"digest": "sha-256 over parts, each after its length in eight big-endian bytes", "event_id_hex_digits": 32, "priority": "first 64 bits xor seed times mixer", "mixer": SEED_MIXER}
SAMPLING = {"kept": "the least priorities of each field", "ties": "by key", "key": "event_id, or raw_reference of a profile"}


def canonical(doc) -> str:
    """A document as text: keys sorted, no white space, decimals as text."""
    return json.dumps(doc, sort_keys=True, ensure_ascii=False, separators=(",", ":"), default=lambda x: format(x, "f") if isinstance(x, Decimal) else str(x))


def _fields(policy: Policy) -> dict[str, Field]:
    return {n: f for s in [*policy.sections.values(), policy.profile] for n, f in s.items()}


def closed_domains(policy: Policy) -> dict[str, list[str]]:
    return {"event_type": list(policy.event_types)} | {n: [*f.domain, MISSING] for n, f in _fields(policy).items() if f.domain}


def bucket_domains(edges: dict[str, Edges]) -> dict[str, list[str]]:
    return {n: [*e.domain(), MISSING] for n, e in edges.items()}


def bucket_metadata(edges: dict[str, Edges]) -> dict:
    return {n: {"method": e.method, "asked": e.asked, "buckets": len(e.edges) + 1, "least": e.least, "most": e.most, "values": e.n_values, "closed": "left", "beyond": "outer bucket"} for n, e in edges.items()}


def priorities(policy: Policy) -> dict[str, dict[str, int]]:
    return {s: {n: i + 1 for i, n in enumerate(model)} for s, model in [*policy.sections.items(), ("PROFILE", policy.profile)]}


def most_values(policy: Policy) -> dict[str, int]:
    return {n: f.most_values for n, f in _fields(policy).items() if f.multivalue}


def state(artifacts) -> dict[str, dict]:
    """All that decides what a run computes, in 22 sections; their canonical text is what the state's hash is of."""
    p: Policy = artifacts.policy
    numeric = {n: asdict(f.numeric) for n, f in _fields(p).items() if f.numeric}
    times = {n: {"field": c.time_field, "kind": c.time_kind, "processing_field": c.processing_field, "zone_policy": c.zone_policy, "zone_field": c.zone_field, "default_zone": c.default_zone, "max_delay_hours": c.max_delay_hours} for n, c in p.contracts.items()}
    return {
        "source_contracts": {n: asdict(c) | {"column_order": list(c.columns)} for n, c in p.contracts.items()},
        "identity_mapping": artifacts.identity if isinstance(artifacts.identity, dict) else artifacts.identity.document(),
        "event_mapping": {"codes": p.codes, "event_types": p.event_types},
        "category_mapping": {"aliases": p.aliases, "placeholders": p.placeholders},
        "feature_schema": {s: {n: asdict(f) | {"priority": i + 1} for i, (n, f) in enumerate(model.items())} for s, model in [*p.sections.items(), ("PROFILE", p.profile)]},
        "closed_set_domains": closed_domains(p),
        "bucket_field_domains": bucket_domains(artifacts.edges),
        "timestamp_policy": {"sources": times, "horizon_days": p.horizon_days},
        "calendar_timezone_policy": {"zones": p.zones},
        "dedup_config": {"fingerprints": p.fingerprints, "versions": {n: c.version_field for n, c in p.contracts.items()}},
        "sessionization_config": {"source": p.session_source, "actions": p.session_actions, "starts": p.session_starts, "gap_seconds": p.session_gap_seconds},
        "fx_config": {"base": p.base_currency, "source": p.fx_source, "providers": p.fx_providers, "days": p.fx_days},
        "bucket_edges": {n: list(e.edges) for n, e in artifacts.edges.items()},
        "time_delta_edges": {"edges": list(artifacts.delta.edges), "reserved": ["FIRST_EVENT", "WINDOW_START"], "asked": artifacts.delta.asked},
        "numeric_rules": numeric,
        "text_policy": TEXT_POLICY,
        "cutoff_policy": {"cutoff": p.cutoff, "inclusive": True, "zone": "UTC"},
        "serialization_config": SERIALIZATION,
        "hash_policy": HASHES,
        "bucketization_config": {"fields": p.buckets, "default": p.default_bucket, "delta_buckets": p.delta_buckets},
        "profile_policy": {"transactions": p.transactions, "topup_types": p.topup_types, "topup_direction": p.topup_direction},
        "run_policy": {"seed": p.seed, "sample_size": p.sample_size, "client_pattern": p.client_pattern, "version": p.version},
    }


#: The form of the policy in documents that this code reads and writes.
POLICY_FORM = 1


def _plain(x):
    """Lists as tuples, at any depth: policies hold tuples."""
    return tuple(_plain(v) for v in x) if isinstance(x, list) else {k: _plain(v) for k, v in x.items()} if isinstance(x, dict) else x


def policy_sections(policy: Policy) -> dict:
    """What ``policy_of`` needs: the sections of a state that say what the policy is."""
    from .preparation import Artifacts

    sections = state(Artifacts(policy, {}, {}, Edges(())))
    return {n: sections[n] for n in POLICY_SECTIONS} | {"form": POLICY_FORM}


POLICY_SECTIONS = (
    "source_contracts", "event_mapping", "category_mapping", "feature_schema", "timestamp_policy", "calendar_timezone_policy", "dedup_config", "sessionization_config", "fx_config", "cutoff_policy",
    "bucketization_config", "profile_policy", "run_policy",
)


def policy_of(sections: dict) -> Policy:
    """The policy that documents describe; raises ``PolicyError`` on another form, on missing or unknown parts, and on whatever
    ``config.check`` does not allow. The order of columns and fields is that of their places, not of the document."""
    if sections.get("form") != POLICY_FORM:
        raise PolicyError(f"a policy of form {sections.get('form')}; this code reads form {POLICY_FORM}")
    lost, new = set(POLICY_SECTIONS) - set(sections), set(sections) - {*POLICY_SECTIONS, "form"}
    if lost or new:
        raise PolicyError(f"a policy without {sorted(lost)}" if lost else f"unknown parts of a policy {sorted(new)}")
    d = _plain({n: sections[n] for n in POLICY_SECTIONS})

    def contract(c: dict) -> Contract:
        c = dict(c)
        order = c.pop("column_order")
        if set(order) != set(c["columns"]):
            raise PolicyError(f"{c['name']}: the order names other columns")
        return Contract(**c | {"columns": {n: ColumnSpec(**c["columns"][n]) for n in order}})

    def model(fields: dict) -> dict[str, Field]:
        rank = {n: f["priority"] for n, f in fields.items()}
        if sorted(rank.values()) != list(range(1, len(rank) + 1)):
            raise PolicyError("priorities of a section's fields are not 1, 2, ...")
        rest = lambda f: {k: v for k, v in f.items() if k != "priority"} | {"numeric": Numeric(**f["numeric"]) if f["numeric"] else None}
        return {n: Field(**rest(fields[n])) for n in sorted(rank, key=rank.get)}

    try:
        models = {s: model(f) for s, f in d["feature_schema"].items()}
        profile = models.pop("PROFILE")
        session, fx, run = d["sessionization_config"], d["fx_config"], d["run_policy"]
        out = Policy(
            {n: contract(c) for n, c in d["source_contracts"].items()}, d["calendar_timezone_policy"]["zones"], d["event_mapping"]["codes"], d["event_mapping"]["event_types"], d["dedup_config"]["fingerprints"],
            {t: models.pop(t) for t in d["event_mapping"]["event_types"]}, profile, d["category_mapping"]["aliases"], d["category_mapping"]["placeholders"],
            d["bucketization_config"]["fields"], d["bucketization_config"]["default"], d["bucketization_config"]["delta_buckets"],
            session["source"], session["actions"], session["starts"], session["gap_seconds"], fx["base"], fx["source"], fx["providers"], fx["days"],
            d["profile_policy"]["transactions"], d["profile_policy"]["topup_types"], d["profile_policy"]["topup_direction"], d["cutoff_policy"]["cutoff"], d["timestamp_policy"]["horizon_days"],
            run["sample_size"], run["seed"], run["client_pattern"], run["version"],
        )
    except (KeyError, TypeError, AttributeError, ContractError) as e:
        raise PolicyError(f"not a policy: {e}") from e
    if models:
        raise PolicyError(f"sections without an event type: {sorted(models)}")
    return check(out)


def code_state() -> dict:
    """SHA-256 of every source file of the preparation part, and of them all."""
    root = Path(__file__).resolve().parent.parent
    files = {str(f.relative_to(root)): hashlib.sha256(f.read_bytes()).hexdigest() for d in ("functions", "operators", "plans", "sources", "streaming") for f in sorted((root / d).glob("*.py"))}
    return {"files": files, "sha256": hashlib.sha256(canonical(files).encode()).hexdigest()}


def artifacts(built, dataset: str, built_at: str, baselines: dict | None = None, golden: str | None = None) -> dict[str, str]:
    """file name -> text of a build's artifacts: every section of the state, with its hash, and what the state does not hold."""
    p: Policy = built.policy
    sections = state(built)
    extra = {
        "bucket_metadata": bucket_metadata(built.edges), "fx_max_staleness": p.fx_days, "field_priorities": priorities(p), "max_values_per_field": most_values(p),
        "high_cardinality_policy": {n: f.vocabulary for n, f in _fields(p).items() if f.vocabulary in ("frequency_pruned", "excluded")}, "train_baselines": baselines or {},
        "deterministic_build_config": {"depends_on": ["rows", "policy"], "independent_of": ["partitions", "splits", "workers"]}, "sampling_algorithm": SAMPLING, "global_seed": p.seed,
        "golden_vectors": {"expected": golden, "frozen": golden is not None}, "preprocessing_state_sha256": built.sha256(), "code_state": code_state(), "train_dataset_identifier": dataset, "build_timestamp": built_at,
    }
    every = sections | extra
    hashes = {n: hashlib.sha256(canonical(d).encode()).hexdigest() for n, d in every.items()}
    return {f"{n}.json": canonical(d) for n, d in every.items()} | {"artifact_hashes.json": canonical(hashes)}


#: What a reader of the output is promised: item -> (file, key in it). Fixed values.
CONTRACT = {
    "prepared_profile": ("prepared_profile", None), "prepared_events": ("prepared_events", None), "feature_schema": ("feature_schema.json", None),
    "closed_set_domains": ("closed_set_domains.json", None), "bucket_field_domains": ("bucket_field_domains.json", None), "bucket_metadata": ("bucket_metadata.json", None),
    "time_delta_edges": ("time_delta_edges.json", None), "calendar_time_features": ("prepared_events", "calendar_time_features"), "currency_normalization_config": ("currency_normalization_config.json", None),
    "fx_max_staleness": ("metadata.json", "fx_max_staleness_days"), "sessionization_config": ("sessionization_config.json", None), "field_priority": ("field_priority.json", None),
    "max_values_per_field": ("max_values_per_field.json", None), "text_policy": ("text_policy.json", None), "cutoff_policy": ("cutoff_policy.json", None),
    "preprocessing_version": ("metadata.json", "preprocessing_version"), "preprocessing_state_sha256": ("metadata.json", "preprocessing_state_sha256"),
    "data_quality_statistics": ("data_quality.json", None), "lifetime_first": ("prepared_events", "lifetime_first"),
}


def prepared(built, encoded, dataset: str) -> dict[str, str]:
    """file name -> text of the documents beside prepared events and profiles, with the manifest of the contract.

    The metrics (one row a rate and label) and the number of dead letters by reason come to the driver.
    """
    sections = state(built)
    rates = [r.asDict() for r in encoded.metrics.orderBy("metric", "label").collect()]
    letters = {r["reason"]: r["count"] for r in encoded.quarantine.groupBy("reason").count().collect()}
    docs = {
        "feature_schema.json": sections["feature_schema"], "closed_set_domains.json": sections["closed_set_domains"], "bucket_field_domains.json": sections["bucket_field_domains"],
        "bucket_metadata.json": bucket_metadata(built.edges), "time_delta_edges.json": sections["time_delta_edges"], "currency_normalization_config.json": sections["fx_config"],
        "sessionization_config.json": sections["sessionization_config"], "field_priority.json": priorities(built.policy), "max_values_per_field.json": most_values(built.policy),
        "text_policy.json": TEXT_POLICY, "cutoff_policy.json": sections["cutoff_policy"], "data_quality.json": {"metrics": rates, "quarantine": letters},
        "metadata.json": {"fx_max_staleness_days": built.policy.fx_days, "preprocessing_version": built.policy.version, "preprocessing_state_sha256": built.sha256()},
        "lineage.json": {"dataset": dataset, "code": code_state()["sha256"], "sources": sorted(built.policy.contracts)},
    }
    manifest = {item: {"file": file} | ({"key": key} if key else {}) for item, (file, key) in CONTRACT.items()}
    return {n: canonical(d) for n, d in docs.items()} | {"contract.json": canonical(manifest)}
