"""The preparation plan: raw JSON lines to frozen artifacts (build) and to a prepared timeline and profiles (encode)."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashing, numbers, times
from ..operators import buckets, checks, dedup, fields, fx, identity, profiles, sessions, timeline, timestamps
from ..sources import jsonl, storage
from . import metrics
from .config import DEFAULT, Field, Policy, PolicyError, check


class StateMismatch(RuntimeError):
    """The policy is not the one that the artifacts were built with."""


def canonical(doc) -> bytes:
    """A document as bytes: keys sorted, no white space, UTF-8, decimals as text."""
    return json.dumps(doc, sort_keys=True, ensure_ascii=False, separators=(",", ":"), default=lambda x: format(x, "f") if isinstance(x, Decimal) else str(x)).encode()


@dataclass(frozen=True)
class Identity:
    """The identity dictionary as a table ``section, ref, client_id`` (a section is source.field), named by its content."""

    table: DataFrame
    sections: tuple[str, ...]
    sha256: str
    rows: int

    def document(self) -> dict:
        return {"sections": list(self.sections), "rows": self.rows, "sha256": self.sha256}


def _pairs_of(path: str, spark: SparkSession) -> DataFrame:
    """``section, ref, client_id`` of a dictionary: JSON lines with these keys in a folder, or one document section -> ref -> client.

    A document is read by a task and not by the driver; repeated keys stay repeated rows. Large dictionaries come as lines.
    """
    schema = "section string, ref string, client_id string"
    if storage.exists(spark, path):
        return spark.read.schema(schema).json(path)

    def run(batches):
        import json

        import pyarrow as pa

        for b in batches:
            for text in b.column(0).to_pylist():
                rows = [(name, *pair) for name, section in json.loads(text, object_pairs_hook=list) for pair in section or [(None, None)]]
                for at in range(0, len(rows), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows[at : at + 100_000])], names=["section", "ref", "client_id"])

    return spark.read.text(f"{path}.json", wholetext=True).mapInArrow(run, schema)


def read_identity(spark: SparkSession, path: str, policy: Policy) -> Identity:
    """The dictionary at ``path`` (a folder of JSON lines) or ``path``.json. Repeated keys, clients or bad ids are errors, found by aggregation."""
    every = storage.stored(_pairs_of(path, spark))
    table = every.where("ref is not null or client_id is not null")
    wrong = F.count_if(F.coalesce(F.col("ref"), F.lit("")) == "") + F.count_if(~F.coalesce(F.col("client_id"), F.lit("")).rlike(policy.client_pattern))
    real = F.col("ref").isNotNull() | F.col("client_id").isNotNull()
    told = every.groupBy("section").agg(F.count_if(real).alias("n"), F.count_distinct("ref").alias("refs"), F.count_distinct("client_id").alias("clients"), (wrong - F.count_if(~real) * 2).alias("wrong"))
    found = told.limit(10_000).collect()  # a row a section
    have = tuple(sorted(r["section"] for r in found))
    want = {f"{c.name}.{c.client_field}" for c in policy.contracts.values() if c.client_field}
    if set(have) != want:
        raise PolicyError(f"the identity dictionary has sections {list(have)}, not {sorted(want)}")
    for bad, why in ((any(r["wrong"] for r in found), "an empty reference or a malformed client id"), (any(r["refs"] < r["n"] for r in found), "a key of the identity dictionary repeats"), (any(r["clients"] < r["n"] for r in found), "a client has two references")):
        if bad:
            raise PolicyError(why)
    return identified(table, have)


def identified(table: DataFrame, sections: tuple[str, ...]) -> Identity:
    """A dictionary with the digest of its rows, which no order or partitioning changes."""
    return Identity(table, sections, *hashing.table_digest(table.select("section", "ref", "client_id")))


@dataclass(frozen=True)
class Prepared:
    """What the chain yields before buckets: numeric fields are exact decimals, null is missing."""

    events: DataFrame
    profiles: DataFrame
    rejects: DataFrame
    tallies: metrics.Tallies
    steps: dict[str, dict[str, DataFrame]] = field(default_factory=dict)


@dataclass(frozen=True)
class Artifacts:
    """Frozen state: policy, identity, edges; its hash names the build."""

    policy: Policy
    identity: Identity | dict[str, dict[str, str]]
    edges: dict[str, buckets.Edges]
    delta: buckets.Edges
    extra: dict = field(default_factory=dict)

    def document(self) -> dict:
        """The state in its 22 sections."""
        from .documents import state

        return state(self)

    def sha256(self) -> str:
        return hashlib.sha256(canonical(self.document())).hexdigest()


def _dictionary_frame(spark: SparkSession, table: Identity | dict[str, dict[str, str]]) -> DataFrame:
    """``source, ref, client_id``; a small dictionary may be given as it is."""
    if isinstance(table, Identity):
        return table.table.select(F.substring_index("section", ".", 1).alias("source"), "ref", "client_id")
    rows = [(name.split(".")[0], ref, client) for name, section in table.items() for ref, client in section.items()]
    return spark.createDataFrame(rows, "source string, ref string, client_id string")


def prepare(spark: SparkSession, root: str, policy: Policy, dictionary: Identity | dict[str, dict[str, str]]) -> Prepared:
    """Read, check, resolve, time, cut, deduplicate, type, sessionize, project and normalise all sources under ``root``."""
    jsonl.check_layout(spark, root, policy.contracts)
    ids = _dictionary_frame(spark, dictionary)
    rejected: list[DataFrame] = []
    tallies = metrics.Tallies(spark)

    def out(bad: DataFrame, source: str) -> None:
        detail = F.array_join("details", ",") if "details" in bad.columns else F.lit(None).cast("string")
        rejected.append(bad.withColumn("source_name", F.lit(source)).select(F.col("source_name").alias("source"), "source_record_id", "partition", "line_number", "reason", detail.alias("detail")))

    steps: dict[str, dict[str, DataFrame]] = {}
    identified: dict[str, DataFrame] = {}
    # each source is read and checked once; all that follows starts from these tables
    sources = storage.together({n: lambda n=n, c=c: storage.stored(jsonl.checked(jsonl.read_lines(spark, root, n), c)) for n, c in policy.contracts.items()})
    for name, c in policy.contracts.items():
        checked = sources[name]
        tallies.rows(checked, name)
        steps[name] = {"read": checked}
        good, bad = jsonl.divided(checked)
        out(bad, name)
        # a contract's own column may be called source, as the plan's is: the declared one is kept under another name
        if c.client_field:
            good, bad = identity.resolve_identity(good, ids, "source", c.client_field)
            out(bad, name)
        identified[name] = good
    profile_source = next(n for n, c in policy.contracts.items() if c.kind == "profile")
    snaps = identified[profile_source]
    home = policy.contracts[profile_source]
    zones = timestamps.client_zones(snaps.withColumn("at", times.from_date(F.col(home.time_field))), policy.cutoff, policy.zones, home.default_zone, ["partition", "line_number"], "at")
    zones = storage.stored(zones)

    timed: dict[str, DataFrame] = {}
    for name, c in policy.contracts.items():
        kw: dict = {"cutoff": policy.cutoff, "horizon_days": policy.horizon_days, "max_delay_hours": c.max_delay_hours}
        if c.processing_field:
            kw["processed"] = times.from_iso_utc(F.col(c.processing_field))
        if c.zone_policy == "from_field_mapping":
            kw |= {"zone": timestamps.zone_of(F.col(c.zone_field), policy.zones), "zone_is_given": True}
        elif c.zone_policy == "client_profile_region":
            kw |= {"client_zones": zones, "default_zone": c.default_zone}
        else:
            kw["default_zone"] = c.default_zone or "UTC"
        good, bad = timestamps.normalize(identified[name], c.time_field, c.time_kind, **kw)
        out(bad, name)
        tallies.times(identified[name], good, name)
        steps[name]["timed"] = good
        good = timestamps.up_to(good, policy.cutoff).withColumn("source_priority", F.lit(c.priority))
        steps[name]["within"] = good
        tallies.copies(good, name)
        good, bad = dedup.exact(good, ["source_record_id"], jsonl.signature(c), ["partition", "line_number"], c.version_field)
        out(bad, name)
        steps[name]["single"] = good
        if policy.fingerprints[name]:
            good = dedup.business(good.withColumn("source", F.lit(name)), list(policy.fingerprints[name]))
        timed[name] = good
    timed = storage.together({n: lambda d=d: storage.stored(d) for n, d in timed.items()})
    for name, d in timed.items():
        steps[name]["facts"] = d

    base = ["client_id", "source", "source_record_id", "source_priority", "ts", "calendar_zone", "zone_fallback", "is_late", "event_type"]
    typed: list[DataFrame] = []
    for name, codes in policy.codes.items():
        code = {"core_payments": "op_code", "card_processing": "op", "app_logs": "action"}.get(name) or next(x for x in policy.contracts[name].columns if "code" in x)
        good, bad = identity.map_events(timed[name], codes, code)
        out(bad, name)
        tallies.mapped(timed[name])
        if name == policy.session_source:
            acts = good.where("event_type is null")
            s = sessions.sessionize(acts, list(policy.session_starts), policy.session_gap_seconds, action=code, carry=["platform", "app_version", "calendar_zone", "zone_fallback", "is_late", "source", "source_priority"])
            tallies.sessions(s, policy)
            typed.append(s.withColumn("event_type", F.lit("APP_SESSION")))
        typed.append(good.where("event_type is not null"))

    wide: DataFrame | None = None
    names = list(dict.fromkeys(n for s in policy.sections.values() for n in s))
    for section, model in policy.sections.items():
        for rows in typed:
            sources = {f.source for f in model.values()}
            if section == "APP_SESSION" and "screens_count" not in rows.columns or section != "APP_SESSION" and ("screens_count" in rows.columns or not sources & set(rows.columns)):
                continue
            own = rows.where(F.col("event_type") == section)
            flat = _normalised(own, model, policy, base)
            wide = flat if wide is None else wide.unionByName(flat, allowMissingColumns=True)
    rates = timed[policy.fx_source].withColumnsRenamed({"source_record_id": "rid"})
    value, _ = numbers.parsed(F.col("rate_to_kzt"), "plain")
    # the provider column shares its name with the plan's source column: it is read from the payload again
    rt = fx.rate_table(rates.withColumns({"rate": value.cast("decimal(12,4)"), "provider": F.get_json_object("payload", "$.source")}), list(policy.fx_providers), order=["ts", "rid"])
    rt = storage.stored(rt)
    wide = fx.convert(wide, rt, policy.base_currency, amount="amount_base_bucket", days=policy.fx_days).withColumn("amount_base_bucket", F.col("amount_base")).drop("amount_base")
    for n in names:
        if n not in wide.columns:
            wide = wide.withColumn(n, F.lit(None).cast("string"))
    excluded = sorted({n for s in policy.sections.values() for n, f in s.items() if f.vocabulary == "excluded"})
    lists = {n: (f.ordered, f.most_values) for s in policy.sections.values() for n, f in s.items() if f.multivalue}
    wide = fields.apply_policies(wide, excluded, lists)
    wide = wide.withColumn("event_id", hashing.event_id(F.col("source"), F.col("source_record_id"), F.col("event_type"), F.col("ts")))
    wide = storage.stored(wide)
    prof = storage.stored(_profiles(timed[profile_source], wide, policy))
    rejects = rejected[0]
    for r in rejected[1:]:
        rejects = rejects.unionByName(r)
    return Prepared(wide, prof, rejects, tallies, steps)


def _normalised(rows: DataFrame, model: dict[str, Field], policy: Policy, keep: list[str]) -> DataFrame:
    flat = fields.project(rows, {n: f.source for n, f in model.items() if not f.computed}, list(policy.placeholders), keep)
    flat = fields.categories(flat, policy.category_rules(model))
    for n, f in model.items():
        if f.numeric and not f.computed:
            r = f.numeric
            flat = fields.numeric(flat, n, numeric_type=r.numeric_type, locale=r.locale, scale=r.scale, signed=r.signed, least=r.least, most=r.most)
    return flat


def _in_range(c: Column, f: Field) -> Column:
    value = c.cast("decimal(30,8)")
    return F.when((value >= F.lit(f.numeric.least).cast("decimal(30,8)")) & (value <= F.lit(f.numeric.most).cast("decimal(30,8)")), value)


def _profiles(snaps: DataFrame, events: DataFrame, policy: Policy) -> DataFrame:
    model = policy.profile
    rows = _normalised(snaps, model, policy, ["client_id", "ts", "source_record_id", "partition", "line_number", "account_open_date", F.size("products").alias("n_products")])
    rows = rows.withColumn("raw_reference", F.concat("partition", F.lit("#"), F.col("line_number").cast("string"), F.lit(":"), "source_record_id"))
    columns = [c for c in rows.columns if c not in ("client_id", "ts", "partition", "line_number", "source_record_id")]
    topup = F.col("event_type").isin(list(policy.topup_types)) & (F.col("direction") == policy.topup_direction)
    p = profiles.build(rows.select("client_id", "ts", "source_record_id", *columns), events, policy.cutoff, ["ts", "source_record_id"], columns, list(policy.transactions), topup)
    opened = F.datediff(F.lit(policy.cutoff).cast("date"), times.from_date(F.col("account_open_date")).cast("date"))
    raw = {
        "account_age_bucket": opened, "first_seen_age_bucket": F.col("first_seen_days"), "first_topup_age_bucket": F.col("first_topup_days"),
        "lifetime_event_count_bucket": F.col("event_count"), "lifetime_transaction_count_bucket": F.col("transaction_count"), "lifetime_product_count_bucket": F.col("n_products"),
    }
    p = p.withColumns({n: _in_range(c, model[n]) for n, c in raw.items()})
    p = fields.apply_policies(p, [], {n: (f.ordered, f.most_values) for n, f in model.items() if f.multivalue})
    return p.select("client_id", "profile_ts", "profile_missing", "raw_reference", *model, *[c for c in p.columns if c.endswith("__reason")])


def _values(prepared: Prepared, policy: Policy) -> DataFrame:
    """``field, key, value`` of every numeric value that buckets are fitted on."""
    out = None
    every = policy.bucket_fields()
    for df, key, names in ((prepared.events, "event_id", [n for n in every if n not in policy.profile]), (prepared.profiles, "raw_reference", [n for n in every if n in policy.profile])):
        pairs = F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).cast("decimal(38,8)").alias("value")) for n in names])
        part = df.select(F.coalesce(F.col(key), F.col("client_id")).alias("key"), F.explode(pairs).alias("p")).select("p.field", "key", "p.value").where("value is not null")
        out = part if out is None else out.unionByName(part)
    return out


def build(spark: SparkSession, root: str, policy: Policy = DEFAULT) -> Artifacts:
    """Fit edges on a training set and freeze them with the policy. ``root/_meta`` has the manifest and the identity dictionary."""
    manifest = json.loads(spark.read.text(f"{root}/_meta/manifest.json", wholetext=True).first()[0])
    if manifest.get("dataset_role") != "train":
        raise PolicyError("artifacts are built from a training set only")
    return fit(spark, root, policy)


def fit(spark: SparkSession, root: str, policy: Policy) -> Artifacts:
    check(policy)
    dictionary = read_identity(spark, f"{root}/_meta/identity_mapping", policy)
    p = prepare(spark, root, policy, dictionary)
    d = timeline.deltas(timeline.order_timeline(p.events)).select(F.lit("delta").alias("field"), F.col("event_id").alias("key"), F.col("delta_seconds").cast("decimal(38,8)").alias("value"))
    made = storage.together({
        "fields": lambda: buckets.fit(_values(p, policy), policy.bucket_fields(), policy.sample_size, policy.seed),
        "delta": lambda: buckets.fit(d, {"delta": ("quantile", policy.delta_buckets)}, policy.sample_size, policy.seed)["delta"],
    })
    return Artifacts(policy, dictionary, made["fields"], made["delta"])


@dataclass(frozen=True)
class Encoded:
    """Prepared outputs, the dead letters and the metrics."""

    events: DataFrame
    profiles: DataFrame
    quarantine: DataFrame
    metrics: DataFrame


def encode(spark: SparkSession, root: str, artifacts: Artifacts, expected_sha256: str | None = None) -> Encoded:
    """Apply frozen artifacts to a data set. Refuses when their hash is not the expected one, and when the output breaks its contract."""
    if expected_sha256 is not None and artifacts.sha256() != expected_sha256:
        raise StateMismatch("the state differs from the one the artifacts were built with")
    policy = check(artifacts.policy)
    p = prepare(spark, root, policy, artifacts.identity)
    # read by the contract's checks, the outputs and the report: each is made once
    ordered = timeline.calendar(timeline.order_timeline(_bucketed(p.events, artifacts)))
    made = storage.together({"rejects": lambda: storage.stored(p.rejects), "events": lambda: storage.stored(ordered)})
    rejects, events = made["rejects"], made["events"]
    labels = _bucketed(p.profiles, artifacts)
    checks.require(contract(events, labels, artifacts))
    lists = {n for s in [*policy.sections.values(), policy.profile] for n, f in s.items() if f.multivalue}
    sections = {t: [n for n, f in model.items() if f.vocabulary != "excluded"] for t, model in policy.sections.items()}
    shown = F.lit(None).cast("string")
    for t, names in sections.items():
        shown = F.when(F.col("event_type") == t, _document(sorted(names), lists)).otherwise(shown)
    out = events.select("client_id", "event_id", "event_type", "ts", "calendar_zone", "ordering_key", "position", shown.alias("fields"), "hour_of_day_local", "day_of_week_local", "lifetime_first")
    prof = labels.select("client_id", F.col("profile_ts"), _document(sorted(policy.profile), lists).alias("fields"))
    letters = checks.quarantine(rejects, ["partition", "line_number"], "detail")
    p.tallies.prepared(p.events, p.profiles, rejects, policy)
    p.tallies.bucketed(p.events, p.profiles, artifacts.edges)
    p.tallies.labelled(events, labels, artifacts.edges)
    return Encoded(out, prof, letters, storage.stored(p.tallies.report().coalesce(1)))


def declared(artifacts: Artifacts) -> tuple[dict[str, dict[str, checks.Declared]], dict[str, dict[str, checks.Declared]]]:
    """What the output may hold, by event type and for profiles: every field with its domain."""

    def of(n: str, f: Field) -> checks.Declared:
        bucket = f.vocabulary == "bucket_closed_set"
        return checks.Declared(tuple(artifacts.edges[n].domain()) if bucket else f.domain, bucket, f.multivalue)

    kept = lambda model: {n: of(n, f) for n, f in model.items() if f.vocabulary != "excluded"}
    return {t: kept(model) for t, model in artifacts.policy.sections.items()}, {"PROFILE": kept(artifacts.policy.profile)}


def contract(events: DataFrame, profiles_: DataFrame, artifacts: Artifacts) -> DataFrame:
    """``check, violations`` of all post-conditions of prepared events and profiles."""
    policy = artifacts.policy
    sections, profile = declared(artifacts)
    excluded = sorted({n for s in policy.sections.values() for n, f in s.items() if f.vocabulary == "excluded"})
    out = checks.violations(events, policy.cutoff, {"event_type": list(policy.event_types)})
    out = out.unionByName(checks.field_violations(events, sections, excluded))
    return out.unionByName(checks.profile_violations(profiles_, policy.cutoff)).unionByName(checks.field_violations(profiles_, profile, [], None))


def _document(names: list[str], lists: set[str]) -> Column:
    """A JSON object of the fields: a text each, or a list of texts; MISSING, as a text, where there is none."""
    parts = []
    for n in names:
        if n in lists:
            shown = F.when(F.col(n).isNull(), F.lit('"MISSING"')).otherwise(F.to_json(F.col(n)))
        else:
            shown = F.regexp_replace(F.to_json(F.array(fields.rendered(F.col(n)))), r"^\[|\]$", "")
        parts.append(F.concat(F.lit(f'"{n}":'), shown))
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _bucketed(df: DataFrame, artifacts: Artifacts) -> DataFrame:
    return df.withColumns({n: e.column(F.col(n).cast("decimal(38,8)")) for n, e in artifacts.edges.items() if n in df.columns})
