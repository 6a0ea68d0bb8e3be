"""The default policy of the preparation plan, and the checks that a policy has to pass."""

from __future__ import annotations

import re
from dataclasses import asdict, dataclass, field, replace
from zoneinfo import ZoneInfo, ZoneInfoNotFoundError

from ..operators.fields import MISSING, Category
from ..sources.jsonl import ColumnSpec, Contract, check_registry


class PolicyError(ValueError):
    """A policy contradicts itself or the contracts."""


@dataclass(frozen=True)
class Numeric:
    """How a number is read and what range it has to be in."""

    numeric_type: str = "integer"
    locale: str = "plain"
    scale: str = "1"
    least: str | None = "0"
    most: str | None = None
    signed: bool = False


@dataclass(frozen=True)
class Field:
    """A model field: where it comes from and how it is normalised.

    ``vocabulary``: closed_set, frequency_pruned, bucket_closed_set or excluded.
    """

    source: str
    vocabulary: str = "frequency_pruned"
    domain: tuple[str, ...] | None = None
    numeric: Numeric | None = None
    fx: bool = False
    multivalue: bool = False
    ordered: bool = False
    most_values: int = 8
    computed: bool = False


@dataclass(frozen=True)
class Policy:
    """Everything that decides what the plan computes."""

    contracts: dict[str, Contract]
    zones: dict[str, str]
    codes: dict[str, dict[str, str | None]]
    event_types: tuple[str, ...]
    fingerprints: dict[str, tuple[str, ...] | None]
    sections: dict[str, dict[str, Field]]
    profile: dict[str, Field]
    aliases: dict[str, dict[str, str]]
    placeholders: tuple[str, ...]
    buckets: dict[str, tuple[str, int]]
    default_bucket: tuple[str, int] = ("quantile", 32)
    delta_buckets: int = 32
    session_source: str = "app_logs"
    session_actions: tuple[str, ...] = ("LOGIN", "screen_open", "button_click", "form_submit")
    session_starts: tuple[str, ...] = ("LOGIN",)
    session_gap_seconds: int = 1800
    base_currency: str = "KZT"
    fx_source: str = "fx_rates"
    fx_providers: tuple[str, ...] = ("NBK",)
    fx_days: int = 3
    transactions: tuple[str, ...] = ("TRANSFER", "PAYMENT", "LOAN_PAYMENT", "CARD_PURCHASE", "CASH_WITHDRAWAL")
    topup_types: tuple[str, ...] = ("TRANSFER", "PAYMENT")
    topup_direction: str = "IN"
    cutoff: str = "2026-01-31 23:59:59"
    horizon_days: int = 90
    sample_size: int = 50_000
    seed: int = 42
    client_pattern: str = r"^C[0-9]{6}$"
    version: str = "1.0.0"

    def state(self) -> dict:
        """All of it as plain data, for hashing."""
        return asdict(self)

    def at(self, **changes) -> Policy:
        return replace(self, **changes)

    def category_rules(self, fields: dict[str, Field]) -> dict[str, Category]:
        return {n: Category(self.aliases.get(n, {}), f.domain) for n, f in fields.items() if f.vocabulary in ("closed_set", "frequency_pruned")}

    def bucket_fields(self) -> dict[str, tuple[str, int]]:
        every = {n for s in [*self.sections.values(), self.profile] for n, f in s.items() if f.vocabulary == "bucket_closed_set"}
        return {n: self.buckets.get(n, self.default_bucket) for n in sorted(every)}


def _s(required: bool = True, nullable: bool = False, type: str = "string", pii: str = "none") -> ColumnSpec:
    return ColumnSpec(type, required, nullable, pii)


_REQ, _OPT, _REF = _s(), _s(False), _s(pii="pseudonymous_id")

CONTRACTS = {
    c.name: c
    for c in (
        Contract(
            "core_payments", "event", 10, ("source_record_id",),
            {"source_record_id": _REQ, "client_ref": _REF, "branch_region": _REQ, "operation_time": _REQ, "op_code": _REQ, "amount": _s(nullable=True), "currency": _REQ, "direction": _s(False, True), "counterparty_ref": _REQ, "payload_version": _s(type="integer"), "loaded_at": _REQ},
            "client_ref", "operation_time", "day_first", "loaded_at", "from_field_mapping", "branch_region", None, "payload_version", max_delay_hours=72,
        ),
        Contract(
            "card_processing", "event", 20, ("rec_id",),
            {"rec_id": _REQ, "cardholder_id": _REF, "txn_time_ms": _s(type="integer"), "op": _REQ, "schema_version": _REQ, "terminal_country": _REQ, "amount_minor": _s(False, type="integer"), "currency_code": _OPT, "merchant_category": _OPT, "mcc": _OPT, "merchant_id": _OPT, "atm_id": _OPT, "block_reason": _OPT},
            "cardholder_id", "txn_time_ms", "epoch_millis", None, "client_profile_region", None, "Asia/Almaty", None, "1.2", "schema_version", 24,
        ),
        Contract(
            "app_logs", "event", 30, ("event_uid",),
            {"event_uid": _REQ, "login_id": _REF, "device_id": _REF, "ts_local": _REQ, "action": _REQ, "app_version": _REQ, "platform": _REQ, "screen": _OPT, "template_id": _OPT},
            "login_id", "ts_local", "iso_local", None, "client_profile_region", None, "Asia/Almaty", max_delay_hours=6,
        ),
        Contract(
            "profile_snapshots", "profile", 40, ("cif", "snapshot_date"),
            {"cif": _REF, "snapshot_date": _REQ, "region": _REQ, "employment": _REQ, "account_open_date": _REQ, "salary": _REQ, "products": _s(type="string_list"), "age": _s(type="integer")},
            "cif", "snapshot_date", "date_iso", None, "source_default", None, "Asia/Almaty", max_delay_hours=168,
        ),
        Contract(
            "fx_rates", "reference", 50, ("rate_date", "currency"),
            {"rate_date": _REQ, "currency": _REQ, "rate_to_kzt": _REQ, "source": _REQ},
            None, "rate_date", "date_iso", None, "utc", max_delay_hours=24,
        ),
    )
}

_AMOUNT = Field("amount", "bucket_closed_set", numeric=Numeric("decimal", "ru_KZ", most="100000000000"), fx=True)
_MINOR = Field("amount_minor", "bucket_closed_set", numeric=Numeric("integer", "plain", "0.01", most="100000000000"), fx=True)
_CURRENCY = ("KZT", "USD", "EUR")
_COUNTRY = Field("terminal_country", "closed_set", ("KZ", "TR", "AE", "RU", "DE"))
_DEVICE = ("ANDROID", "IOS", "HUAWEI")
_PAYMENT = {"amount_base_bucket": _AMOUNT, "currency": Field("currency", "closed_set", _CURRENCY), "direction": Field("direction", "closed_set", ("IN", "OUT"))}
_CARD = Field("currency_code", "closed_set", _CURRENCY)


def _bucket(most: str, source: str = "", computed: bool = False, least: str = "0") -> Field:
    return Field(source, "bucket_closed_set", numeric=Numeric(least=least, most=most), computed=computed)


#: The fixed values of the default domain: zones, codes, fields and their domains, aliases, bucket counts.
DEFAULT = Policy(
    contracts=CONTRACTS,
    zones={"ALMATY": "Asia/Almaty", "ASTANA": "Asia/Almaty", "SHYMKENT": "Asia/Almaty", "KOSTANAY": "Asia/Qostanay", "AKTOBE": "Asia/Aqtobe", "ATYRAU": "Asia/Atyrau", "ORAL": "Asia/Oral"},
    codes={
        "core_payments": {"TRF": "TRANSFER", "PMT": "PAYMENT", "LNP": "LOAN_PAYMENT"},
        "card_processing": {"PUR": "CARD_PURCHASE", "WDR": "CASH_WITHDRAWAL", "BLK": "CARD_BLOCK"},
        "app_logs": {"push_received": "PUSH_NOTIFICATION", "LOGIN": None, "screen_open": None, "button_click": None, "form_submit": None},
    },
    event_types=("TRANSFER", "PAYMENT", "LOAN_PAYMENT", "CARD_PURCHASE", "CASH_WITHDRAWAL", "CARD_BLOCK", "APP_SESSION", "PUSH_NOTIFICATION"),
    fingerprints={
        "core_payments": ("client_id", "ts", "amount", "currency", "direction", "counterparty_ref"),
        "card_processing": ("client_id", "ts", "amount_minor", "currency_code", "merchant_id"),
        "app_logs": None, "profile_snapshots": None, "fx_rates": None,
    },
    sections={
        "TRANSFER": _PAYMENT, "PAYMENT": _PAYMENT, "LOAN_PAYMENT": _PAYMENT,
        "CARD_PURCHASE": {"amount_base_bucket": _MINOR, "currency": _CARD, "merchant_category": Field("merchant_category"), "terminal_country": _COUNTRY, "merchant_id": Field("merchant_id", "excluded")},
        "CASH_WITHDRAWAL": {"amount_base_bucket": _MINOR, "currency": _CARD, "terminal_country": _COUNTRY, "atm_id": Field("atm_id", "excluded")},
        "CARD_BLOCK": {"block_reason": Field("block_reason", "closed_set", ("CLIENT_REQUEST", "FRAUD_SUSPECTED", "EXPIRED")), "terminal_country": _COUNTRY},
        "PUSH_NOTIFICATION": {"template_id": Field("template_id"), "device_category": Field("platform", "closed_set", _DEVICE), "app_version": Field("app_version")},
        "APP_SESSION": {
            "duration_bucket": _bucket("43200", "duration_seconds"), "screens_count_bucket": _bucket("500", "screens_count"), "first_screen": Field("first_screen"), "last_screen": Field("last_screen"),
            "screens": Field("screens", multivalue=True, ordered=True), "device_category": Field("platform", "closed_set", _DEVICE), "app_version": Field("app_version"),
        },
    },
    profile={
        "region": Field("region", "closed_set", ("ALMATY", "ASTANA", "SHYMKENT", "KOSTANAY", "AKTOBE", "ATYRAU", "ORAL")),
        "employment": Field("employment", "closed_set", ("EMPLOYED", "SELF_EMPLOYED", "STUDENT", "RETIRED", "UNEMPLOYED")),
        "salary_bucket": _bucket("1000000000", "salary"), "age_bucket": _bucket("120", "age", least="14"), "products": Field("products", multivalue=True),
        "account_age_bucket": _bucket("40000", computed=True), "first_seen_age_bucket": _bucket("40000", computed=True), "first_topup_age_bucket": _bucket("40000", computed=True),
        "lifetime_event_count_bucket": _bucket("1000000", computed=True), "lifetime_transaction_count_bucket": _bucket("1000000", computed=True), "lifetime_product_count_bucket": _bucket("100", computed=True),
    },
    aliases={"currency": {"ТЕНГЕ": "KZT", "TENGE": "KZT", "398": "KZT", "ДОЛЛАР": "USD", "DOLLAR": "USD", "840": "USD", "ЕВРО": "EUR", "EURO": "EUR", "978": "EUR"}, "direction": {"ВХОДЯЩИЙ": "IN", "ИСХОДЯЩИЙ": "OUT"}},
    placeholders=("N/A", "n/a", "-", "--", "НЕТ ДАННЫХ", "нет данных"),
    buckets={"amount_base_bucket": ("quantile", 64), "age_bucket": ("equal_width", 16)},
)


#: Profile fields that are computed from all events of a client (fixed values).
LIFE_LONG = {"account_age_bucket", "first_seen_age_bucket", "first_topup_age_bucket", "lifetime_event_count_bucket", "lifetime_transaction_count_bucket", "lifetime_product_count_bucket"}


def check(p: Policy) -> Policy:
    """Raise ``PolicyError`` on the first contradiction; else return the policy."""

    def need(ok: bool, why: str) -> None:
        if not ok:
            raise PolicyError(why)

    check_registry(p.contracts)
    for z in [*p.zones.values(), *(c.default_zone for c in p.contracts.values() if c.default_zone)]:
        try:
            ZoneInfo(z)
        except (ZoneInfoNotFoundError, ValueError) as e:
            raise PolicyError(f"{z} is not an IANA zone") from e
    need(set(p.fingerprints) == set(p.contracts), "fingerprints are declared for exactly the registered sources")
    for source, fp in p.fingerprints.items():
        if fp is None:
            continue
        contract = p.contracts[source]
        need(len(set(fp)) == len(fp) >= 2, f"{source}: a fingerprint has at least two distinct fields")
        for f in fp:
            need(f in contract.columns or f in ("client_id", "ts"), f"{source}: fingerprint field {f} is not declared")
            need(f not in contract.columns or contract.columns[f].type != "string_list", f"{source}: a list cannot be in a fingerprint")
        need("client_id" not in fp or contract.client_field is not None, f"{source} has no client")
    events = {n for n, c in p.contracts.items() if c.kind == "event"}
    need(set(p.codes) == events, "codes are declared for exactly the event sources")
    targets = {t for codes in p.codes.values() for t in codes.values() if t}
    need(targets <= set(p.event_types), f"unapproved event types {sorted(targets - set(p.event_types))}")
    need(p.session_source in events and "APP_SESSION" in p.event_types, "sessions need an event source and an approved type")
    actions = {c for c, t in p.codes[p.session_source].items() if t is None}
    need(set(p.session_starts) <= actions, "a session starts with one of its actions")
    lost, promoted = set(p.session_actions) - set(p.codes[p.session_source]), {c for c in p.session_actions if p.codes[p.session_source].get(c)}
    need(not lost, f"actions without a code: {sorted(lost)}")
    need(not promoted, f"actions that are events of their own: {sorted(promoted)}")
    need(set(p.session_actions) == actions, f"codes without a type that are no actions: {sorted(actions - set(p.session_actions))}")
    need(all(t for n, codes in p.codes.items() if n != p.session_source for t in codes.values()), "only session actions have no event type")
    need(p.session_gap_seconds > 0, "a session's gap is positive")
    need(set(p.sections) == set(p.event_types), "there is a section for exactly the approved event types")
    shared: dict[str, tuple] = {}
    for section, fields in [*p.sections.items(), ("PROFILE", p.profile)]:
        for n, f in fields.items():
            need(n not in ("event_type", "delta_from_previous_event"), f"{n} is a reserved name")
            need((f.vocabulary == "bucket_closed_set") == (f.numeric is not None), f"{section}.{n}: buckets, and only they, are numeric")
            need((f.vocabulary == "closed_set") == (f.domain is not None), f"{section}.{n}: a closed set, and only it, has a domain")
            need(f.domain is None or (len(set(f.domain)) == len(f.domain) and all(x.strip() and x != MISSING for x in f.domain)), f"{section}.{n}: a domain has distinct values, none blank")
            need(not f.ordered or f.multivalue, f"{section}.{n}: only lists are ordered")
            need(not f.fx or "currency" in fields, f"{section}.{n}: an amount needs a currency")
            if f.numeric:
                need(float(f.numeric.scale) > 0, f"{section}.{n}: a scale is positive")
                need(f.numeric.least is None or f.numeric.most is None or float(f.numeric.least) <= float(f.numeric.most), f"{section}.{n}: an empty range")
                need(f.numeric.signed or f.numeric.least is None or float(f.numeric.least) >= 0, f"{section}.{n}: an unsigned field has no negative minimum")
            kind = (f.vocabulary, f.domain, f.multivalue)
            need(shared.setdefault(n, kind) == kind, f"{n} is defined in two ways")
    for n, table in p.aliases.items():
        known = [f for s in [*p.sections.values(), p.profile] for m, f in s.items() if m == n]
        need(bool(known), f"aliases of an unknown field {n}")
        need(not set(table) & set(table.values()), f"{n}: an alias of an alias")
        need(all(f.domain is None or set(table.values()) <= set(f.domain) for f in known), f"{n}: an alias outside the domain")
    home = next((c for c in p.contracts.values() if c.kind == "profile"), None)
    need(home is not None, "there is a profile source")
    made = {"duration_seconds", "screens_count", "first_screen", "last_screen", "screens"}
    known = {c for n in events for c in p.contracts[n].columns} | made
    for section, fields in p.sections.items():
        for n, f in fields.items():
            need(f.computed or f.source in known, f"{section}.{n}: no event source has a column {f.source}")
    for n, f in p.profile.items():
        need(f.computed or f.source in home.columns, f"PROFILE.{n}: the profile source has no column {f.source}")
    need({n for n, f in p.profile.items() if f.computed} == LIFE_LONG, "the six life-long fields of the profile, and only they, are computed")
    need(bool(re.fullmatch(r"\d+\.\d+\.\d+", p.version)), "a policy has a version of three numbers")
    need(p.sample_size > 0 and p.fx_days >= 0 and p.horizon_days >= 0 and p.delta_buckets >= 2, "sizes and days of the run are in their ranges")
    need(set(p.buckets) <= set(p.bucket_fields()), "buckets of a field that is none")
    need(all(m in ("quantile", "equal_width") and k >= 2 for m, k in [*p.buckets.values(), p.default_bucket]), "a field has at least two buckets, by quantiles or equal width")
    need(p.fx_source in p.contracts and bool(p.fx_providers), "rates need a source and an approved provider")
    need(set(p.transactions) | set(p.topup_types) <= set(p.event_types), "the profile counts approved event types")
    need(bool(re.fullmatch(r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d", p.cutoff)), "the cutoff is a UTC instant, yyyy-mm-dd hh:mm:ss")
    for c in p.contracts.values():
        direct = {n for n, s in c.columns.items() if s.pii == "direct_identifier"}
        used = {f.source for s in [*p.sections.values(), p.profile] for f in s.values()}
        need(not direct & used, f"{c.name}: a direct identifier cannot reach the model")
    return p
