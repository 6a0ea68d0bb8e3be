"""A small raw data set with the edge cases that the preparation plan has to get right."""

from __future__ import annotations

import json
from pathlib import Path


def _payment(i, when, **kw):
    return {"source_record_id": i, "client_ref": "000000", "branch_region": "ALMATY", "operation_time": when, "op_code": "TRF", "amount": "100,50", "currency": "KZT", "direction": "IN", "counterparty_ref": "KZ1", "payload_version": 1, "loaded_at": "2026-01-20T10:00:00Z"} | kw


def _card(i, ms, **kw):
    return {"rec_id": i, "cardholder_id": "CH0", "txn_time_ms": ms, "op": "PUR", "schema_version": "1.2", "terminal_country": "KZ", "amount_minor": 798122, "currency_code": "398", "merchant_category": "GROCERY", "merchant_id": "M1"} | kw


def _action(i, when, action="screen_open", **kw):
    return {"event_uid": i, "login_id": "L0", "device_id": "D", "ts_local": when, "action": action, "app_version": "6.0", "platform": "ios"} | kw


def _snapshot(cif, date, **kw):
    return {"cif": cif, "snapshot_date": date, "region": "ALMATY", "employment": "EMPLOYED", "account_open_date": "2020-01-31", "salary": "300000", "products": ["card"], "age": 30} | kw


NOON = 1_768_903_200_000  # 2026-01-20T10:00:00Z


def raw() -> dict[str, list]:
    return {
        "core_payments": [
            _payment("P1", "20.01.2026 15:00"),
            _payment("P2", "20.01.2026 15:00", amount=None, currency="", direction="N/A"),
            {k: v for k, v in _payment("P3", "20.01.2026 15:01").items() if k != "direction"},
            _payment("P4", "20.01.2026 15:02", amount="NaN"),
            _payment("P5", "20.01.2026 15:03", op_code="XYZ"),
            _payment("P6", "20.01.2028 15:03"),
            _payment("P7", "20.01.2026 15:04"),
            _payment("P7", "20.01.2026 15:04"),
            _payment("P8-b", "20.01.2026 15:05", counterparty_ref="KZ8"),
            _payment("P8-a", "20.01.2026 15:05", counterparty_ref="KZ8"),
            _payment("P9", "20.01.2026 15:06", amount="1,00"),
            _payment("P9", "20.01.2026 15:06", amount="2,00", payload_version=2),
            _payment("P10", "20.01.2026 15:07", amount="10,00", currency="USD"),
            _payment("P11", "25.01.2026 15:07", amount="10,00", currency="USD"),
            _payment("P12", "01.02.2026 04:59"),
            _payment("P13", "01.02.2026 05:00"),
            _payment("P14", "20.01.2026 15:08", client_ref="999"),
            _payment("P15", "20.01.2026 15:09", branch_region="MARS"),
            _payment("P16", "20.01.2026 15:10", payload_version=True),
            _payment("P17", "20.01.2026 15:11", extra=1),
            _payment(" ", "20.01.2026 15:12"),
            "not json",
            _payment("P18", "20.01.2026 15:13", currency="евро"),
        ],
        "card_processing": [
            _card("R1", NOON),
            _card("R2", NOON, schema_version="1.1"),
            _card("R3", NOON, op="BLK", block_reason="expired", amount_minor=None) | {},
            {k: v for k, v in _card("R4", NOON + 1, op="BLK", block_reason="expired").items() if k not in ("amount_minor", "currency_code", "merchant_category", "merchant_id")},
            _card("R5", NOON + 2, cardholder_id="CH1", amount_minor=-5),
        ],
        "app_logs": [
            _action("A1", "2026-01-20T15:00:00", "LOGIN"),
            _action("A2", "2026-01-20T15:00:10", screen="home"),
            _action("A3", "2026-01-20T15:30:10", screen="cards"),
            _action("A4", "2026-01-20T16:00:11", screen="home"),
            _action("A5", "2026-02-01T04:59:59", screen="home"),
            _action("A6", "2026-02-01T05:00:10", screen="cards"),
            _action("A7", "2026-01-20T17:00:00", "push_received", template_id="hello"),
        ],
        "profile_snapshots": [
            _snapshot("F0", "2025-12-01", region="ATYRAU"),
            _snapshot("F0", "2026-02-01", products=[f"p{i:02}" for i in range(11, 0, -1)], age=-1),
            _snapshot("F2", "2026-01-01"),
        ],
        "fx_rates": [
            {"rate_date": "2026-01-18", "currency": "USD", "rate_to_kzt": "450.5", "source": "NBK"},
            {"rate_date": "2026-01-20", "currency": "USD", "rate_to_kzt": "1", "source": "OTHER"},
        ],
    }


IDS = {
    "core_payments.client_ref": {"000000": "C000000"},
    "card_processing.cardholder_id": {"CH0": "C000000", "CH1": "C000001"},
    "app_logs.login_id": {"L0": "C000000"},
    "profile_snapshots.cif": {"F0": "C000000", "F2": "C000002"},
}


def write(root: Path, role: str = "train", rows: dict[str, list] | None = None) -> str:
    """Write the data set; each source in two files."""
    for source, items in (rows or raw()).items():
        d = root / source
        d.mkdir(parents=True, exist_ok=True)
        half = (len(items) + 1) // 2
        for name, part in (("2026-01-01.jsonl", items[:half]), ("2026-02-01.jsonl", items[half:])):
            (d / name).write_text("".join((x if isinstance(x, str) else json.dumps(x, ensure_ascii=False)) + "\n" for x in part) + "\n", encoding="utf-8")
    meta = root / "_meta"
    meta.mkdir(parents=True, exist_ok=True)
    (meta / "manifest.json").write_text(json.dumps({"dataset_name": "t", "dataset_role": role}))
    (meta / "identity_mapping.json").write_text(json.dumps(IDS))
    return f"file://{root}"
