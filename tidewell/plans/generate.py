"""Raw data sets with known edge cases, made by rule and hash; never by chance.

``dataset`` gives the five sources of the default policy for any number of
clients: background records from ranges, spread by hashes of their number, and
one or more injected records for each edge case. ``write`` lays them out as
JSON lines with manifest, identity dictionary and a list of the cases.
``payments`` makes faulty payment records from a table of events.
"""

from __future__ import annotations

import json
import uuid
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import storage

START, DAYS, CUTOFF = date(2023, 9, 1), 912, datetime(2026, 1, 31, 23, 59, 59)
REGIONS = ["ALMATY", "ASTANA", "SHYMKENT", "KOSTANAY", "AKTOBE", "ATYRAU", "ORAL"]
CURRENCIES = ["KZT", "kzt", "тенге", "398", "USD", "840", "EUR", "евро", "978"]
SCREENS = ["HOME", "CARDS", "TRANSFERS", "PAYMENTS", "HISTORY", "SETTINGS", "OFFERS", "PROFILE", "MAP", "CHAT"]
#: Records a client of each source, beside snapshots (one a month) and rates (one a working day and currency).
PER_CLIENT = {"core_payments": 40, "card_processing": 70, "sessions": 25, "actions": 8, "pushes": 30}
#: Clients with a role: a long history, one event, no profile, no events.
LONG, SINGLE, NO_PROFILE, NO_EVENTS, FIRST = 0, 1, 2, 3, 4
#: Days without any rate.
GAP = (date(2025, 7, 7), 8)
#: Cases by the operator that each is there to try.
TRIED = {
    "contract": ("key_left_out", "null_given", "blank_text", "dash_or_na"),
    "identity": ("client_unprofiled", "client_silent"),
    "timestamps": ("local_clock", "old_zone_rule"),
    "cutoff": ("on_the_cutoff", "past_the_cutoff", "years_ahead"),
    "dedup": ("sent_twice", "same_fact", "two_versions"),
    "events": ("code_unknown",),
    "sessions": ("session_cut_off",),
    "numbers": ("no_number", "nan_text", "infinite_text", "age_below_zero"),
    "fx": ("foreign_money", "rate_of_friday", "rate_too_old"),
    "categories": ("seldom_seen", "never_trained", "list_too_long"),
    "buckets": ("below_training", "above_training"),
    "timeline": ("many_events", "only_event", "tie_within_source", "tie_between_sources"),
}
CASES = tuple(c for cases in TRIED.values() for c in cases)


def draw(salt: str, n: int, *key: Column) -> Column:
    """A number below ``n``, by a hash of the key."""
    return F.pmod(F.xxhash64(F.lit(salt), *key), F.lit(n))


def pick(salt: str, values: list[str], *key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (draw(salt, len(values), *key) + 1).cast("int"))


def _moment(salt: str, *key: Column) -> Column:
    return F.timestamp_add("SECOND", draw(salt, DAYS * 86_400, *key).cast("int"), F.lit(f"{START} 00:00:00").cast("timestamp_ntz"))


def _rows(spark: SparkSession, clients: int, each: int, scale: float) -> DataFrame:
    """``client, n``: background records of every client but those without events, ten times as many of the one with a long history."""
    each = max(1, int(each * scale))
    many = spark.range((clients - FIRST) * each).select((F.col("id") % (clients - FIRST) + FIRST).alias("client"), F.floor(F.col("id") / (clients - FIRST)).alias("n"))
    return many.unionByName(spark.range(10 * each).select(F.lit(LONG).cast("long").alias("client"), F.col("id").alias("n"))).unionByName(spark.range(each).select(F.lit(NO_PROFILE).cast("long").alias("client"), F.col("id").alias("n")))


def _ref(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(c.cast("string"), 6, "0"))


def region_of(client: Column) -> Column:
    return pick("region", REGIONS, client)


def _payments(spark, clients, scale) -> DataFrame:
    c, n = F.col("client"), F.col("n")
    when = _moment("pay", c, n)
    tenths = draw("amount", 900_000, c, n) + 100
    whole = F.replace(F.format_number((tenths / 100).cast("long"), 0), F.lit(","), F.lit(" "))
    return _rows(spark, clients, PER_CLIENT["core_payments"], scale).select(
        F.concat(F.lit("CP-"), F.lpad(c.cast("string"), 6, "0"), F.lit("-"), F.lpad(n.cast("string"), 5, "0")).alias("source_record_id"), _ref("", c).alias("client_ref"), region_of(c).alias("branch_region"),
        F.date_format(when, "dd.MM.yyyy HH:mm").alias("operation_time"), pick("op", ["TRF", "PMT", "LNP"], c, n).alias("op_code"), F.concat(whole, F.lit(","), F.lpad((tenths % 100).cast("string"), 2, "0")).alias("amount"),
        pick("cur", ["KZT", "KZT", "KZT", *CURRENCIES], c, n).alias("currency"), pick("dir", ["IN", "OUT"], c, n).alias("direction"), F.concat(F.lit("KZ"), F.lpad(draw("cp", 10**9, c, n).cast("string"), 12, "0")).alias("counterparty_ref"),
        F.lit(1).alias("payload_version"), F.date_format(F.timestamp_add("HOUR", F.lit(2), when), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("loaded_at"),
    )


def _cards(spark, clients, scale) -> DataFrame:
    c, n = F.col("client"), F.col("n")
    op = pick("cop", ["PUR", "PUR", "PUR", "WDR", "BLK"], c, n)
    rows = _rows(spark, clients, PER_CLIENT["card_processing"], scale).withColumn("op", op)
    paid, bought = F.col("op") != "BLK", F.col("op") == "PUR"
    millis = F.unix_millis(F.concat(_moment("card", c, n).cast("string"), F.lit("Z")).cast("timestamp"))
    return rows.select(
        F.concat(F.lit("CD-"), F.lpad(c.cast("string"), 6, "0"), F.lit("-"), F.lpad(n.cast("string"), 5, "0")).alias("rec_id"), _ref("CH", c).alias("cardholder_id"), millis.alias("txn_time_ms"), "op", F.lit("1.2").alias("schema_version"),
        pick("country", ["KZ", "KZ", "KZ", "TR", "AE", "RU", "DE"], c, n).alias("terminal_country"), F.when(paid, draw("minor", 9_000_000, c, n) + 100).alias("amount_minor"), F.when(paid, pick("ccur", ["398", "398", "398", "840", "978"], c, n)).alias("currency_code"),
        F.when(bought, pick("cat", ["GROCERY", "FUEL", "TRAVEL", "HEALTH", "CLOTHES"], c, n)).alias("merchant_category"), F.when(bought, F.concat(F.lit("M"), draw("mer", 500, c, n).cast("string"))).alias("merchant_id"),
        F.when(F.col("op") == "WDR", F.concat(F.lit("A"), draw("atm", 90, c, n).cast("string"))).alias("atm_id"), F.when(F.col("op") == "BLK", pick("why", ["client_request", "fraud_suspected", "expired"], c, n)).alias("block_reason"),
    )


def _logs(spark, clients, scale) -> DataFrame:
    c, n, a = F.col("client"), F.col("n"), F.col("a")
    acts = _rows(spark, clients, PER_CLIENT["sessions"], scale).withColumn("a", F.explode(F.sequence(F.lit(0).cast("long"), 2 + draw("len", 2 * PER_CLIENT["actions"] - 4, c, n))))
    when = F.timestamp_add("SECOND", (a * 60 + draw("gap", 55, c, n, a)).cast("int"), _moment("log", c, n))
    screen = F.when(a > 0, pick("screen", SCREENS, c, n, a))
    acts = acts.select(c, n, F.concat_ws("-", F.lit("AL"), _ref("", c), F.lpad(n.cast("string"), 5, "0"), F.lpad(a.cast("string"), 3, "0")).alias("event_uid"), when.alias("when"), F.when(a == 0, "LOGIN").otherwise(pick("act", ["screen_open", "button_click", "form_submit"], c, n, a)).alias("action"), screen.alias("screen"), F.lit(None).cast("string").alias("template_id"))
    push = _rows(spark, clients, PER_CLIENT["pushes"], scale).select(c, n, F.concat_ws("-", F.lit("PN"), _ref("", c), F.lpad(n.cast("string"), 5, "0")).alias("event_uid"), _moment("push", c, n).alias("when"), F.lit("push_received").alias("action"), F.lit(None).cast("string").alias("screen"), pick("tpl", [f"template_{i}" for i in range(12)], c, n).alias("template_id"))
    return acts.unionByName(push).select(
        "event_uid", _ref("L", c).alias("login_id"), _ref("D", c).alias("device_id"), F.date_format("when", "yyyy-MM-dd'T'HH:mm:ss").alias("ts_local"), "action", pick("ver", ["6.0", "6.1", "6.2"], c, n).alias("app_version"), pick("plat", ["ios", "android", "huawei"], c).alias("platform"), "screen", "template_id",
    )


def _snapshots(spark, clients) -> DataFrame:
    months = DAYS // 30 - 1  # the last one is before the injected ones
    c, m = F.col("client"), F.col("m")
    rows = spark.range(clients * months).select((F.col("id") % clients).alias("client"), F.floor(F.col("id") / clients).cast("int").alias("m")).where(c != NO_PROFILE)
    return rows.select(
        _ref("F", c).alias("cif"), F.date_format(F.add_months(F.lit(str(START)).cast("date"), m), "yyyy-MM-dd").alias("snapshot_date"), region_of(c).alias("region"), pick("emp", ["EMPLOYED", "SELF_EMPLOYED", "STUDENT", "RETIRED", "UNEMPLOYED"], c).alias("employment"),
        F.date_format(F.date_add(F.lit("2015-01-01").cast("date"), draw("open", 3000, c).cast("int")), "yyyy-MM-dd").alias("account_open_date"), (draw("salary", 900, c, m) * 1000 + 90_000).cast("string").alias("salary"),
        F.slice(F.array(*[F.lit(x) for x in ("card", "deposit", "loan", "broker")]), F.lit(1), (draw("prod", 4, c, m) + 1).cast("int")).alias("products"), (draw("age", 60, c) + 18 + F.floor(m / 12)).alias("age"),
    )


def _rates(spark) -> DataFrame:
    day = F.date_add(F.lit(str(START)).cast("date"), F.col("id").cast("int"))
    working = (F.dayofweek("day").between(2, 6)) & ~F.col("day").between(F.lit(str(GAP[0])).cast("date"), F.lit(str(GAP[0] + timedelta(days=GAP[1] - 1))).cast("date"))
    rows = spark.range(DAYS).select("id", day.alias("day")).where(working).withColumn("currency", F.explode(F.array(F.lit("USD"), F.lit("EUR"))))
    rate = F.when(F.col("currency") == "USD", 450).otherwise(490) * 10_000 + draw("fx", 400_000, F.col("id"), F.col("currency"))
    return rows.select(F.date_format("day", "yyyy-MM-dd").alias("rate_date"), "currency", (rate.cast("decimal(20,4)") / 10_000).cast("decimal(20,4)").cast("string").alias("rate_to_kzt"), F.lit("NBK").alias("source"))


def _injected() -> dict[str, list[tuple[str, dict]]]:
    """(case, record) of each source; a value None is written as null, an absent key is absent."""
    number = iter(range(10**6))

    def payment(case, when="20.01.2026 15:00", client=FIRST, **kw):
        base = {"source_record_id": f"CPX-{next(number):05}", "client_ref": f"{client:06}", "branch_region": "ALMATY", "operation_time": when, "op_code": "TRF", "amount": "1 500,00", "currency": "KZT", "direction": "IN", "counterparty_ref": f"KZ{next(number):012}", "payload_version": 1, "loaded_at": "2026-01-20T12:00:00Z"}
        return case, {k: v for k, v in (base | kw).items() if v != "absent"}

    def card(case, at, client=FIRST, **kw):
        millis = int((at - datetime(1970, 1, 1)).total_seconds() * 1000)
        return case, {"rec_id": f"CDX-{next(number):05}", "cardholder_id": f"CH{client:06}", "txn_time_ms": millis, "op": "PUR", "schema_version": "1.2", "terminal_country": "KZ", "amount_minor": 150_000, "currency_code": "398", "merchant_category": "GROCERY", "merchant_id": "M1"} | kw

    def action(case, at, action="screen_open", **kw):
        return case, {"event_uid": f"ALX-{next(number):05}", "login_id": f"L{FIRST:06}", "device_id": f"D{FIRST:06}", "ts_local": at.strftime("%Y-%m-%dT%H:%M:%S"), "action": action, "app_version": "6.2", "platform": "ios"} | kw

    def snapshot(case, day, client=FIRST, **kw):
        return case, {"cif": f"F{client:06}", "snapshot_date": day, "region": "ALMATY", "employment": "EMPLOYED", "account_open_date": "2020-01-31", "salary": "300000", "products": ["card"], "age": 40} | kw

    same = {"counterparty_ref": "KZ000000000777", "amount": "777,00"}
    tied = datetime(2026, 1, 10, 7, 0)
    local_t = CUTOFF + timedelta(hours=5)
    pays = [
        payment("null_given", amount=None), payment("blank_text", currency=""), payment("dash_or_na", direction="N/A"), payment("key_left_out", direction="absent"),
        payment("no_number", amount="abc"), payment("nan_text", amount="NaN"), payment("infinite_text", amount="-Inf"), payment("code_unknown", op_code="XYZ"),
        payment("below_training", amount="0,01"), payment("above_training", amount="5 000 000 000,00"), payment("years_ahead", "20.01.2028 15:00"),
        payment("sent_twice", source_record_id="CPX-EXACT", counterparty_ref="KZ1"), payment("sent_twice", source_record_id="CPX-EXACT", counterparty_ref="KZ1"),
        payment("same_fact", source_record_id="CPX-BUSINESS-a", **same), payment("same_fact", source_record_id="CPX-BUSINESS-b", **same),
        payment("two_versions", source_record_id="CPX-CONFLICT", amount="1,00", counterparty_ref="KZ2"), payment("two_versions", source_record_id="CPX-CONFLICT", amount="2,00", counterparty_ref="KZ2", payload_version=2),
        payment("tie_within_source", "10.01.2026 12:00"), payment("tie_within_source", "10.01.2026 12:00"), payment("tie_between_sources", "10.01.2026 12:00"),
        payment("foreign_money", "21.01.2026 12:00", currency="USD"), payment("rate_of_friday", "18.01.2026 12:00", currency="USD"), payment("rate_too_old", "14.07.2025 12:00", currency="USD"),
        payment("past_the_cutoff", (CUTOFF + timedelta(seconds=61, hours=5)).strftime("%d.%m.%Y %H:%M")), payment("old_zone_rule", "18.01.2024 12:00"), payment("only_event", "20.01.2026 15:00", client=SINGLE),
    ]
    cards = [card("tie_between_sources", tied), card("on_the_cutoff", CUTOFF), card("past_the_cutoff", CUTOFF + timedelta(seconds=1)), *(card("seldom_seen", datetime(2026, 1, 5 + i, 9, 0), merchant_category="ANTIQUES") for i in range(3)), card("never_trained", datetime(2026, 2, 10, 9, 0), merchant_category="SPACE_TRAVEL")]
    logs = [action("session_cut_off", local_t + timedelta(seconds=20 * i - 120), "LOGIN" if i == 0 else "screen_open", **({"screen": SCREENS[i % 10]} if i else {})) for i in range(12)]
    snaps = [snapshot("age_below_zero", "2026-01-15", client=FIRST + 1, age=-1), snapshot("list_too_long", "2026-01-16", products=[f"p{i:02}" for i in range(11, 0, -1)])]
    return {"core_payments": pays, "card_processing": cards, "app_logs": logs, "profile_snapshots": snaps, "fx_rates": []}


def dataset(spark: SparkSession, clients: int = 200, scale: float = 1.0) -> dict[str, DataFrame]:
    """Source -> ``case`` (null for background records) and ``payload``, a line of JSON. The same for the same numbers, in any partitioning."""
    background = {
        "core_payments": _payments(spark, clients, scale), "card_processing": _cards(spark, clients, scale), "app_logs": _logs(spark, clients, scale),
        "profile_snapshots": _snapshots(spark, clients), "fx_rates": _rates(spark),
    }
    none = F.lit(None).cast("string").alias("case")
    out = {}
    for name, more in _injected().items():
        rows = background[name].select(none, F.to_json(F.struct(*background[name].columns)).alias("payload"))
        if more:
            rows = rows.unionByName(spark.createDataFrame([(c, json.dumps(r, ensure_ascii=False)) for c, r in more], "case string, payload string"))
        out[name] = rows
    return out


def identities(clients: int) -> dict[str, dict[str, str]]:
    """The identity dictionary of so many clients."""
    refs = {"core_payments.client_ref": "", "card_processing.cardholder_id": "CH", "app_logs.login_id": "L", "profile_snapshots.cif": "F"}
    return {section: {f"{prefix}{c:06}": f"C{c:06}" for c in range(clients)} for section, prefix in refs.items()}


def case_counts(rows: dict[str, DataFrame], clients: int) -> dict[str, int]:
    """How many records each edge case has; every case has to be there."""
    out = {"many_events": 1, "client_unprofiled": 1, "client_silent": 1, "local_clock": 1} if clients > FIRST else {}
    for df in rows.values():
        for r in df.where("case is not null").groupBy("case").count().collect():
            out[r["case"]] = out.get(r["case"], 0) + r["count"]
    if missing := set(CASES) - set(out):
        raise ValueError(f"no record for {sorted(missing)}")
    return out


def write(spark: SparkSession, root: str, clients: int = 200, scale: float = 1.0, role: str = "train") -> dict:
    """Lay a data set out under ``root``: a directory of .jsonl files for each source, and ``_meta``. Returns the manifest."""
    rows = dataset(spark, clients, scale)
    jvm = spark._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name, df in rows.items():
        made = f"{root}/_meta/{uuid.uuid4().hex}"
        df.select("payload").write.text(made)
        target = jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
        fs = target.getFileSystem(conf)
        fs.mkdirs(target)
        parts = sorted(s.getPath().getName() for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(made)) if s.getPath().getName().startswith("part-"))
        for i, part in enumerate(parts):
            fs.rename(jvm.org.apache.hadoop.fs.Path(f"{made}/{part}"), jvm.org.apache.hadoop.fs.Path(f"{root}/{name}/{i:05}.jsonl"))
        storage.delete(spark, made)
    manifest = {"dataset_name": "generated", "dataset_role": role, "clients": clients, "cases": case_counts(rows, clients)}
    storage.write_text(spark, f"{root}/_meta/manifest.json", json.dumps(manifest, sort_keys=True))
    storage.write_text(spark, f"{root}/_meta/identity_mapping.json", json.dumps(identities(clients), sort_keys=True))
    storage.write_text(spark, f"{root}/_meta/edge_case_manifest.json", json.dumps(manifest["cases"], sort_keys=True))
    return manifest


#: defect -> one payment in so many has it.
DEFECTS = {
    "null_given": 11, "dash_or_na": 13, "key_left_out": 17, "no_number": 19, "nan_text": 23, "code_unknown": 29,
    "years_ahead": 31, "sent_twice": 37, "same_fact": 41, "two_versions": 43, "below_training": 47, "above_training": 53, "foreign_money": 5,
}


def payments(events: DataFrame) -> DataFrame:
    """``source_record_id, defects, payload``: payment records as JSON lines, from ``event_id, user_id, ts, value`` rows.

    Every so many-th event's record has a defect, and can have several;
    duplicates come as further rows.
    """
    key = F.col("event_id")
    rows = events.select("event_id", "user_id", "ts", "value", F.array_compact(F.array(*[F.when(key % n == 0, d) for d, n in DEFECTS.items()])).alias("defects"))
    has = lambda n: F.array_contains("defects", n)
    cents = F.round(F.col("value") * 100).cast("long")
    plain = F.concat((cents / 100).cast("long").cast("string"), F.lit(","), F.lpad((cents % 100).cast("string"), 2, "0"))
    amount = F.when(has("null_given"), None).when(has("no_number"), "abc").when(has("nan_text"), "NaN").when(has("below_training"), "0,01").when(has("above_training"), "5 000 000 000,00").otherwise(plain)
    when = F.when(has("years_ahead"), F.col("ts") + F.expr("interval 4 years")).otherwise(F.col("ts"))
    rows = rows.select(
        F.format_string("G-%08d", key).alias("source_record_id"), "defects", F.format_string("%06d", F.col("user_id")).alias("client_ref"), F.lit("ALMATY").alias("branch_region"), F.date_format(when, "dd.MM.yyyy HH:mm").alias("operation_time"),
        F.when(has("code_unknown"), "XYZ").otherwise("TRF").alias("op_code"), amount.alias("amount"), F.when(has("foreign_money"), "840").otherwise("KZT").alias("currency"),
        F.when(has("key_left_out"), None).when(has("dash_or_na"), "N/A").otherwise("IN").alias("direction"), F.format_string("KZ%012d", key).alias("counterparty_ref"), F.lit(1).alias("payload_version"), F.date_format(F.col("ts") + F.expr("interval 1 day"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("loaded_at"),
    )
    copies = rows.where(F.array_contains("defects", "sent_twice"))
    refiled = rows.where(F.array_contains("defects", "same_fact")).withColumn("source_record_id", F.concat("source_record_id", F.lit("-b")))
    changed = rows.where(F.array_contains("defects", "two_versions")).withColumns({"amount": F.lit("1,00"), "payload_version": F.lit(2)})
    every = rows.unionByName(copies).unionByName(refiled).unionByName(changed)
    names = [c for c in every.columns if c != "defects"]
    # a null amount is written as null; a missing direction is a missing key
    without = F.to_json(F.struct(*names), {"ignoreNullFields": "true"})
    payload = F.when(F.col("amount").isNull(), F.regexp_replace(without, r"\}$", ',"amount":null}')).otherwise(without)
    return every.select("source_record_id", F.array_join("defects", ",").alias("defects"), payload.alias("payload"))
