"""Every operator over the star-schema tables, each with an equivalent SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import hashing, times
from ..operators import blocks, buckets, checks, dedup, fields, fx, identity, profiles, sessions, timeline, timestamps, tokens
from ..sources import jsonl

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

CUT = "2024-01-20 12:00:00"
ORDER_CUT = "2000-06-30 12:00:00"
ZONES = {"AFRICA": "Africa/Cairo", "AMERICA": "America/New_York", "ASIA": "Asia/Almaty", "EUROPE": "Europe/Berlin"}
CODES = {"purchase": "PAYMENT", "signup": "ENROLMENT", "view": None, "click": None}
STAMP = "strftime({}, '%Y-%m-%dT%H:%M:%S.%fZ')"
#: SHA-256 over length-prefixed parts.
DIGEST = "sha256({})"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Register a query and its SQL under the function's name."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def _sql_digest(*parts: str) -> str:
    return "sha256(" + " || ".join(f"unhex(printf('%016x', strlen({p}))) || encode({p})" for p in parts) + ")"


def _sql_zone(region: str) -> str:
    return f"CASE {region} " + " ".join(f"WHEN '{r}' THEN '{z}'" for r, z in ZONES.items()) + " END"


def _sql_priority(key: str, seed: int) -> str:
    spread = (seed * hashing.SEED_MIXER) & ((1 << 64) - 1)
    return f"xor(('0x' || substr({_sql_digest(key)}, 1, 16))::UBIGINT, {spread}::UBIGINT)"


# --- O01 scan and contract -------------------------------------------------------------------------------------------

PROPS = jsonl.Contract(
    "props", "reference", 1, ("id",),
    {"id": jsonl.ColumnSpec("string"), "k": jsonl.ColumnSpec("integer"), "note": jsonl.ColumnSpec("string", required=False, nullable=True)}, time_field="id",
)
_BROKEN = [(11, """{{"id": "E{n}", "k": "{n}"}}"""), (13, """{{"id": "E{n}", "k": {n}, "z": 1}}"""), (17, """{{"id": "E{n}"}}"""), (19, "no json {n}"), (23, """{{"id": "E{n}", "k": null}}"""), (29, """{{"id": "E{n}", "k": true}}"""), (31, """{{"id": " ", "k": {n}}}"""), (37, """{{"id": "E{n}", "k": {n}, "note": null}}""")]


def _line_sql() -> str:
    cases = " ".join(f"WHEN event_id % {m} = 0 THEN " + " || ".join(f"'{p}'" if i % 2 == 0 else "CAST(event_id AS VARCHAR)" for i, p in enumerate(t.format(n="\0").split("\0"))) for m, t in _BROKEN)
    return f"""CASE {cases} ELSE '{{"id": "E' || CAST(event_id AS VARCHAR) || '", "k": ' || regexp_extract(props, '[0-9]+', 0) || '}}' END"""


@query(f"""
WITH l AS (SELECT event_id, {_line_sql()} AS value FROM events),
j AS (SELECT event_id, json_valid(value) AS ok, CASE WHEN json_valid(value) THEN value END AS v FROM l),
c AS (SELECT event_id, ok, array_to_string(list_filter([
    CASE WHEN len(list_filter(json_keys(v), lambda x: x NOT IN ('id', 'k', 'note'))) > 0 THEN 'unknown_field' END,
    CASE WHEN NOT list_contains(json_keys(v), 'k') THEN 'missing:k' END,
    CASE WHEN json_type(v, '$.k') = 'NULL' THEN 'null:k' END,
    CASE WHEN json_type(v, '$.k') IN ('VARCHAR', 'BOOLEAN', 'DOUBLE') THEN 'type:k' END,
    CASE WHEN trim(json_extract_string(v, '$.id')) = '' THEN 'blank_key:id' END], lambda x: x IS NOT NULL), ',') AS d FROM j)
SELECT event_id AS line_number, CASE WHEN NOT ok THEN 'not_an_object' ELSE d END AS details, NOT ok OR d <> '' AS rejected FROM c
""")
def o01_contract(spark, sf_dir):
    """Lines checked against a contract: every violation of every line."""
    made = table(spark, sf_dir, "events").select(F.lit("events").alias("partition"), F.col("event_id").alias("line_number"), F.expr(_line_sql().replace("VARCHAR", "STRING")).alias("value"))
    return jsonl.checked(made, PROPS).select("line_number", F.array_join("details", ",").alias("details"), F.col("reason").isNotNull().alias("rejected"))


# --- O02 identity ----------------------------------------------------------------------------------------------------


def _dictionary(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer").where("c_nationkey < 20")
    return c.select(F.lit("app").alias("source"), F.col("c_custkey").cast("string").alias("ref"), F.concat(F.lit("C"), F.lpad(F.col("c_custkey").cast("string"), 6, "0")).alias("client_id"))


@query("""
SELECT event_id, 'C' || lpad(c_custkey::VARCHAR, 6, '0') AS client_id, CASE WHEN c_custkey IS NULL THEN 'unresolved_client_id' END AS reason
FROM events LEFT JOIN (SELECT * FROM customer WHERE c_nationkey < 20) ON user_id = c_custkey
""")
def o02_identity(spark, sf_dir):
    """Events with their client, or the reason why there is none."""
    rows = table(spark, sf_dir, "events").select("event_id", F.lit("app").alias("source"), F.col("user_id").cast("string").alias("ref"))
    good, bad = identity.resolve_identity(rows, _dictionary(spark, sf_dir), "source", "ref")
    return good.select("event_id", "client_id", F.lit(None).cast("string").alias("reason")).unionByName(bad.select("event_id", F.lit(None).cast("string").alias("client_id"), "reason"))


# --- O03-O05 zones, instants, cutoff ---------------------------------------------------------------------------------

_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
_SQL_REGION = "list_extract(['AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'], (o_orderkey % 5 + 1)::INT)"


def _snapshots(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("client_id"), F.col("o_orderdate").alias("snapshot_date"), "o_orderkey",
        F.element_at(F.array(*[F.lit(r) for r in _REGIONS]), (F.col("o_orderkey") % 5 + 1).cast("int")).alias("region"),
    )


@query(f"""
WITH s AS (SELECT o_custkey AS client_id, o_orderkey, (o_orderdate AT TIME ZONE 'Asia/Almaty') AT TIME ZONE 'UTC' AS inst, {_sql_zone(_SQL_REGION)} AS z FROM orders)
SELECT client_id, z AS client_zone FROM s WHERE z IS NOT NULL AND inst <= TIMESTAMP '{ORDER_CUT}' QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY inst DESC, o_orderkey) = 1
""")
def o03_client_zone(spark, sf_dir):
    """Each client's zone from the last snapshot up to the cutoff."""
    return timestamps.client_zones(_snapshots(spark, sf_dir), ORDER_CUT, ZONES, "Asia/Almaty", ["o_orderkey"])


def _located(spark, sf_dir) -> DataFrame:
    e, c = table(spark, sf_dir, "events"), table(spark, sf_dir, "customer")
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    places = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("c_custkey", "r_name")
    return e.join(places, e.user_id == places.c_custkey, "left").select("event_id", "user_id", "event_type", F.col("ts").alias("raw"), "r_name", "value")


def _instants(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    rows = _located(spark, sf_dir).withColumn("raw_text", F.date_format("raw", "yyyy-MM-dd'T'HH:mm:ss"))
    processed = F.timestamp_add("MINUTE", (F.col("event_id") % 400).cast("int"), F.col("raw"))
    return timestamps.normalize(rows, "raw_text", "iso_local", zone=timestamps.zone_of(F.col("r_name"), ZONES), zone_is_given=True, cutoff="2024-01-10 00:00:00", horizon_days=15, processed=processed, max_delay_hours=4)


_SQL_LOCATED = f"""SELECT event_id, user_id, event_type, ts AS raw, {_sql_zone('r_name')} AS zone FROM events LEFT JOIN customer ON user_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""


@query(f"""
WITH z AS ({_SQL_LOCATED}), t AS (SELECT *, (date_trunc('second', raw) AT TIME ZONE zone) AT TIME ZONE 'UTC' AS u FROM z)
SELECT event_id, {STAMP.format('u')} AS ts, zone AS calendar_zone, CASE WHEN zone IS NULL THEN 'unknown_timezone' END AS reason,
       u > TIMESTAMP '2024-01-25 00:00:00' AS is_future, (raw + INTERVAL 1 MINUTE * (event_id % 400)) - u > INTERVAL 4 HOUR AS is_late
FROM t
""")
def o04_timestamps(spark, sf_dir):
    """Local times of events as instants, with zones, flags and rejects."""
    good, bad = _instants(spark, sf_dir)
    none = lambda t: F.lit(None).cast(t)
    out = good.select("event_id", times.render(F.col("ts")).alias("ts"), "calendar_zone", none("string").alias("reason"), "is_future", "is_late")
    return out.unionByName(bad.select("event_id", none("string").alias("ts"), none("string").alias("calendar_zone"), "reason", none("boolean").alias("is_future"), none("boolean").alias("is_late")))


@query(f"SELECT event_id, user_id, event_type FROM events WHERE ts <= TIMESTAMP '{CUT}'")
def o05_cutoff(spark, sf_dir):
    """Events up to the cutoff."""
    return timestamps.up_to(table(spark, sf_dir, "events"), CUT).select("event_id", "user_id", "event_type")


# --- O06 duplicates --------------------------------------------------------------------------------------------------


def _copies(spark, sf_dir) -> DataFrame:
    """Events, exact copies of every tenth, conflicting copies of every seventh (every other with a version), refiled ones of every ninth."""
    e = table(spark, sf_dir, "events").select(F.lit("app").alias("source"), F.col("event_id").cast("string").alias("source_record_id"), "event_id", "user_id", "ts", "event_type", F.round("value", 2).alias("value"), F.lit(1).alias("version"), F.lit(0).alias("line"))
    copy = e.where("event_id % 10 = 0").withColumn("line", F.lit(1))
    other = e.where("event_id % 7 = 0").withColumn("value", F.round(F.col("value") + 1, 2)).withColumn("version", F.when(F.col("event_id") % 2 == 0, 2).otherwise(1)).withColumn("line", F.lit(2))
    refiled = e.where("event_id % 9 = 0").withColumn("source_record_id", F.concat("source_record_id", F.lit("-b"))).withColumn("line", F.lit(3))
    return e.unionByName(copy).unionByName(other).unionByName(refiled)


_SQL_COPIES = """e AS (SELECT 'app' AS source, event_id::VARCHAR AS rid, event_id, user_id, ts, event_type, round(value, 2) AS value, 1 AS version, 0 AS line FROM events),
a AS (SELECT * FROM e UNION ALL SELECT * REPLACE (1 AS line) FROM e WHERE event_id % 10 = 0
      UNION ALL SELECT * REPLACE (round(value + 1, 2) AS value, CASE WHEN event_id % 2 = 0 THEN 2 ELSE 1 END AS version, 2 AS line) FROM e WHERE event_id % 7 = 0
      UNION ALL SELECT * REPLACE (rid || '-b' AS rid, 3 AS line) FROM e WHERE event_id % 9 = 0),
g AS (SELECT *, first_value(value) OVER (PARTITION BY rid ORDER BY line) AS v0, max(version) OVER (PARTITION BY rid) AS top FROM a),
k AS (SELECT rid, count(DISTINCT value) AS kinds, count(DISTINCT value) FILTER (version = top) AS tops FROM g GROUP BY rid),
x AS (SELECT a.*, CASE WHEN kinds = 1 THEN 'keep' WHEN tops = 1 THEN 'keep' ELSE 'drop' END AS fate,
      row_number() OVER (PARTITION BY a.rid ORDER BY CASE WHEN kinds = 1 THEN 0 ELSE -version END, line) AS n FROM a JOIN k USING (rid))"""


def _signature():
    return F.concat_ws("|", F.col("user_id").cast("string"), F.col("ts").cast("string"), "event_type", F.col("value").cast("string"))


@query(f"WITH {_SQL_COPIES} SELECT rid AS source_record_id, line::BIGINT AS line, version::BIGINT AS version FROM x WHERE fate = 'keep' AND n = 1")
def o06a_exact_dedup(spark, sf_dir):
    """One row for each record: copies collapse, the highest version wins a conflict."""
    good, _ = dedup.exact(_copies(spark, sf_dir), ["source", "source_record_id"], _signature(), ["line"], "version")
    return good.select("source_record_id", F.col("line").cast("long").alias("line"), F.col("version").cast("long").alias("version"))


@query(f"WITH {_SQL_COPIES} SELECT rid AS source_record_id, count(*)::BIGINT AS n_rows, 'unresolved_duplicate_conflict' AS reason FROM x WHERE fate = 'drop' GROUP BY rid")
def o06b_conflicts(spark, sf_dir):
    """Records whose versions leave the conflict open, all their rows."""
    _, bad = dedup.exact(_copies(spark, sf_dir), ["source", "source_record_id"], _signature(), ["line"], "version")
    return bad.groupBy("source_record_id", "reason").agg(F.count("*").alias("n_rows")).select("source_record_id", "n_rows", "reason")


@query(f"""WITH {_SQL_COPIES}, u AS (SELECT * FROM x WHERE fate = 'keep' AND n = 1)
SELECT min(rid) AS source_record_id, count(*)::BIGINT AS n_facts FROM u GROUP BY user_id, ts, event_type, value""")
def o06c_business_dedup(spark, sf_dir):
    """One record for each business fact, the one with the smallest id; and how many there were."""
    good, _ = dedup.exact(_copies(spark, sf_dir), ["source", "source_record_id"], _signature(), ["line"], "version")
    facts = ["user_id", "ts", "event_type", "value"]
    n = Window.partitionBy(*facts)
    return dedup.business(good.withColumn("n_facts", F.count("*").over(n)), facts).select("source_record_id", "n_facts")


# --- O07 event types, O08 sessions -----------------------------------------------------------------------------------

_SQL_TYPE = "CASE event_type WHEN 'purchase' THEN 'PAYMENT' WHEN 'signup' THEN 'ENROLMENT' END"


@query(f"""
SELECT event_id AS record, {_SQL_TYPE} AS event_type, CASE WHEN event_type = 'error' THEN 'unknown_event_type' END AS reason,
       substr({_sql_digest("'app'", "event_id::VARCHAR", _SQL_TYPE, "epoch_us(ts)::VARCHAR")}, 1, 32) AS event_id FROM events
""")
def o07_event_map(spark, sf_dir):
    """Codes as event types, with event ids; unknown codes rejected, technical ones without a type."""
    rows = table(spark, sf_dir, "events").withColumnRenamed("event_id", "record")
    good, bad = identity.map_events(rows, CODES, "event_type")
    eid = hashing.event_id(F.lit("app"), F.col("record").cast("string"), F.col("event_type"), F.col("ts"))
    none = F.lit(None).cast("string")
    return good.select("record", "event_type", none.alias("reason"), eid.alias("event_id")).unionByName(bad.select("record", none.alias("event_type"), "reason", none.alias("event_id")))


GAP = 6 * 3600


@query(f"""
WITH a AS (SELECT *, 's' || ((regexp_extract(props, '[0-9]+', 0)::BIGINT) % 12)::VARCHAR AS screen FROM events WHERE event_type IN ('view', 'click', 'signup')),
b AS (SELECT *, lag(ts) OVER w AS before FROM a WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(CASE WHEN before IS NULL OR event_type = 'signup' OR epoch_us(ts) - epoch_us(before) > {GAP}000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM b),
f AS (SELECT user_id, no, screen, min((ts, event_id)) AS k FROM s GROUP BY ALL),
l AS (SELECT user_id, no, list(screen ORDER BY k) AS screens FROM f GROUP BY ALL)
SELECT s.user_id, s.no::BIGINT AS session_no, min(event_id)::BIGINT AS first_event, count(*)::BIGINT AS n_actions, ((max(epoch_us(ts)) - min(epoch_us(ts))) // 1000000)::BIGINT AS duration_seconds,
       any_value(len(screens))::BIGINT AS screens_count, any_value(screens[1]) AS first_screen, any_value(screens[-1]) AS last_screen, any_value(array_to_string(screens, ',')) AS screens
FROM s JOIN l USING (user_id, no) GROUP BY s.user_id, s.no
""")
def o08_sessions(spark, sf_dir):
    """Sessions of users: cut at sign-ups and after gaps of more than six hours."""
    rows = table(spark, sf_dir, "events").where(F.col("event_type").isin("view", "click", "signup"))
    rows = rows.withColumn("screen", F.concat(F.lit("s"), (F.regexp_extract("props", "[0-9]+", 0).cast("long") % 12).cast("string")))
    s = sessions.sessionize(rows, ["signup"], GAP, action="event_type", client="user_id", record_id="event_id")
    return s.select("user_id", "session_no", F.col("event_id").alias("first_event"), "n_actions", "duration_seconds", "screens_count", "first_screen", "last_screen", F.array_join("screens", ",").alias("screens"))


# --- O09-O11 projection, categories, numbers -------------------------------------------------------------------------


@query("""
SELECT event_id, coalesce(CASE WHEN event_id % 6 IN (1, 2, 3, 4) THEN NULL ELSE event_type END, 'MISSING') AS kind,
       CASE WHEN event_id % 4 = 0 THEN 'MISSING' ELSE user_id::VARCHAR END AS client, 'MISSING' AS absent FROM events
""")
def o09_project(spark, sf_dir):
    """Model fields from source fields; null, blank and placeholders are MISSING, as is a field that is not there."""
    raw = F.when(F.col("event_id") % 6 == 1, "").when(F.col("event_id") % 6 == 2, " n/A ").when(F.col("event_id") % 6 == 3, "--").when(F.col("event_id") % 6 == 4, None).otherwise(F.col("event_type"))
    rows = table(spark, sf_dir, "events").withColumn("code", raw).withColumn("who", F.when(F.col("event_id") % 4 != 0, F.col("user_id").cast("string")))
    out = fields.project(rows, {"kind": "code", "client": "who", "absent": "no_such_field"}, ["N/A", "-", "--"], ["event_id"])
    return out.select("event_id", *[fields.rendered(F.col(c)).alias(c) for c in ("kind", "client", "absent")])


@query("""
WITH r AS (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN lower(c_mktsegment) WHEN 1 THEN ' ' || c_mktsegment || chr(160) WHEN 2 THEN 'cars' WHEN 3 THEN 'space' ELSE c_mktsegment END AS raw FROM customer),
t AS (SELECT c_custkey, upper(regexp_replace(raw, '^[ \\x{00A0}]+|[ \\x{00A0}]+$', '', 'g')) AS u FROM r),
a AS (SELECT c_custkey, CASE WHEN u = 'CARS' THEN 'AUTOMOBILE' ELSE u END AS u FROM t)
SELECT c_custkey, CASE WHEN u IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD') THEN u ELSE 'MISSING' END AS segment,
       CASE WHEN u IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD') THEN u || ',AUTOMOBILE' ELSE 'AUTOMOBILE' END AS segments FROM a
""")
def o10_categories(spark, sf_dir):
    """Canonical categories: trimmed, upper case, aliased, within a closed domain; lists item by item."""
    seg = F.col("c_mktsegment")
    raw = F.when(F.col("c_custkey") % 5 == 0, F.lower(seg)).when(F.col("c_custkey") % 5 == 1, F.concat(F.lit(" "), seg, F.lit(" "))).when(F.col("c_custkey") % 5 == 2, "cars").when(F.col("c_custkey") % 5 == 3, "space").otherwise(seg)
    rows = table(spark, sf_dir, "customer").select("c_custkey", raw.alias("segment")).withColumn("segments", F.array(F.col("segment"), F.lit("Cars"), F.lit("other")))
    rule = fields.Category({"CARS": "AUTOMOBILE"}, ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"))
    out = fields.categories(rows, {"segment": rule, "segments": rule})
    return out.select("c_custkey", fields.rendered(F.col("segment")).alias("segment"), F.coalesce(F.array_join("segments", ","), F.lit("MISSING")).alias("segments"))


@query("""
WITH r AS (SELECT o_orderkey, round(o_totalprice * 100)::BIGINT AS cents FROM orders),
v AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 IN (1, 2) THEN NULL WHEN o_orderkey % 11 IN (3, 4) THEN NULL WHEN o_orderkey % 11 = 5 THEN NULL WHEN cents > 20000000 THEN NULL ELSE cents END AS c,
      CASE WHEN o_orderkey % 11 IN (1, 2) THEN 'non_finite' WHEN o_orderkey % 11 IN (3, 4) THEN 'parse_error' WHEN o_orderkey % 11 = 5 THEN NULL WHEN cents > 20000000 THEN 'business_range' END AS reason FROM r)
SELECT o_orderkey, c AS cents, reason FROM v
""")
def o11_numeric(spark, sf_dir):
    """Amounts written in a locale as exact decimals, or why they are none."""
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    whole = F.regexp_replace(F.format_number((cents / 100).cast("long"), 0), ",", " ")
    written = F.concat(whole, F.lit(","), F.lpad((cents % 100).cast("string"), 2, "0"))
    m = F.col("o_orderkey") % 11
    raw = F.when(m == 1, "NaN").when(m == 2, "-Inf").when(m == 3, "1.234,5").when(m == 4, "abc").when(m == 5, None).otherwise(written)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("amount"))
    out = fields.numeric(rows, "amount", numeric_type="decimal", locale="ru_KZ", least="0", most="200000")
    return out.select("o_orderkey", (F.col("amount") * 100).cast("long").alias("cents"), F.col("amount__reason").alias("reason"))


# --- O12 exchange rates ----------------------------------------------------------------------------------------------


@query("""
WITH r AS (SELECT o_orderpriority AS currency, o_orderdate::DATE AS d, (1 + o_orderkey % 700)::BIGINT AS rate FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 40 = 0
           QUALIFY row_number() OVER (PARTITION BY o_orderpriority, o_orderdate::DATE ORDER BY o_orderkey DESC) = 1),
a AS (SELECT l_orderkey, l_partkey, l_linenumber, l_shipdate, round(l_extendedprice * 100)::BIGINT AS cents, CASE l_linenumber % 3 WHEN 0 THEN 'BASE' WHEN 1 THEN '1-URGENT' ELSE '5-LOW' END AS currency FROM lineitem),
j AS (SELECT a.*, r.rate FROM a ASOF LEFT JOIN r ON a.currency = r.currency AND a.l_shipdate::DATE >= r.d AND TRUE),
k AS (SELECT a.*, r.rate, r.d FROM a ASOF LEFT JOIN r ON a.currency = r.currency AND a.l_shipdate::DATE >= r.d)
SELECT currency, l_linenumber::BIGINT AS line, count(*)::BIGINT AS n, count(*) FILTER (currency = 'BASE' OR (rate IS NOT NULL AND l_shipdate::DATE - d <= 3))::BIGINT AS n_converted,
       sum(CASE WHEN currency = 'BASE' THEN cents WHEN l_shipdate::DATE - d <= 3 THEN cents * rate END)::BIGINT AS cents_base
FROM k GROUP BY ALL
""".replace("j AS (SELECT a.*, r.rate FROM a ASOF LEFT JOIN r ON a.currency = r.currency AND a.l_shipdate::DATE >= r.d AND TRUE),\n", ""))
def o12_fx_asof(spark, sf_dir):
    """Amounts in the base currency by the latest rate that is at most three days old."""
    o = table(spark, sf_dir, "orders").where("o_orderstatus = 'F' and o_orderkey % 40 = 0")
    rates = o.select(F.col("o_orderpriority").alias("currency"), F.col("o_orderdate").alias("rate_date"), (1 + F.col("o_orderkey") % 700).cast("decimal(12,4)").alias("rate"), F.lit("NB").alias("provider"), "o_orderkey")
    rt = fx.rate_table(rates, ["NB"], order=["o_orderkey"])
    cur = F.when(F.col("l_linenumber") % 3 == 0, "BASE").when(F.col("l_linenumber") % 3 == 1, "1-URGENT").otherwise("5-LOW")
    amounts = table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").cast("long").alias("line"), F.col("l_shipdate").alias("ts"), (F.round(F.col("l_extendedprice") * 100).cast("long").cast("decimal(20,4)") / 100).cast("decimal(20,4)").alias("amount"), cur.alias("currency"))
    out = fx.convert(amounts, rt, "BASE", days=3)
    return out.groupBy("currency", "line").agg(F.count("*").alias("n"), F.count("amount_base").alias("n_converted"), (F.sum("amount_base") * 100).cast("long").alias("cents_base"))


# --- O13 profiles, O14 policies --------------------------------------------------------------------------------------


@query(f"""
WITH s AS (SELECT o_custkey AS client_id, o_orderkey, o_orderdate AS ts, o_orderpriority FROM orders WHERE o_orderdate <= TIMESTAMP '{ORDER_CUT}' AND o_custkey % 3 > 0 QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
e AS (SELECT user_id AS client_id, count(*) AS n, count(*) FILTER (event_type = 'purchase') AS t, min(ts) AS a, min(ts) FILTER (event_type = 'signup') AS b FROM events WHERE ts <= TIMESTAMP '{CUT}' GROUP BY user_id)
SELECT client_id, o_orderpriority AS priority, s.ts IS NULL AS profile_missing, coalesce(n, 0)::BIGINT AS event_count, coalesce(t, 0)::BIGINT AS transaction_count,
       floor((epoch_us(TIMESTAMP '{CUT}') - epoch_us(a)) / 86400000000)::BIGINT AS first_seen_days, floor((epoch_us(TIMESTAMP '{CUT}') - epoch_us(b)) / 86400000000)::BIGINT AS first_topup_days
FROM s FULL JOIN e USING (client_id)
""")
def o13_profile(spark, sf_dir):
    """Latest snapshot of each client and life-long aggregates of its events."""
    s = timestamps.up_to(table(spark, sf_dir, "orders").where("o_custkey % 3 > 0").select(F.col("o_custkey").alias("client_id"), "o_orderkey", F.col("o_orderdate").alias("ts"), F.col("o_orderpriority").alias("priority")), ORDER_CUT)
    e = timestamps.up_to(table(spark, sf_dir, "events").select(F.col("user_id").alias("client_id"), "ts", "event_type"), CUT)
    out = profiles.build(s, e, CUT, ["ts", "o_orderkey"], ["priority"], ["purchase"], F.col("event_type") == "signup")
    return out.select("client_id", "priority", "profile_missing", "event_count", "transaction_count", "first_seen_days", "first_topup_days")


@query("""
WITH b AS (SELECT DISTINCT o_custkey, p_brand FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey)
SELECT o_custkey AS client_id, array_to_string(list_sort(list(p_brand))[1:8], ',') AS brands, count(*)::BIGINT AS n_brands FROM b GROUP BY o_custkey
""")
def o14_policies(spark, sf_dir):
    """Unordered lists sorted and cut to eight values, excluded fields gone."""
    o, li, p = (table(spark, sf_dir, t) for t in ("orders", "lineitem", "part"))
    lists = li.join(p, li.l_partkey == p.p_partkey).join(o, li.l_orderkey == o.o_orderkey).groupBy(F.col("o_custkey").alias("client_id")).agg(F.collect_set("p_brand").alias("brands"))
    rows = lists.withColumn("n_brands", F.size("brands").cast("long")).withColumn("secret", F.lit(1))
    out = fields.apply_policies(rows, ["secret"], {"brands": (False, 8)})
    return out.select("client_id", F.array_join("brands", ",").alias("brands"), "n_brands")


# --- O15-O17 samples, edges, labels ----------------------------------------------------------------------------------

SAMPLE, SEED = 400, 7


def _values(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").withColumn("key", F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"), F.col("l_linenumber").cast("string")))
    return li.groupBy(F.col("l_returnflag").alias("field"), "key").agg(F.round(F.max("l_extendedprice") * 100).cast("long").alias("value"))


_SQL_VALUES = "v AS (SELECT l_returnflag AS field, l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber AS key, round(max(l_extendedprice) * 100)::BIGINT AS value FROM lineitem GROUP BY ALL)"
_SQL_SAMPLE = f"{_SQL_VALUES}, s AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY field ORDER BY {_sql_priority('key', SEED)}, key) <= {SAMPLE})"
_SQL_EDGES = f"""{_SQL_SAMPLE}, r AS (SELECT field, value, row_number() OVER (PARTITION BY field ORDER BY value) - 1 AS r, count(*) OVER (PARTITION BY field) AS n, min(value) OVER (PARTITION BY field) AS m FROM s),
g AS (SELECT field, value, m FROM r, range(1, 16) t(i) WHERE r.r = n * i // 16), d AS (SELECT DISTINCT field, value FROM g WHERE value > m)"""


@query(f"WITH {_SQL_SAMPLE} SELECT field, key, value FROM s")
def o15_sample(spark, sf_dir):
    """The 400 values of each field with the least hash priority."""
    return buckets.sample(_values(spark, sf_dir), SAMPLE, SEED).select("field", "key", "value")


def _edges(spark, sf_dir) -> DataFrame:
    return buckets.quantile_edges(buckets.sample(_values(spark, sf_dir), SAMPLE, SEED), {"A": 16, "N": 16, "R": 16})


@query(f"WITH {_SQL_EDGES} SELECT field, row_number() OVER (PARTITION BY field ORDER BY value) - 1 AS edge_no, value AS edge FROM d")
def o16_edges(spark, sf_dir):
    """Inner quantile edges of each field's sample, without repeats."""
    return _edges(spark, sf_dir).select("field", "edge_no", "edge")


@query(f"""
WITH {_SQL_EDGES}, e AS (SELECT field, list(value) AS edges FROM d GROUP BY field)
SELECT v.field, 'bucket_' || len(list_filter(edges, lambda x: x <= value))::VARCHAR AS label, count(*)::BIGINT AS n, min(value) AS least, max(value) AS most FROM v JOIN e USING (field) GROUP BY ALL
""")
def o17_bucketize(spark, sf_dir):
    """Every value's left-closed bucket, counted."""
    values = _values(spark, sf_dir)
    label = F.lit(None).cast("string")
    for f, e in buckets.fit(values, {f: ("quantile", 16) for f in "ANR"}, SAMPLE, SEED).items():
        label = F.when(F.col("field") == f, e.column(F.col("value").cast("decimal(38,8)"))).otherwise(label)
    labelled = values.select("field", label.alias("label"), "value")
    return labelled.groupBy("field", "label").agg(F.count("*").alias("n"), F.min("value").alias("least"), F.max("value").alias("most"))


@query(f"""
WITH {_SQL_SAMPLE}, x AS (SELECT field, min(value) AS lo, max(value) AS hi FROM s GROUP BY field)
SELECT v.field, count(*)::BIGINT AS assigned, count(*) FILTER (value < lo)::BIGINT AS clipped_low, count(*) FILTER (value > hi)::BIGINT AS clipped_high, 0::BIGINT AS missing FROM v JOIN x USING (field) GROUP BY v.field
""")
def o17_clip_counters(spark, sf_dir):
    """Values beyond the range that edges were fitted on, field by field."""
    values = _values(spark, sf_dir).withColumn("value", F.col("value").cast("decimal(38,8)"))
    edges = buckets.fit(values, {f: ("quantile", 16) for f in "ANR"}, SAMPLE, SEED)
    out = None
    for f, e in edges.items():
        one = buckets.clip_counts(values.where(F.col("field") == f).select(F.col("value").alias(f)), {f: e})
        out = one if out is None else out.unionByName(one)
    return out


# --- O18-O20 timeline, calendar, deltas ------------------------------------------------------------------------------


def _events(spark, sf_dir) -> DataFrame:
    """Events and orders of the same clients as one stream of typed events."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("client_id"), F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("ts"), F.lit(30).alias("source_priority"), F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("source_record_id"), F.upper("event_type").alias("event_type"))
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("client_id"), F.col("o_orderdate").alias("ts"), F.lit(10).alias("source_priority"), F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("source_record_id"), F.lit("ORDER").alias("event_type"))
    both = e.unionByName(o)
    return both.withColumn("event_id", hashing.event_id(F.col("source_priority").cast("string"), F.col("source_record_id"), F.col("event_type"), F.col("ts"))).withColumn("calendar_zone", F.when(F.col("client_id") % 2 == 0, "Asia/Almaty").otherwise("America/New_York"))


_SQL_EVENTS = f"""b AS (SELECT user_id AS client_id, date_trunc('hour', ts) AS ts, 30 AS pr, 'E' || event_id AS rid, upper(event_type) AS event_type FROM events
  UNION ALL SELECT o_custkey, o_orderdate, 10, 'O' || o_orderkey, 'ORDER' FROM orders),
v AS (SELECT *, substr({_sql_digest("pr::VARCHAR", "rid", "event_type", "epoch_us(ts)::VARCHAR")}, 1, 32) AS event_id, CASE WHEN client_id % 2 = 0 THEN 'Asia/Almaty' ELSE 'America/New_York' END AS zone FROM b),
t AS (SELECT *, row_number() OVER w - 1 AS position, lag(ts) OVER w AS before FROM v WINDOW w AS (PARTITION BY client_id ORDER BY ts, pr, rid)),
l AS (SELECT *, (ts AT TIME ZONE 'UTC') AT TIME ZONE zone AS local FROM t)"""


@query(f"WITH {_SQL_EVENTS} SELECT client_id, event_id, position, {STAMP.format('ts')} || '|' || lpad(pr::VARCHAR, 6, '0') || '|' || rid AS ordering_key, coalesce(before = ts, false) AS tied FROM t")
def o18_timeline(spark, sf_dir):
    """Each client's events in order, with positions and ordering keys."""
    return timeline.order_timeline(_events(spark, sf_dir)).select("client_id", "event_id", "position", "ordering_key", "tied")


@query(f"WITH {_SQL_EVENTS} SELECT event_id, hour(local)::BIGINT AS hour_of_day_local, (isodow(local) - 1)::BIGINT AS day_of_week_local, position = 0 AS lifetime_first, hour(local) <> hour(ts) OR isodow(local) <> isodow(ts) AS calendar_shifted FROM l")
def o19_calendar(spark, sf_dir):
    """Local hour and weekday of each event, and whether it is its client's first."""
    return timeline.calendar(timeline.order_timeline(_events(spark, sf_dir))).select("event_id", "hour_of_day_local", "day_of_week_local", "lifetime_first", "calendar_shifted")


@query(f"WITH {_SQL_EVENTS} SELECT client_id, event_id, (epoch_us(ts) - epoch_us(before)) // 1000000 AS delta_seconds FROM t WHERE before IS NOT NULL")
def o20_deltas(spark, sf_dir):
    """Whole seconds between neighbours of a timeline."""
    return timeline.deltas(timeline.order_timeline(_events(spark, sf_dir)))


@query(f"""WITH {_SQL_EVENTS}, s AS (SELECT event_id AS key, (epoch_us(ts) - epoch_us(before)) // 1000000 AS value FROM t WHERE before IS NOT NULL QUALIFY row_number() OVER (ORDER BY {_sql_priority('event_id', SEED)}, event_id) <= 1000),
r AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS r, count(*) OVER () AS n, min(value) OVER () AS m FROM s)
SELECT DISTINCT 'delta' AS field, value AS edge FROM r, range(1, 32) g(i) WHERE r.r = n * i // 32 AND value > m""")
def o20_delta_edges(spark, sf_dir):
    """Quantile edges of a sample of the deltas."""
    d = timeline.deltas(timeline.order_timeline(_events(spark, sf_dir))).select(F.lit("delta").alias("field"), F.col("event_id").alias("key"), F.col("delta_seconds").alias("value"))
    return buckets.quantile_edges(buckets.sample(d, 1000, SEED), {"delta": 32}).select("field", "edge")


#: One client has half of all events; no task may hold them.
_SQL_HOT = _SQL_EVENTS.replace("SELECT user_id AS client_id,", "SELECT CASE WHEN event_id % 5 < 3 THEN 1 ELSE user_id END AS client_id,")


def _hot_events(spark, sf_dir) -> DataFrame:
    e = _events(spark, sf_dir)
    number = F.expr("try_cast(substr(source_record_id, 2) as bigint)")
    client = F.when(F.col("source_record_id").startswith("E") & (number % 5 < 3), 1).otherwise(F.col("client_id"))
    return e.withColumn("client_id", client.cast("long")).withColumn("calendar_zone", F.when(F.col("client_id") % 2 == 0, "Asia/Almaty").otherwise("America/New_York"))


@query(f"WITH {_SQL_HOT} SELECT client_id, event_id, position, coalesce(before = ts, false) AS tied, (epoch_us(ts) - epoch_us(before)) // 1000000 AS delta_seconds FROM t")
def o18_hot_client(spark, sf_dir):
    """Positions and deltas where one client has half of all events: it is put in order by ranges, as is every client of over 50."""
    t = timeline.order_timeline(_hot_events(spark, sf_dir), heavy=50)
    d = timeline.deltas(t, heavy=50).select("event_id", "delta_seconds")
    return t.join(d, "event_id", "left").select("client_id", "event_id", "position", "tied", "delta_seconds")


@query(f"""
WITH a AS (SELECT event_id, event_type, ts, CASE WHEN event_id % 5 < 3 THEN 1 ELSE user_id END AS client_id FROM events),
b AS (SELECT *, lag(ts) OVER w AS before FROM a WINDOW w AS (PARTITION BY client_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(CASE WHEN before IS NULL OR event_type = 'signup' OR epoch_us(ts) - epoch_us(before) > 60000000 THEN 1 ELSE 0 END) OVER (PARTITION BY client_id ORDER BY ts, event_id) AS no FROM b),
f AS (SELECT client_id, no, event_type, min((ts, event_id)) AS k FROM s GROUP BY ALL),
l AS (SELECT client_id, no, list(event_type ORDER BY k) AS screens FROM f GROUP BY ALL)
SELECT s.client_id, s.no::BIGINT AS session_no, min(s.ts) AS begins, count(*)::BIGINT AS n_actions, ((max(epoch_us(ts)) - min(epoch_us(ts))) // 1000000)::BIGINT AS duration_seconds, any_value(array_to_string(screens, ',')) AS screens
FROM s JOIN l USING (client_id, no) GROUP BY s.client_id, s.no
""")
def o08_hot_client(spark, sf_dir):
    """Sessions where one client has half of all actions, cut by ranges."""
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "ts", F.when(F.col("event_id") % 5 < 3, 1).otherwise(F.col("user_id")).cast("long").alias("client_id"))
    s = sessions.sessionize(rows, ["signup"], 60, action="event_type", screen="event_type", record_id="event_id", heavy=50)
    return s.select("client_id", "session_no", F.col("ts").alias("begins"), "n_actions", "duration_seconds", F.array_join("screens", ",").alias("screens"))


# --- O21-O23 contract, quarantine, metrics ---------------------------------------------------------------------------

_TYPES = ["CLICK", "PURCHASE", "SIGNUP", "VIEW", "ORDER"]


@query(f"""WITH {_SQL_EVENTS}
SELECT unnest(['after_cutoff', 'no_instant', 'no_zone', 'position_gap', 'key_not_growing', 'domain_event_type', 'event_id_repeated']) AS "check",
       unnest([count(*) FILTER (ts > TIMESTAMP '{CUT}'), 0, 0, 0, 0, count(*) FILTER (event_type = 'ERROR'), 0])::BIGINT AS violations FROM t""")
def o21_contract(spark, sf_dir):
    """How often each post-condition of a timeline is broken."""
    return checks.violations(timeline.order_timeline(_events(spark, sf_dir)), CUT, {"event_type": _TYPES})


@query("""
WITH c AS (SELECT count(*) FILTER (event_type = 'purchase' AND round(value) > 80) AS a, count(*) FILTER (event_type = 'view' AND event_id % 7 = 3) AS b, count(*) FILTER (event_type <> 'purchase' AND event_id % 11 = 0) AS u, count(*) FILTER (event_id % 13 = 0) AS x FROM events)
SELECT unnest(['domain:PURCHASE.level', 'domain:VIEW.tags', 'undeclared:level', 'undeclared:tags', 'float:value', 'excluded:secret']) AS "check", unnest([a, b, u, 0, (SELECT count(*) FROM events), x])::BIGINT AS violations FROM c
""")
def o21_field_contract(spark, sf_dir):
    """How often fields break the output contract: domains, also of list items, undeclared and excluded fields, floating numbers."""
    e = table(spark, sf_dir, "events").withColumn("event_type", F.upper("event_type"))
    level = F.concat(F.lit("bucket_"), F.round("value").cast("int").cast("string"))
    tag = F.when(F.col("event_id") % 7 == 3, F.array(F.lit("X"), F.lit("Q"))).otherwise(F.array(F.lit("X")))
    rows = e.select("event_type", F.when((F.col("event_type") == "PURCHASE") | (F.col("event_id") % 11 == 0), level).alias("level"), F.when(F.col("event_type") == "VIEW", tag).alias("tags"), "value", F.when(F.col("event_id") % 13 == 0, "s").alias("secret"))
    sections = {"PURCHASE": {"level": checks.Declared(tuple(f"bucket_{i}" for i in range(-1000, 81)), True), "value": checks.Declared()}, "VIEW": {"tags": checks.Declared(("X", "Y"), multivalue=True), "value": checks.Declared()}, **{t: {"value": checks.Declared()} for t in ("CLICK", "SIGNUP", "ERROR")}}
    return checks.field_violations(rows, sections, ["secret"])


@query("""
WITH q AS (SELECT 'app' AS source, event_id::VARCHAR AS rid, event_id, 'unknown_event_type' AS reason FROM events WHERE event_type = 'error'
  UNION ALL SELECT 'app', event_id::VARCHAR, event_id, 'unresolved_client_id' FROM events LEFT JOIN customer ON user_id = c_custkey AND c_nationkey < 20 WHERE c_custkey IS NULL)
SELECT source, rid AS source_record_id, reason, true AS recoverable, 'events#' || event_id || ':' || rid AS raw_reference FROM q
""")
def o22_quarantine(spark, sf_dir):
    """Dead letters with reason, whether they can come back, and lineage."""
    rows = table(spark, sf_dir, "events").select(F.lit("app").alias("source"), F.col("event_id").cast("string").alias("source_record_id"), F.lit("events").alias("partition"), F.col("event_id").alias("line_number"), "event_type", F.col("user_id").cast("string").alias("ref"))
    _, a = identity.map_events(rows, CODES, "event_type")
    _, b = identity.resolve_identity(rows, _dictionary(spark, sf_dir), "source", "ref")
    return checks.quarantine(a.unionByName(b, allowMissingColumns=True), ["partition", "line_number"])


@query("""
WITH c AS (SELECT event_type AS label, count(*) AS n, count(*) FILTER (value > 90) AS a, count(*) FILTER (value > 90 AND user_id % 2 = 0) AS b, count(*) FILTER (user_id % 2 = 0) AS m FROM events GROUP BY event_type)
SELECT label, 'high_rate' AS metric, a AS hits, n AS total, a::DOUBLE / n AS rate FROM c UNION ALL SELECT label, 'high_even_rate', b, m, b::DOUBLE / nullif(m, 0) FROM c
UNION ALL SELECT label, 'never_rate', 0, 0, NULL FROM c
""")
def o23_metrics(spark, sf_dir):
    """Rates with their numerators and denominators; of nothing the rate is null."""
    even = F.col("user_id") % 2 == 0
    return checks.metrics(table(spark, sf_dir, "events"), {"high": (F.col("value") > 90, F.lit(True)), "high_even": (F.col("value") > 90, even), "never": (F.lit(True), F.lit(False))}, "event_type")


def _sql_report() -> str:
    rates = ", ".join(f"('{m}', '{r.total}', {'NULL' if r.warning is None else r.warning}::DOUBLE, {'NULL' if r.critical is None else r.critical}::DOUBLE, {r.label is not None})" for m, r in checks.RATES.items())
    return f"""
WITH r(metric, denominator, warning, critical, labelled) AS (VALUES {rates}),
h AS (SELECT 'late_arriving_rate' AS metric, event_type AS label, count(*) FILTER (value > 95) AS n FROM events GROUP BY event_type UNION ALL SELECT 'late_arriving_rate', NULL, count(*) FILTER (value > 95) FROM events
  UNION ALL SELECT 'unknown_event_type_rate', NULL, count(*) FILTER (event_type = 'error') FROM events UNION ALL SELECT 'schema_violation_rate', NULL, count(*) FILTER (event_id % 500 = 0) FROM events),
t AS (SELECT 'records_read' AS denominator, event_type AS label, count(*) AS n FROM events GROUP BY event_type UNION ALL SELECT 'records_read', NULL, count(*) FROM events UNION ALL SELECT 'records_mapped', NULL, count(*) FROM events UNION ALL SELECT 'events_validated', NULL, count(*) FROM events),
x AS (SELECT r.*, NULL AS label FROM r UNION ALL SELECT r.*, t.label FROM r JOIN t USING (denominator) WHERE labelled AND t.label IS NOT NULL),
y AS (SELECT x.metric, x.label, coalesce(h.n, 0)::BIGINT AS hits, x.denominator, coalesce(t.n, 0)::BIGINT AS total, warning, critical FROM x LEFT JOIN h ON h.metric = x.metric AND h.label IS NOT DISTINCT FROM x.label LEFT JOIN t ON t.denominator = x.denominator AND t.label IS NOT DISTINCT FROM x.label)
SELECT metric, label, hits, denominator, total, hits::DOUBLE / nullif(total, 0) AS rate, CASE WHEN total = 0 OR warning IS NULL THEN NULL WHEN hits::DOUBLE / total > critical THEN 'critical' WHEN hits::DOUBLE / total > warning THEN 'warning' ELSE 'normal' END AS level FROM y"""


@query(_sql_report())
def o23_report(spark, sf_dir):
    """All sixteen rates with their denominators, labels and levels; of what was not tried the rate is null."""
    e = table(spark, sf_dir, "events")
    one = lambda m, hit, by: e.groupBy(by.cast("string").alias("label")).agg(F.count_if(hit).alias("n")).select(F.lit(m).alias("metric"), "label", "n")
    none = F.lit(None)
    hits = one("late_arriving_rate", F.col("value") > 95, F.col("event_type")).unionByName(one("late_arriving_rate", F.col("value") > 95, none)).unionByName(one("unknown_event_type_rate", F.col("event_type") == "error", none)).unionByName(one("schema_violation_rate", F.col("event_id") % 500 == 0, none))
    totals = one("records_read", F.lit(True), F.col("event_type")).unionByName(one("records_read", F.lit(True), none)).unionByName(one("records_mapped", F.lit(True), none)).unionByName(one("events_validated", F.lit(True), none))
    return checks.report(hits, totals.withColumnRenamed("metric", "total"))


@query("""
SELECT event_id, event_type, CASE WHEN event_id % 50 = 0 THEN 'got' ELSE 'want' END AS side FROM events WHERE event_id % 50 = 0
UNION ALL SELECT event_id, CASE WHEN event_id % 50 = 0 THEN 'other' ELSE event_type END, 'want' FROM events WHERE event_id % 50 = 0
""")
def o26_golden_compare(spark, sf_dir):
    """Rows in which a result differs from the frozen one."""
    got = table(spark, sf_dir, "events").select("event_id", "event_type")
    want = got.withColumn("event_type", F.when(F.col("event_id") % 50 == 0, "other").otherwise(F.col("event_type")))
    return checks.differences(got, want)


@query("""
WITH l AS (SELECT row_number() OVER (ORDER BY user_id, event_id) - 1 AS no, user_id || '|' || event_id || '|' || event_type || '|' || props AS line FROM events),
a AS (SELECT no // 1000 AS no, sha256(string_agg(sha256(line), '' ORDER BY no)) AS sha256 FROM l GROUP BY no // 1000),
b AS (SELECT no // 1000 AS no, sha256(string_agg(sha256, '' ORDER BY no)) AS sha256 FROM a GROUP BY no // 1000),
c AS (SELECT no // 1000 AS no, sha256(string_agg(sha256, '' ORDER BY no)) AS sha256 FROM b GROUP BY no // 1000)
SELECT 1 AS level, no::BIGINT AS no, sha256 FROM a UNION ALL SELECT 2, no::BIGINT, sha256 FROM b WHERE (SELECT count(*) FROM a) > 1 UNION ALL SELECT 3, no::BIGINT, sha256 FROM c WHERE (SELECT count(*) FROM b) > 1
""")
def o26_golden_bytes(spark, sf_dir):
    """The hash tree over the events as lines in order: what a byte-exact golden result keeps."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "props")
    return blocks.text(e, ["user_id", "event_id"], F.concat_ws("|", F.col("user_id").cast("string"), F.col("event_id").cast("string"), "event_type", "props")).tree


@query(f"""
SELECT 'read' AS stage, user_id AS client, count(*)::BIGINT AS n FROM events WHERE user_id IN (3, 5) GROUP BY ALL
UNION ALL SELECT 'cutoff', user_id, count(*) FROM events WHERE user_id IN (3, 5) AND ts <= TIMESTAMP '{CUT}' GROUP BY ALL
""")
def o27_trace(spark, sf_dir):
    """Rows of chosen clients at each stage, counted."""
    e = table(spark, sf_dir, "events")
    rows = checks.trace({"read": e, "cutoff": timestamps.up_to(e, CUT)}, [3, 5], "user_id")
    return rows.groupBy("stage", "client").agg(F.count("row").alias("n"))


@query(ORACLES["o18_timeline"])
def o28_partition_invariance(spark, sf_dir):
    """The timeline from an input dealt otherwise: the same rows."""
    return timeline.order_timeline(_events(spark, sf_dir).repartition(13, "event_id")).select("client_id", "event_id", "position", "ordering_key", "tied")


# --- T01-T11 tokens --------------------------------------------------------------------------------------------------

PRUNED, MIN = ["amount", "k"], 20
_ALWAYS = ["key:event_type", "key:amount", "key:k", *(f"value:event_type:{t}" for t in ("CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW"))]
_EDGES = (60, 3600, 21600, 86400)


def _tokens(spark, sf_dir) -> DataFrame:
    """Each event as tokens: its type, a hundredth of its value (a number of its own for some), its screen; ``train`` up to the cutoff."""
    amount = F.when(F.col("event_id") % 53 == 0, F.concat(F.lit("x"), F.col("event_id").cast("string"))).when(F.col("event_id") % 59 == 0, None).otherwise(F.concat(F.lit("v"), F.floor(F.col("value")).cast("string")))
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("client_id"), "event_id", "ts", F.upper("event_type").alias("event_type"), amount.alias("amount"), F.regexp_extract("props", "[0-9]+", 0).alias("k"))
    e = e.withColumn("position", (F.row_number().over(Window.partitionBy("client_id").orderBy("ts", "event_id")) - 1).cast("long"))
    return e.withColumn("train", F.col("ts") <= F.lit(CUT).cast("timestamp_ntz")).withColumn("tokens", tokens.sequence("[EVT]", {"amount": False, "k": False}, "event_type"))


_SQL_TOKENS = f"""ev AS (SELECT user_id AS client_id, event_id, ts, ts <= TIMESTAMP '{CUT}' AS train, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS position,
   ['[EVT]', 'key:event_type', 'value:event_type:' || upper(event_type), 'key:amount', 'value:amount:' || CASE WHEN event_id % 53 = 0 THEN 'x' || event_id WHEN event_id % 59 = 0 THEN 'MISSING' ELSE 'v' || floor(value)::BIGINT END, 'key:k', 'value:k:' || regexp_extract(props, '[0-9]+', 0)] AS tokens FROM events),
tk AS (SELECT client_id, event_id, train, generate_subscripts(tokens, 1) - 1 AS pos, unnest(tokens) AS token FROM ev)"""


def _sql_vocab(always: list[str]) -> str:
    fixed = " ".join(f"UNION SELECT '{t}', {1 if t.startswith('key:') else 2}" for t in always)
    return f"""{_SQL_TOKENS}, n AS (SELECT token, count(*) AS n FROM tk WHERE train AND (token LIKE 'value:amount:%' OR token LIKE 'value:k:%') GROUP BY token),
k AS (SELECT token, CASE WHEN n >= {MIN} OR token LIKE '%:MISSING' THEN 3 ELSE 5 END AS block FROM n {fixed}
      UNION SELECT 'value:amount:MISSING', 3 UNION SELECT 'value:k:MISSING', 3 UNION SELECT 'value:amount:RARE', 4 UNION SELECT 'value:k:RARE', 4),
vo AS (SELECT unnest({tokens.SPECIAL}) AS token, 0 AS block, unnest(range(5)) AS id UNION ALL SELECT token, block, CASE WHEN block < 5 THEN row_number() OVER (ORDER BY block, token) + 4 END FROM k)"""


_SQL_VOCAB = _sql_vocab(_ALWAYS)


def _sql_encoded(vocab: str) -> str:
    return f"""{vocab}, en AS (SELECT tk.*, CASE WHEN a.id IS NOT NULL THEN 'known' WHEN a.block = 5 THEN 'rare' WHEN split_part(tk.token, ':', 2) IN ('amount', 'k') AND tk.token LIKE 'value:%' THEN 'unk' ELSE 'violation' END AS fate,
   CASE WHEN a.id IS NOT NULL THEN a.id WHEN a.block = 5 THEN b.id WHEN split_part(tk.token, ':', 2) IN ('amount', 'k') AND tk.token LIKE 'value:%' THEN 1 END AS id
   FROM tk LEFT JOIN vo a ON tk.token = a.token LEFT JOIN vo b ON b.token = 'value:' || split_part(tk.token, ':', 2) || ':RARE')"""


_SQL_ENCODED = _sql_encoded(_SQL_VOCAB)


@query("""
SELECT c_custkey, array_to_string(['[USR]', 'key:segment', 'value:segment:' || c_mktsegment, 'key:nation', 'value:nation:' || c_nationkey], ' ') AS tokens FROM customer
""")
def t01_profile_tokens(spark, sf_dir):
    """A client's profile as tokens."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"))
    return c.select("c_custkey", F.array_join(tokens.sequence("[USR]", {"segment": False, "nation": False}), " ").alias("tokens"))


@query(f"""
WITH b AS (SELECT 4 * event_id AS line, 'E' || event_id AS record, user_id AS client_id, ts, event_type, value, 1 AS version, event_id FROM events),
l AS (SELECT * FROM b UNION ALL SELECT * REPLACE (line + 1 AS line) FROM b WHERE event_id % 7 = 0 UNION ALL SELECT * REPLACE (line + 2 AS line, record || '-b' AS record) FROM b WHERE event_id % 11 = 0
      UNION ALL SELECT * REPLACE (line + 3 AS line, value + 1 AS value, 2 AS version) FROM b WHERE event_id % 13 = 0),
w AS (SELECT *, first_value(line) OVER (PARTITION BY record ORDER BY version DESC, line) AS stays FROM l WHERE ts <= TIMESTAMP '{CUT}'),
s AS (SELECT *, first_value(line) OVER (PARTITION BY client_id, ts, value ORDER BY record) AS one FROM w WHERE line = stays),
f AS (SELECT line, CASE WHEN line <> one THEN 'same_fact' WHEN event_type = 'error' THEN 'rejected' ELSE 'event' END AS fate, CASE WHEN line = one AND event_type = 'error' THEN 'unknown_event_type' END AS reason,
             CASE WHEN line <> one THEN 'p#' || one END AS superseded_by, CASE WHEN line = one AND event_type <> 'error' THEN substr({_sql_digest("'app'", "record", "upper(event_type)", "epoch_us(ts)::VARCHAR")}, 1, 32) END AS event_id FROM s)
SELECT line AS line_number, 'cut' AS fate, NULL AS reason, NULL AS superseded_by, NULL AS event_id FROM l WHERE ts > TIMESTAMP '{CUT}'
UNION ALL SELECT line, 'version', NULL, 'p#' || stays, NULL FROM w WHERE line <> stays UNION ALL SELECT * FROM f
""")
def o27_ledger(spark, sf_dir):
    """What became of every line: of copies, newer versions, refiled facts, records after the cutoff and of unknown types."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    base = e.select(F.lit("p").alias("partition"), (F.col("event_id") * 4).alias("line_number"), F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("record"), F.col("user_id").alias("client_id"), "ts", "event_type", "value", F.lit(1).alias("version"), "event_id")
    again = lambda n: base.where(F.col("event_id") % n == 0)
    read = base.unionByName(again(7).withColumn("line_number", F.col("line_number") + 1)).unionByName(again(11).withColumns({"line_number": F.col("line_number") + 2, "record": F.concat("record", F.lit("-b"))}))
    read = read.unionByName(again(13).withColumns({"line_number": F.col("line_number") + 3, "value": F.col("value") + 1, "version": F.lit(2)})).drop("event_id")
    within = timestamps.up_to(read, CUT)
    single, conflicts = dedup.exact(within, ["record"], F.struct("client_id", "ts", "event_type", "value"), ["partition", "line_number"], "version")
    fact = ["client_id", "ts", "value"]
    facts = dedup.business(single.withColumn("source", F.lit("app")), fact, record_id="record")
    mapped, unknown = identity.map_events(facts, {t: t.upper() for t in ("view", "click", "purchase", "signup")}, "event_type")
    kept = mapped.select("partition", "line_number", F.lit("event").alias("fate"), hashing.event_id(F.lit("app"), F.col("record"), F.col("event_type"), F.col("ts")).alias("event_id"))
    line = ["partition", "line_number"]
    rejects = unknown.select(*line, "reason").unionByName(conflicts.select(*line, "reason"))
    after = read.where(F.col("ts") > F.lit(CUT).cast("timestamp_ntz"))
    return checks.ledger(read, line, rejects, after, [("version", within, single, ["record"]), ("same_fact", single, facts, fact)], kept).drop("partition")


@query(f"WITH {_SQL_TOKENS} SELECT event_id, array_to_string(tokens, ' ') AS tokens FROM ev")
def t02_event_tokens(spark, sf_dir):
    """Events as tokens."""
    return _tokens(spark, sf_dir).select("event_id", F.array_join("tokens", " ").alias("tokens"))


def _vocab(spark, sf_dir, always=tuple(_ALWAYS)) -> DataFrame:
    return tokens.vocabulary(_tokens(spark, sf_dir).where("train"), PRUNED, list(always), MIN)


def _encoded(spark, sf_dir, vocab: DataFrame) -> DataFrame:
    return tokens.encode(_tokens(spark, sf_dir), vocab, PRUNED, ["event_id"])


@query(f"WITH {_SQL_VOCAB} SELECT token, block::INTEGER AS block, id::BIGINT AS id FROM vo")
def t03_vocabulary(spark, sf_dir):
    """The vocabulary of the training events with canonical ids: all closed values, frequent open ones; rare ones without an id."""
    return _vocab(spark, sf_dir).select("token", "block", "id")


@query(f"WITH {_SQL_ENCODED} SELECT event_id, pos::BIGINT AS pos, id::BIGINT AS id, fate FROM en")
def t05_encode(spark, sf_dir):
    """Token ids of all events: open values that were rare are RARE, those that are new UNK."""
    return _encoded(spark, sf_dir, _vocab(spark, sf_dir)).select("event_id", "pos", "id", "fate")


@query("""
WITH e AS (SELECT event_id, upper(event_type) AS t, regexp_extract(props, '[0-9]+', 0) AS k, (event_id % 6 + 1)::INT AS n, (event_id % 3 + 1)::INT AS m, unnest([12, 9, 6]) AS most FROM events),
a AS (SELECT *, greatest(0, 9 + n + m - most) AS over0 FROM e),
b AS (SELECT *, least(m - 1, over0) AS cut_m FROM a), c AS (SELECT *, least(n - 1, over0 - cut_m) AS cut_n FROM b),
d AS (SELECT *, over0 - cut_m - cut_n AS over1 FROM c), f AS (SELECT *, over1 > 0 AS no_m, over1 - CASE WHEN over1 > 0 THEN 1 + m - cut_m ELSE 0 END AS over2 FROM d),
g AS (SELECT *, over2 > 0 AS no_k, over2 - CASE WHEN over2 > 0 THEN 2 ELSE 0 END AS over3 FROM f), h AS (SELECT *, over3 > 0 AS no_n FROM g)
SELECT event_id, most::INTEGER AS most, array_to_string(['[EVT]', 'key:event_type', 'value:event_type:' || t, 'key:odd', 'value:odd:' || (event_id % 2)]
  || CASE WHEN no_n THEN [] ELSE ['key:screens'] || list_transform(range(n - cut_n), lambda i: 'value:screens:s' || i) END
  || CASE WHEN no_k THEN [] ELSE ['key:k', 'value:k:' || k] END
  || CASE WHEN no_m THEN [] ELSE ['key:tags'] || list_transform(range(m - cut_m), lambda i: 'value:tags:t' || i) END, ' ') AS tokens FROM h
""")
def t06_event_limit(spark, sf_dir):
    """Events within 12, 9 and 6 tokens: lists are cut first, then the least important fields go; two fields are required."""
    names = lambda p, n: F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.concat(F.lit(p), i.cast("string")))
    n, m = (F.col("event_id") % 6 + 1).cast("int"), (F.col("event_id") % 3 + 1).cast("int")
    e = table(spark, sf_dir, "events").select("event_id", F.upper("event_type").alias("event_type"), (F.col("event_id") % 2).alias("odd"), names("s", n).alias("screens"), F.regexp_extract("props", "[0-9]+", 0).alias("k"), names("t", m).alias("tags"))
    slots = [tokens.Slot("event_type", required=True), tokens.Slot("odd", required=True), tokens.Slot("screens", multivalue=True), tokens.Slot("k"), tokens.Slot("tags", multivalue=True)]
    out = F.array(*[F.struct(F.lit(most).alias("most"), F.array_join(tokens.limited(slots, most), " ").alias("tokens")) for most in (12, 9, 6)])
    return e.select("event_id", F.explode(out).alias("x")).select("event_id", "x.most", "x.tokens")


_SQL_WINDOW = f"{_SQL_TOKENS}, w AS (SELECT *, sum(len(tokens)) OVER (PARTITION BY client_id ORDER BY position DESC) AS s FROM ev), kept AS (SELECT * FROM w WHERE s <= 100)"


def _window(events: DataFrame) -> DataFrame:
    return tokens.window(events.withColumn("n_tokens", F.size("tokens")), 100)


@query(f"WITH {_SQL_WINDOW} SELECT client_id, event_id, position FROM kept")
def t07_window(spark, sf_dir):
    """The latest whole events of each client within 100 tokens."""
    return _window(_tokens(spark, sf_dir)).select("client_id", "event_id", "position")


@query(f"""WITH {_SQL_WINDOW}, d AS (SELECT *, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY client_id ORDER BY position))) // 1000000 AS gap FROM kept)
SELECT event_id, gap::BIGINT AS delta_seconds, CASE WHEN gap IS NOT NULL THEN 'bucket_' || len(list_filter({list(_EDGES)}, lambda e: e <= gap)) WHEN position = 0 THEN 'FIRST_EVENT' ELSE 'WINDOW_START' END AS delta FROM d""")
def t08_window_deltas(spark, sf_dir):
    """Deltas after the cut to a window, in their frozen buckets."""
    from decimal import Decimal

    return tokens.deltas_after(_window(_tokens(spark, sf_dir)), buckets.Edges(tuple(Decimal(e) for e in _EDGES))).select("event_id", "delta_seconds", "delta")


@query(f"""WITH {_SQL_ENCODED}, i AS (SELECT event_id, list(id ORDER BY pos) AS ids FROM en GROUP BY event_id)
SELECT event_id, array_to_string(ids || [0, 0, 0], ',') AS ids, '1,1,1,1,1,1,1,0,0,0' AS mask FROM i""")
def t09_padding(spark, sf_dir):
    """Id lists padded to ten, and their attention masks."""
    ids = _encoded(spark, sf_dir, _vocab(spark, sf_dir)).groupBy("event_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "id"))), lambda x: x["id"]).alias("ids"))
    full, mask = tokens.padded(F.col("ids"), 10)
    return ids.select("event_id", F.array_join(full, ",").alias("ids"), F.array_join(mask, ",").alias("mask"))


def _sql_unit(salt: str) -> str:
    return f"({_sql_priority(f"'{salt}' || event_id || '|' || pos", SEED)}::DOUBLE / 18446744073709551616.0)"


@query(f"""WITH {_SQL_ENCODED}, p AS (SELECT split_part(token, ':', 2) AS f, list(id ORDER BY id) AS pool FROM vo WHERE token LIKE 'value:%' AND id IS NOT NULL AND token NOT LIKE '%:MISSING' GROUP BY 1),
c AS (SELECT en.*, pool, CASE WHEN token LIKE 'value:%' AND token NOT LIKE 'value:event_type:%' AND fate <> 'unk' AND {_sql_unit('pick')} < 0.15 THEN
  CASE WHEN {_sql_unit('kind')} < 0.8 THEN 'mask' WHEN {_sql_unit('kind')} < 0.9 THEN 'random' ELSE 'same' END ELSE 'keep' END AS action FROM en LEFT JOIN p ON token LIKE 'value:%' AND f = split_part(token, ':', 2))
SELECT event_id, pos::BIGINT AS pos, action, CASE action WHEN 'mask' THEN 2 WHEN 'random' THEN pool[floor({_sql_unit('swap')} * len(pool))::INT + 1] ELSE id END::BIGINT AS masked_id, CASE WHEN action <> 'keep' THEN id END::BIGINT AS label FROM c""")
def t10_masking(spark, sf_dir):
    """Masked ids and labels, by hash and never by chance."""
    v = _vocab(spark, sf_dir)
    return tokens.masked(_encoded(spark, sf_dir, v), v, F.col("event_id").cast("string"), SEED).select("event_id", "pos", "action", "masked_id", "label")


@query(f"""WITH {_SQL_ENCODED} SELECT event_id, string_agg(vo.token, ' ' ORDER BY pos) AS tokens FROM en JOIN vo ON en.id = vo.id GROUP BY event_id""")
def t11_decode(spark, sf_dir):
    """Ids back as tokens."""
    v = _vocab(spark, sf_dir)
    return tokens.decode(_encoded(spark, sf_dir, v), v, ["event_id"]).select("event_id", F.array_join("tokens", " ").alias("tokens"))


_LESS = [t for t in _ALWAYS if not t.endswith("ERROR")]


@query(f"""WITH {_sql_encoded(_sql_vocab(_LESS))}, w AS (SELECT *, sum(len(tokens)) OVER (PARTITION BY client_id ORDER BY position DESC) AS s FROM ev),
c AS (SELECT client_id, count(*) AS a, count(*) FILTER (s <= 100) AS k, coalesce(sum(len(tokens)) FILTER (s <= 100), 0) AS n FROM w GROUP BY client_id),
o AS (SELECT split_part(token, ':', 2) AS label, count(*) AS total, count(*) FILTER (fate = 'unk') AS unk, count(*) FILTER (fate = 'rare') AS rare FROM en WHERE token LIKE 'value:amount:%' OR token LIKE 'value:k:%' GROUP BY 1),
m AS (SELECT 'unk_rate' AS metric, label, unk AS hits, total FROM o UNION ALL SELECT 'rare_rate', label, rare, total FROM o
  UNION ALL SELECT 'closed_set_violation_rate', '', count(*) FILTER (fate = 'violation'), count(*) FROM en WHERE NOT (token LIKE 'value:amount:%' OR token LIKE 'value:k:%')
  UNION ALL SELECT 'truncation_rate', '', count(*) FILTER (k < a), count(*) FROM c UNION ALL SELECT 'window_start_rate', '', count(*) FILTER (k < a AND k > 0), count(*) FILTER (k > 0) FROM c
  UNION ALL SELECT 'pad_ratio', '', sum(greatest(0, 100 - n)), count(*) * 100 FROM c)
SELECT metric, label, hits::BIGINT AS hits, total::BIGINT AS total, hits::DOUBLE / total AS rate, CASE metric WHEN 'unk_rate' THEN CASE WHEN hits / total > 0.05 THEN 'critical' WHEN hits / total > 0.01 THEN 'warning' ELSE 'normal' END
  WHEN 'closed_set_violation_rate' THEN CASE WHEN hits > 0 THEN 'critical' ELSE 'normal' END WHEN 'truncation_rate' THEN CASE WHEN hits / total > 0.5 THEN 'critical' WHEN hits / total > 0.2 THEN 'warning' ELSE 'normal' END
  WHEN 'pad_ratio' THEN CASE WHEN hits / total > 0.6 THEN 'critical' WHEN hits / total > 0.3 THEN 'warning' ELSE 'normal' END END AS level FROM m""")
def t11_monitoring(spark, sf_dir):
    """Rates of the token stage, with a type that is outside its domain."""
    events = _tokens(spark, sf_dir)
    encoded = tokens.encode(events, _vocab(spark, sf_dir, _LESS), PRUNED, ["event_id"], strict=False)
    kept = _window(events).groupBy("client_id").agg(F.count("*").alias("kept"), F.sum("n_tokens").alias("n"))
    clients = events.groupBy("client_id").agg(F.count("*").alias("all_events")).join(kept, "client_id", "left")
    windows = clients.select("client_id", "all_events", F.coalesce("kept", F.lit(0)).alias("kept_events"), F.coalesce("n", F.lit(0)).alias("n_ids"))
    return tokens.monitoring(encoded, PRUNED, windows, 100)


#: Profiles beside the events, and the vocabulary of both.
_SEQ_ALWAYS = [*_ALWAYS, "key:segment", "key:nation", *(f"value:segment:{v}" for v in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "MISSING"))]
_SEQ_FIXED = " ".join(f"UNION SELECT '{t}', {1 if t.startswith('key:') else 2}" for t in _SEQ_ALWAYS)
_SEQ_OPEN = ("amount", "k", "nation")
_SQL_SEQUENCES = f"""{_SQL_TOKENS}, pf AS (SELECT c_custkey AS client_id, ['[USR]', 'key:segment', 'value:segment:' || c_mktsegment, 'key:nation', 'value:nation:' || c_nationkey] AS tokens FROM customer),
n AS (SELECT token, count(*) AS n FROM (SELECT token FROM tk WHERE train UNION ALL SELECT unnest(tokens) FROM pf) WHERE token LIKE 'value:%' AND split_part(token, ':', 2) IN {_SEQ_OPEN} GROUP BY token),
k AS (SELECT token, CASE WHEN n >= {MIN} OR token LIKE '%:MISSING' THEN 3 ELSE 5 END AS block FROM n {_SEQ_FIXED}
      {" ".join(f"UNION SELECT 'value:{f}:MISSING', 3 UNION SELECT 'value:{f}:RARE', 4" for f in _SEQ_OPEN)}),
vo AS (SELECT unnest({tokens.SPECIAL}) AS token, 0 AS block, unnest(range(5)) AS id UNION ALL SELECT token, block, CASE WHEN block < 5 THEN row_number() OVER (ORDER BY block, token) + 4 END FROM k),
id AS (SELECT a.token, coalesce(a.id, b.id) AS id FROM vo a LEFT JOIN vo b ON b.token = 'value:' || split_part(a.token, ':', 2) || ':RARE'),
ei AS (SELECT event_id, list(coalesce(id.id, 1) ORDER BY pos) AS ids FROM tk LEFT JOIN id USING (token) GROUP BY event_id),
pt AS (SELECT client_id, generate_subscripts(tokens, 1) AS pos, unnest(tokens) AS token FROM pf), pi AS (SELECT client_id, list(id.id ORDER BY pos) AS ids FROM pt LEFT JOIN id USING (token) GROUP BY client_id),
e AS (SELECT ev.client_id, event_id, ts, position, ei.ids, sum(len(ei.ids)) OVER (PARTITION BY ev.client_id ORDER BY position DESC) + coalesce(len(pi.ids), 1) AS s FROM ev JOIN ei USING (event_id) LEFT JOIN pi ON pi.client_id = ev.client_id),
w AS (SELECT *, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY client_id ORDER BY position))) // 1000000 AS gap FROM e WHERE s <= 100),
d AS (SELECT *, CASE WHEN gap IS NOT NULL THEN 'bucket_' || len(list_filter({list(_EDGES)}, lambda x: x <= gap)) WHEN position = 0 THEN 'FIRST_EVENT' ELSE 'WINDOW_START' END AS delta FROM w),
g AS (SELECT client_id, count(*) AS n_events, flatten(list(ids ORDER BY position)) AS ids, string_agg(delta, ',' ORDER BY position) AS deltas FROM d GROUP BY client_id),
a AS (SELECT client_id, count(*) AS all_events FROM ev GROUP BY client_id),
o AS (SELECT coalesce(a.client_id, pi.client_id) AS client_id, coalesce(n_events, 0) AS n_events, coalesce(all_events, 0) AS all_events, coalesce(pi.ids, [4]) || coalesce(g.ids, []) AS ids, coalesce(deltas, '') AS deltas
      FROM a FULL JOIN pi ON a.client_id = pi.client_id LEFT JOIN g ON g.client_id = a.client_id)"""


def _sequences(spark, sf_dir) -> DataFrame:
    from . import tokenizer as tz

    e = _tokens(spark, sf_dir).withColumn("fields", F.to_json(F.struct("amount", F.col("k")), {"ignoreNullFields": "true"}))
    e = e.select("client_id", "event_id", "event_type", "position", "ts", F.hour("ts").cast("long").alias("hour_of_day_local"), F.weekday("ts").cast("long").alias("day_of_week_local"), (F.col("position") == 0).alias("lifetime_first"), "fields", "train")
    p = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("client_id"), F.to_json(F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").cast("string").alias("nation"))).alias("fields"))
    layout = tz.Layout({t: ("amount", "k") for t in _TYPES[:-1] + ["ERROR"]}, ("segment", "nation"), {"segment": ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")}, _SEQ_OPEN, tuple(str(x) for x in _EDGES), min_count=MIN, sequence_limit=100)
    frozen = tz.fit(tz.Prepared(e.where("train").drop("train"), p, "0" * 64), layout)
    return tz.encode(tz.Prepared(e.drop("train"), p, "0" * 64), frozen, pad_to=100)


@query(f"""WITH {_SQL_SEQUENCES}
SELECT client_id, n_events::BIGINT AS n_events, all_events::BIGINT AS all_events, len(ids)::BIGINT AS n_ids, array_to_string(ids || list_transform(range(100 - len(ids)), lambda x: 0), ',') AS input_ids,
       array_to_string(list_transform(range(100), lambda x: CASE WHEN x < len(ids) THEN 1 ELSE 0 END), ',') AS attention_mask, deltas FROM o""")
def t12_client_sequences(spark, sf_dir):
    """Whole clients as model input: a vocabulary fitted on the training rows, profile and latest events within 100 ids, deltas of the window, padding, mask."""
    s = _sequences(spark, sf_dir)
    return s.select("client_id", "n_events", "all_events", "n_ids", F.array_join("input_ids", ",").alias("input_ids"), F.array_join("attention_mask", ",").alias("attention_mask"), F.array_join("delta", ",").alias("deltas"))


# --- flagship --------------------------------------------------------------------------------------------------------


@query(f"""
WITH m AS (SELECT user_id AS client_id, event_id AS record, ts, {_SQL_TYPE} AS event_type FROM events WHERE ts <= TIMESTAMP '{CUT}' AND event_type IN ('purchase', 'signup')),
t AS (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY ts, record::VARCHAR) - 1 AS position, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'Asia/Almaty' AS local FROM m)
SELECT client_id, substr({_sql_digest("'app'", "record::VARCHAR", "event_type", "epoch_us(ts)::VARCHAR")}, 1, 32) AS event_id, event_type, {STAMP.format('ts')} || '|000030|' || record AS ordering_key, position,
       hour(local)::BIGINT AS hour_of_day_local, (isodow(local) - 1)::BIGINT AS day_of_week_local, position = 0 AS lifetime_first FROM t
""")
def prepared_timeline(spark, sf_dir):
    """Events up to the cutoff as a prepared timeline: ids, order, local calendar."""
    rows = timestamps.up_to(table(spark, sf_dir, "events"), CUT).select(F.col("user_id").alias("client_id"), F.col("event_id").cast("string").alias("source_record_id"), "ts", "event_type", F.lit(30).alias("source_priority"), F.lit("Asia/Almaty").alias("calendar_zone"))
    typed = identity.map_events(rows, CODES, "event_type")[0].where("event_type is not null")
    typed = typed.withColumn("event_id", hashing.event_id(F.lit("app"), F.col("source_record_id"), F.col("event_type"), F.col("ts")))
    return timeline.calendar(timeline.order_timeline(typed)).select("client_id", "event_id", "event_type", "ordering_key", "position", "hour_of_day_local", "day_of_week_local", "lifetime_first")


# --- frozen state, sinks, generated data -----------------------------------------------------------


@query(f"""
WITH {_SQL_EDGES}, e AS (SELECT field, value, row_number() OVER (PARTITION BY field ORDER BY value) AS i FROM d),
j AS (SELECT field, '[' || string_agg('"' || value || '.00000000"', ',' ORDER BY i) || ']' AS edges, '[' || string_agg('"bucket_' || (i - 1) || '"', ',' ORDER BY i) || ',"bucket_' || count(*) || '","MISSING"]' AS labels FROM e GROUP BY field),
x AS (SELECT '{{' || string_agg('"' || field || '":' || edges, ',' ORDER BY field) || '}}' AS edges, '{{' || string_agg('"' || field || '":' || labels, ',' ORDER BY field) || '}}' AS labels FROM j)
SELECT unnest(['bucket_edges', 'bucket_field_domains']) AS section, unnest([length(edges), length(labels)])::BIGINT AS n_chars, unnest([sha256(edges), sha256(labels)]) AS sha256 FROM x
""")
def o24_state_hash(spark, sf_dir):
    """Sections of the state that the tables decide, by length and hash of their canonical text."""
    import hashlib

    from . import documents
    from .config import DEFAULT
    from .preparation import Artifacts

    values = _values(spark, sf_dir).withColumn("value", F.col("value").cast("decimal(38,8)"))
    built = Artifacts(DEFAULT, {}, buckets.fit(values, {f: ("quantile", 16) for f in "ANR"}, SAMPLE, SEED), buckets.Edges(()))
    texts = {n: documents.canonical(built.document()[n]) for n in ("bucket_edges", "bucket_field_domains")}
    return spark.createDataFrame([(n, len(t), hashlib.sha256(t.encode()).hexdigest()) for n, t in texts.items()], "section string, n_chars long, sha256 string")


@query(f"SELECT client_id, event_id, event_type, ordering_key, hour_of_day_local, day_of_week_local, lifetime_first, '{{\"k\":\"' || k || '\"}}' AS fields FROM ({ORACLES['prepared_timeline']}) JOIN (SELECT event_id::VARCHAR AS record, regexp_extract(props, '[0-9]+', 0) AS k FROM events) ON record = split_part(ordering_key, '|', 3)")
def o25_output_sink(spark, sf_dir):
    """The prepared timeline published by the writer of outputs, and the version that readers are shown read back after its parts were verified."""
    from ..sources import storage
    from .preparation import Encoded

    k = table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("record"), "ts", F.to_json(F.struct(F.regexp_extract("props", "[0-9]+", 0).alias("k"))).alias("fields"))
    events = prepared_timeline(spark, sf_dir).withColumn("record", F.split_part("ordering_key", F.lit("|"), F.lit(3))).join(k, "record").withColumn("calendar_zone", F.lit("Asia/Almaty"))
    prof = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("client_id"), F.lit(CUT).cast("timestamp_ntz").alias("profile_ts"), F.to_json(F.struct("c_mktsegment")).alias("fields"))
    letters = events.limit(0).select(F.lit("app").alias("source"), F.col("record").alias("raw_reference"), F.lit("").alias("reason"))
    rates = events.groupBy("event_type").agg(F.count("*").alias("hits")).select(F.col("event_type").alias("metric"), "hits")
    path = f"{storage.shared_dir(spark)}/published-{storage.uuid.uuid4().hex}"
    storage.publish(Encoded(events, prof, letters, rates), path)
    lines = spark.read.schema("client_id long, event_id string, event_type string, ordering_key string, calendar_time_features struct<hour_of_day_local:long,day_of_week_local:long>, lifetime_first boolean, fields string")
    got = lines.json(f"{storage.current(spark, path, verify=True)}/prepared_events")
    return got.select("client_id", "event_id", "event_type", "ordering_key", "calendar_time_features.*", "lifetime_first", "fields")


def _sql_generated() -> str:
    from .generate import DEFECTS

    found = ", ".join(f"CASE WHEN event_id % {n} = 0 THEN '{d}' END" for d, n in DEFECTS.items())
    return f"""
WITH a AS (SELECT *, list_filter([{found}], lambda x: x IS NOT NULL) AS d, round(value * 100)::BIGINT AS cents FROM events),
b AS (SELECT *, CASE WHEN 'null_given' IN d THEN NULL WHEN 'no_number' IN d THEN 'abc' WHEN 'nan_text' IN d THEN 'NaN' WHEN 'below_training' IN d THEN '0,01' WHEN 'above_training' IN d THEN '5 000 000 000,00' ELSE (cents // 100) || ',' || lpad((cents % 100)::VARCHAR, 2, '0') END AS amount,
  'G-' || lpad(event_id::VARCHAR, 8, '0') AS rid, 1 AS version FROM a),
c AS (SELECT * FROM b UNION ALL SELECT * FROM b WHERE 'sent_twice' IN d UNION ALL SELECT * REPLACE (rid || '-b' AS rid) FROM b WHERE 'same_fact' IN d UNION ALL SELECT * REPLACE ('1,00' AS amount, 2 AS version) FROM b WHERE 'two_versions' IN d)
SELECT rid AS source_record_id, array_to_string(d, ',') AS defects, '{{"source_record_id":"' || rid || '","client_ref":"' || lpad(user_id::VARCHAR, 6, '0') || '","branch_region":"ALMATY","operation_time":"'
  || strftime(CASE WHEN 'years_ahead' IN d THEN ts + INTERVAL 4 YEAR ELSE ts END, '%d.%m.%Y %H:%M') || '","op_code":"' || CASE WHEN 'code_unknown' IN d THEN 'XYZ' ELSE 'TRF' END || '"' || coalesce(',"amount":"' || amount || '"', '')
  || ',"currency":"' || CASE WHEN 'foreign_money' IN d THEN '840' ELSE 'KZT' END || '"' || CASE WHEN 'key_left_out' IN d THEN '' WHEN 'dash_or_na' IN d THEN ',"direction":"N/A"' ELSE ',"direction":"IN"' END
  || ',"counterparty_ref":"KZ' || lpad(event_id::VARCHAR, 12, '0') || '","payload_version":' || version || ',"loaded_at":"' || strftime(ts + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%SZ') || '"' || CASE WHEN amount IS NULL THEN ',"amount":null' ELSE '' END || '}}' AS payload FROM c"""


@query(_sql_generated())
def o29_generated(spark, sf_dir):
    """Raw records with defects made from the events by rule: the same for the same tables, in any partitioning."""
    from . import generate

    return generate.payments(table(spark, sf_dir, "events"))


@query("SELECT time_bucket(INTERVAL 6 HOUR, ts) AS begins, event_type, count(*)::BIGINT AS n FROM events GROUP BY ALL")
def s01_stream_windows(spark, sf_dir):
    """Events read as a stream and counted in windows of six hours; the state after all of them."""
    from ..sources import storage
    from ..streaming import stream

    path = f"{storage.shared_dir(spark)}/stream-{storage.uuid.uuid4().hex}"
    # the zone is written out, so that the session's does not matter
    rows = table(spark, sf_dir, "events").select("ts", "event_type")
    rows.write.parquet(f"{path}/in")  # a stream reads a folder; the table may be one file
    events = spark.readStream.schema(rows.schema).parquet(f"{path}/in").select("event_type", F.to_timestamp(F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("Z")), "yyyy-MM-dd HH:mm:ss.SSSSSSX").alias("ts"))
    counted = stream.counts(events, "1 hour", "6 hours", ["event_type"])
    rows = counted.select(F.timestamp_seconds(F.unix_seconds("window.start")).alias("begins"), "event_type", "n")

    def keep(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/rows")

    rows.writeStream.outputMode("complete").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return spark.read.schema(rows.schema).parquet(f"{path}/rows").select(F.timestamp_add("SECOND", F.unix_seconds("begins").cast("int"), epoch).alias("begins"), "event_type", "n")


@query("""
WITH a AS (SELECT user_id::VARCHAR AS client_id, event_id, ts, event_type, CASE WHEN event_id % 10 = 0 THEN value + 1 ELSE value END AS value FROM events),
b AS (SELECT *, lag(ts) OVER w AS before FROM a WHERE event_type IN ('view', 'click', 'signup') WINDOW w AS (PARTITION BY client_id ORDER BY ts, event_id::VARCHAR)),
s AS (SELECT *, sum(CASE WHEN before IS NULL OR event_type = 'signup' OR epoch_us(ts) - epoch_us(before) > 21600000000 THEN 1 ELSE 0 END) OVER (PARTITION BY client_id ORDER BY ts, event_id::VARCHAR) AS no FROM b),
e AS (SELECT client_id, min((ts, event_id::VARCHAR))[2] AS record, min(ts) AS ts, 'APP_SESSION' AS event_type, NULL::DOUBLE AS value, ((max(epoch_us(ts)) - min(epoch_us(ts))) // 1000000)::BIGINT AS duration_seconds, count(*)::BIGINT AS n_actions FROM s GROUP BY client_id, no
      UNION ALL SELECT client_id, event_id::VARCHAR, ts, upper(event_type), value, NULL, NULL FROM a WHERE event_type NOT IN ('view', 'click', 'signup'))
SELECT client_id, record, event_type, value, row_number() OVER w - 1 AS position, (epoch_us(ts) - epoch_us(lag(ts) OVER w)) // 1000000 AS delta_seconds, duration_seconds, n_actions
FROM e WINDOW w AS (PARTITION BY client_id ORDER BY ts, record)
""")
def s02_stream_timeline(spark, sf_dir):
    """Clients' timelines by a stream in four micro-batches: copies in two versions, sessions, positions, deltas, as the batch plan has them."""
    from ..sources import storage
    from ..streaming import timeline as streamed

    path = f"{storage.shared_dir(spark)}/stream-{storage.uuid.uuid4().hex}"
    act = F.col("event_type").isin("view", "click", "signup")
    e = table(spark, sf_dir, "events")
    rows = e.select(
        F.col("user_id").cast("string").alias("client_id"), F.lit("app").alias("source"), F.col("event_id").cast("string").alias("source_record_id"), F.lit(10).alias("source_priority"), "ts", F.lit(1).cast("long").alias("version"),
        F.when(~act, F.upper("event_type")).alias("event_type"), F.when(act, F.col("event_type")).alias("action"), F.lit(None).cast("string").alias("screen"), "value", (F.col("event_id") % 10 == 0).alias("again"),
    )
    # a tenth of the records comes again in a second version; a record of a day later than all lets everything settle
    rows = rows.unionByName(rows.where("again").withColumns({"version": F.lit(2).cast("long"), "value": F.col("value") + 1}))
    last = rows.agg(F.max("ts").alias("ts")).select(*[F.expr("ts + interval 30 days").alias("ts") if c == "ts" else (F.lit("~") if t == "string" and c == "client_id" else F.lit("END") if c in ("source_record_id", "event_type") else F.lit(None)).cast(t).alias(c) for c, t in rows.dtypes])
    last = last.withColumns({"source": F.lit("app"), "source_priority": F.lit(10), "version": F.lit(1).cast("long")})
    shown = lambda d: d.select(*[F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("at") if c == "ts" else F.col(c) for c in streamed.INPUT[:-1]], F.to_json(F.struct("value")).alias("payload"))
    # parts by time of the record come one after the other; the stream stops after each and goes on from its state
    edges = [r[0] for r in rows.agg(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), [0.25, 0.5, 0.75]).alias("q")).selectExpr("explode(q)").collect()]
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    part = sum((F.when(micros > x, 1).otherwise(0) for x in edges), F.lit(0))
    folders = [shown(rows.where(part == i)) for i in range(4)] + [shown(last)]
    folders[0].limit(0).write.parquet(f"{path}/in")
    stream = spark.readStream.schema(folders[0].schema).parquet(f"{path}/in")
    stream = stream.withColumn("ts", F.to_timestamp("at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSX"))
    out = streamed.timelines(stream, "1 hour", ["signup"], GAP, remember_seconds=10**9)

    def keep(batch: DataFrame, _: int) -> None:
        batch.write.mode("append").parquet(f"{path}/rows")

    for d in folders:
        d.write.mode("append").parquet(f"{path}/in")
        streamed.run(out, path, keep)
    got = spark.read.schema(out.schema).parquet(f"{path}/rows").where("client_id != '~'")
    return got.select("client_id", F.col("source_record_id").alias("record"), "event_type", F.when(F.col("event_type") != "APP_SESSION", F.get_json_object("payload", "$.value").cast("double")).alias("value"), "position", "delta_seconds", "duration_seconds", "n_actions")


@query(f"WITH {_SQL_VOCAB} SELECT id::BIGINT AS id, token FROM vo WHERE id < 5 OR block IN (1, 4)")
def t04_canonical_ids(spark, sf_dir):
    """Ids of the fixed blocks: special tokens, keys, RARE tokens."""
    return _vocab(spark, sf_dir).where("id < 5 or block in (1, 4)").select("id", "token")
