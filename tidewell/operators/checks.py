"""Output contract, quarantine, data-quality metrics, golden comparison, traces."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MISSING = "MISSING"
#: reason -> whether a later run can take the record in (fixed values).
RECOVERABLE = {
    "unresolved_client_id": True, "unknown_event_type": True, "missing_event_time": False, "unknown_timezone": True,
    "source_contract_violation": False, "unresolved_duplicate_conflict": True, "incompatible_schema_version": True, "content_hash_mismatch": False,
}


def violations(events: DataFrame, cutoff: str, domains: dict[str, list[str]], client: str = "client_id") -> DataFrame:
    """``check, violations``: how many events break each post-condition; every check is listed, also with 0.

    Event ids are unique, positions run from 0 without a gap, ordering keys
    grow with them, instants are at or before the cutoff, zones are given,
    values are within their domain. One pass over the timeline and one
    aggregation by event id.
    """
    w = Window.partitionBy(client).orderBy("position")
    rows = events.withColumns({"__key": F.lag("ordering_key").over(w), "__pos": F.coalesce(F.lag("position").over(w), F.lit(-1))})
    tests: dict[str, Column] = {
        "after_cutoff": F.col("ts") > F.lit(cutoff).cast("timestamp_ntz"),
        "no_instant": F.col("ts").isNull(),
        "no_zone": F.col("calendar_zone").isNull() | F.col("calendar_zone").rlike(r"^[+-]?\d"),
        "position_gap": F.col("position") != F.col("__pos") + 1,
        "key_not_growing": F.col("__key") >= F.col("ordering_key"),
    }
    for f, domain in domains.items():
        tests[f"domain_{f}"] = F.col(f).isNull() | ~F.col(f).isin([*domain, "MISSING"])
    counted = rows.agg(*[F.count_if(c).alias(n) for n, c in tests.items()])
    twice = events.groupBy("event_id").agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("event_id_repeated"))
    both = counted.crossJoin(twice)  # one row each
    return both.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).cast("long").alias("violations")) for n in [*tests, "event_id_repeated"]])).alias("x")).select("x.*")


@dataclass(frozen=True)
class Declared:
    """A field of the output: its closed domain if it has one (also of buckets), whether it is a bucket or a list."""

    domain: tuple[str, ...] | None = None
    bucket: bool = False
    multivalue: bool = False


def _outside(c: Column, d: Declared) -> Column:
    fine = lambda x: x.isin([*d.domain, MISSING])
    return F.exists(c, lambda x: x.isNull() | ~fine(x)) if d.multivalue else ~fine(c)


def field_violations(rows: DataFrame, sections: dict[str, dict[str, Declared]], excluded: list[str], section: str | None = "event_type") -> DataFrame:
    """``check, violations`` of the fields of records, of ``sections`` by their type (``section``; None: all have the one section).

    A value has to be in its domain (of a list every item), a record has only
    fields of its section, no field that the policy excludes, and no floating
    numbers. Null stands for MISSING, which a field of another section may be. One aggregation, whatever the number of fields.
    """
    every = list(dict.fromkeys(n for model in sections.values() for n in model))
    tests: dict[str, Column] = {}
    for name, model in sections.items():
        here = F.col(section) == name if section else F.lit(True)
        for f, d in model.items():
            if d.domain is not None and f in rows.columns:
                tests[f"domain:{name}.{f}"] = here & F.col(f).isNotNull() & _outside(F.col(f), d)
    for f in every:
        if f not in rows.columns:
            tests[f"absent:{f}"] = F.lit(True)
            continue
        owners = [n for n, model in sections.items() if f in model]
        if section and len(owners) < len(sections):
            there = F.col(f).isNotNull() if rows.schema[f].dataType.typeName() == "array" else F.coalesce(F.col(f).cast("string") != MISSING, F.lit(False))
            tests[f"undeclared:{f}"] = there & ~F.coalesce(F.col(section).isin(owners), F.lit(False))
        if rows.schema[f].dataType.typeName() in ("float", "double"):
            tests[f"float:{f}"] = F.col(f).isNotNull()
    for f in excluded:
        if f in rows.columns:
            tests[f"excluded:{f}"] = F.col(f).isNotNull()
    counted = rows.agg(*[F.count_if(c).alias(f"v{i}") for i, c in enumerate(tests.values())])
    return counted.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(f"v{i}").cast("long").alias("violations")) for i, n in enumerate(tests)])).alias("x")).select("x.*")


def profile_violations(profiles: DataFrame, cutoff: str, client: str = "client_id", ts: str = "profile_ts") -> DataFrame:
    """``check, violations`` of profiles: one a client, with a time up to the cutoff."""
    each = profiles.groupBy(client).agg(F.count("*").alias("n"), F.count_if(F.col(ts).isNull()).alias("none"), F.count_if(F.col(ts) > F.lit(cutoff).cast("timestamp_ntz")).alias("late"))
    tests = {"profile_repeated": F.count_if(F.col("n") > 1), "profile_no_client": F.count_if(F.col(client).isNull()), "profile_no_time": F.coalesce(F.sum("none"), F.lit(0)), "profile_after_cutoff": F.coalesce(F.sum("late"), F.lit(0))}
    return each.agg(*[c.alias(n) for n, c in tests.items()]).select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).cast("long").alias("violations")) for n in tests])).alias("x")).select("x.*")


def checked_values(rows: DataFrame, sections: dict[str, dict[str, Declared]], section: str | None = "event_type") -> DataFrame:
    """``fields_checked, bucket_values, closed_set_values``: how many values the contract was held against, MISSING among them."""
    n, b, c = (F.lit(0).cast("long") for _ in range(3))
    for name, model in sections.items():
        here = F.col(section) == name if section else F.lit(True)
        one = lambda f, d: F.greatest(F.lit(1), F.coalesce(F.size(f), F.lit(1))) if d.multivalue else F.lit(1)
        n = n + F.when(here, len(model)).otherwise(0)
        for f, d in model.items():
            if d.bucket:
                b = b + F.when(here, one(f, d)).otherwise(0)
            elif d.domain is not None:
                c = c + F.when(here, one(f, d)).otherwise(0)
    return rows.agg(*[F.coalesce(F.sum(x), F.lit(0)).cast("long").alias(k) for k, x in (("fields_checked", n), ("bucket_values", b), ("closed_set_values", c))])


def require(found: DataFrame) -> None:
    """Raise if any post-condition is broken."""
    broken = {r["check"]: r["violations"] for r in found.where("violations > 0").collect()}
    if broken:
        raise ValueError(f"output contract violated: {broken}")


def quarantine(rejects: DataFrame, lineage: list[str], detail: str | None = None) -> DataFrame:
    """``source, source_record_id, reason, recoverable, raw_reference``: a dead letter for each rejected record."""
    ok = F.lit(None).cast("boolean")
    for reason, yes in RECOVERABLE.items():
        ok = F.when(F.col("reason") == reason, yes).otherwise(ok)
    ref = F.concat(F.col(lineage[0]), F.lit("#"), F.col(lineage[1]).cast("string"), F.lit(":"), F.coalesce("source_record_id", F.lit("")))
    return rejects.select("source", "source_record_id", "reason", ok.alias("recoverable"), ref.alias("raw_reference"), *([detail] if detail else []))


def metrics(rows: DataFrame, rates: dict[str, tuple[Column, Column]], label: str | None = None) -> DataFrame:
    """``metric, label, hits, total, rate`` from conditional counts; the rate of a total of 0 is null.

    ``rates``: name -> (condition of a hit, condition of the denominator).
    Derived from rows, never from counters, so a task run twice counts once.
    """
    aggs = [a for n, (hit, of) in rates.items() for a in (F.count_if(hit & of).alias(f"{n}__h"), F.count_if(of).alias(f"{n}__t"))]
    keyed = rows.groupBy(F.col(label).alias("label")) if label else rows.groupBy(F.lit("").alias("label"))
    structs = [F.struct(F.lit(f"{n}_rate").alias("metric"), F.col(f"{n}__h").cast("long").alias("hits"), F.col(f"{n}__t").cast("long").alias("total")) for n in rates]
    out = keyed.agg(*aggs).select("label", F.explode(F.array(*structs)).alias("x")).select("label", "x.*")
    return out.withColumn("rate", F.try_divide(F.col("hits").cast("double"), F.col("total").cast("double")))


@dataclass(frozen=True)
class Rate:
    """What a data-quality rate divides: a total's name, and the label by which it is also told."""

    total: str
    label: str | None = None
    warning: float | None = None
    critical: float | None = None


#: The rates of a run with their denominators and thresholds (fixed values).
RATES = {
    "cutoff_violation_rate": Rate("events_validated", None, 0.0, 0.0),
    "schema_violation_rate": Rate("events_validated", None, 0.001, 0.01),
    "unknown_event_type_rate": Rate("records_mapped", None, 0.0, 0.001),
    "bucket_domain_violation_rate": Rate("bucket_values", None, 0.0, 0.0),
    "dedup_conflict_rate": Rate("duplicate_groups"),
    "missing_rate": Rate("fields_emitted", "field"),
    "numeric_parse_error_rate": Rate("numeric_values", None, 0.0001, 0.001),
    "numeric_nan_rate": Rate("numeric_values"),
    "numeric_business_range_error_rate": Rate("numeric_values", "field"),
    "numeric_clip_rate": Rate("bucket_values"),
    "fx_missing_rate": Rate("fx_conversions", None, 0.001, 0.01),
    "timestamp_error_rate": Rate("timestamps_parsed", None, 0.0, 0.001),
    "calendar_timezone_fallback_rate": Rate("timezones_resolved", "source"),
    "late_arriving_rate": Rate("records_read", "source"),
    "session_anomaly_rate": Rate("sessions_built"),
    "profile_missing_rate": Rate("clients_processed"),
}
#: Which rate a rejected record counts for; others count for none (fixed values).
REASON_RATES = {
    "source_contract_violation": "schema_violation_rate", "incompatible_schema_version": "schema_violation_rate", "unknown_event_type": "unknown_event_type_rate",
    "missing_event_time": "timestamp_error_rate", "unknown_timezone": "timestamp_error_rate", "unresolved_duplicate_conflict": "dedup_conflict_rate",
}


def report(hits: DataFrame, totals: DataFrame) -> DataFrame:
    """``metric, label, hits, denominator, total, rate, level`` of all rates, those without a hit too.

    ``hits``: metric, label, n; ``totals``: total, label, n; both are small sums
    with a null label for the whole. A rate with a label also has a row for each
    of its labels. Of a total of 0 the rate is null: nothing was tried.
    """
    spark = hits.sparkSession
    rows = [(m, r.total, r.label is not None, r.warning, r.critical) for m, r in RATES.items()]
    rates = spark.createDataFrame(rows, "metric string, denominator string, labelled boolean, warning double, critical double")
    h = hits.groupBy("metric", "label").agg(F.sum("n").alias("hits"))
    t = totals.groupBy(F.col("total").alias("denominator"), "label").agg(F.sum("n").alias("total"))
    labels = rates.where("labelled").join(t.where("label is not null").select("denominator", "label"), "denominator").unionByName(rates.withColumn("label", F.lit(None).cast("string")))
    hh, tt = h.toDF("m", "l", "hits"), t.toDF("d", "k", "total")
    out = labels.join(hh, (F.col("metric") == F.col("m")) & F.col("label").eqNullSafe(F.col("l")), "left").join(tt, (F.col("denominator") == F.col("d")) & F.col("label").eqNullSafe(F.col("k")), "left")
    n, of = (F.coalesce(c, F.lit(0)).cast("long") for c in ("hits", "total"))
    rate = F.try_divide(n.cast("double"), of.cast("double"))
    level = F.when(rate.isNull() | F.col("warning").isNull(), None).when(rate > F.col("critical"), "critical").when(rate > F.col("warning"), "warning").otherwise("normal")
    return out.select("metric", "label", n.alias("hits"), "denominator", of.alias("total"), rate.alias("rate"), level.alias("level"))


def first_difference(got: DataFrame, want: DataFrame, key: list[str]) -> tuple | None:
    """(key, column, got, want) of the first key, in order, whose rows differ; None where all agree.

    A row that one side does not have differs in the column ``*``. Only one row comes to the driver.
    """
    names = [c for c in want.columns if c not in key]
    a = got.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(key)], *[F.col(c).alias(f"a{i}") for i, c in enumerate(names)], F.lit(1).alias("ina"))
    b = want.select(*[F.col(k).alias(f"j{i}") for i, k in enumerate(key)], *[F.col(c).alias(f"b{i}") for i, c in enumerate(names)], F.lit(1).alias("inb"))
    same = None
    for i in range(len(key)):
        c = F.col(f"k{i}").eqNullSafe(F.col(f"j{i}"))
        same = c if same is None else same & c
    text = lambda x, t: F.to_json(x) if t in ("array", "struct", "map") else x.cast("string")
    kinds = [want.schema[c].dataType.typeName() for c in names]
    alone = F.col("ina").isNull() | F.col("inb").isNull()
    told = F.when(alone, F.struct(F.lit("*").alias("column"), F.when(F.col("ina").isNotNull(), "a row").alias("got"), F.when(F.col("inb").isNotNull(), "a row").alias("want")))
    for i, c in enumerate(names):
        one, two = text(F.col(f"a{i}"), kinds[i]), text(F.col(f"b{i}"), kinds[i])
        told = told.when(~one.eqNullSafe(two), F.struct(F.lit(c).alias("column"), one.alias("got"), two.alias("want")))
    keys = [F.coalesce(f"k{i}", f"j{i}").alias(f"key{i}") for i in range(len(key))]
    row = a.join(b, same, "full").select(*keys, told.alias("x")).where("x is not null").orderBy(*[f"key{i}" for i in range(len(key))]).first()
    return None if row is None else (tuple(row[f"key{i}"] for i in range(len(key))), row["x"]["column"], row["x"]["got"], row["x"]["want"])


def differences(got: DataFrame, want: DataFrame) -> DataFrame:
    """Rows that only one side has, with ``side``; repeated rows count."""
    return got.exceptAll(want).withColumn("side", F.lit("got")).unionByName(want.exceptAll(got).withColumn("side", F.lit("want")))


def trace(stages: dict[str, DataFrame], clients: list[str], client: str = "client_id") -> DataFrame:
    """``stage, client, row``: the rows of the chosen clients at each stage, as JSON."""
    out = None
    for name, df in stages.items():
        some = df.where(F.col(client).isin(clients)).select(F.lit(name).alias("stage"), F.col(client).alias("client"), F.to_json(F.struct(*df.columns)).alias("row"))
        out = some if out is None else out.unionByName(some)
    return out


def ledger(lines: DataFrame, line: list[str], rejects: DataFrame, cut: DataFrame, merges: list[tuple[str, DataFrame, DataFrame, list[str]]], kept: DataFrame) -> DataFrame:
    """One row for each of ``lines``: the ``line`` columns, ``fate, reason, superseded_by, event_id``.

    ``rejects`` (line, reason) are ``rejected``, ``cut`` rows are ``cut``;
    ``merges`` are steps (fate, rows before, rows after, key) that leave one
    row a key: every other row of the key is superseded by the line of that one;
    ``kept`` (line, fate, event_id) is what the rest became. A line without any of these is
    ``lost``. Where a step's result does not say which line it has from which, the key does:
    the table after it has each key once, so copies without number join one row.
    """
    none = F.lit(None).cast("string")
    shown = F.concat_ws("#", *[F.col(c).cast("string") for c in line])
    told = [
        rejects.select(*line, F.lit("rejected").alias("fate"), F.col("reason"), none.alias("superseded_by"), none.alias("event_id")),
        cut.select(*line, F.lit("cut").alias("fate"), none.alias("reason"), none.alias("superseded_by"), none.alias("event_id")),
        kept.select(*line, "fate", none.alias("reason"), none.alias("superseded_by"), "event_id"),
    ]
    for fate, before, after, key in merges:
        by = after.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(key)], shown.alias("__by"))
        same = None
        for i, k in enumerate(key):
            c = F.col(k).eqNullSafe(F.col(f"__k{i}"))
            same = c if same is None else same & c
        gone = before.join(by, same).where(shown != F.col("__by"))
        told.append(gone.select(*line, F.lit(fate).alias("fate"), none.alias("reason"), F.col("__by").alias("superseded_by"), none.alias("event_id")))
    every = told[0]
    for t in told[1:]:
        every = every.unionByName(t)
    return lines.select(*line).join(every, line, "left").withColumn("fate", F.coalesce("fate", F.lit("lost")))
