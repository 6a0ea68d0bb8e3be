"""What became of every line that a run read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import hashing
from ..operators import checks, dedup, sessions
from .config import Policy
from .preparation import Prepared

LINE = ["partition", "line_number"]


def of(prepared: Prepared, policy: Policy) -> DataFrame:
    """``source, partition, line_number, fate, reason, superseded_by, event_id``, one row a raw line.

    Fates are ``rejected`` (with the reason), ``cut`` (after the cutoff), ``version`` and ``same_fact``
    (superseded by the line named), ``event``, ``action`` (of the session whose id is given), ``snapshot``
    and ``rate``. All of it follows from the tables that the run made and the provenance that its
    rows carry; no step is run again but the numbering of sessions.
    """
    out = None
    for name, c in policy.contracts.items():
        s = prepared.steps[name]
        bad = prepared.rejects.where(F.col("source") == name).select(*LINE, "reason")
        after = s["timed"].where(F.col("ts") > F.lit(policy.cutoff).cast("timestamp_ntz"))
        # what a conflict rejected is no copy of another line
        within = s["within"].join(bad, LINE, "left_anti")
        merges = [("version", within, s["single"], ["source_record_id"])]
        if policy.fingerprints[name]:
            fact = lambda d: d.withColumn("__fact", dedup.fingerprint(F.lit(name), "1.0.0", [F.col(f) for f in policy.fingerprints[name]]))  # noqa: B023, E731
            merges.append(("same_fact", fact(s["single"]), fact(s["facts"]), ["__fact"]))
        facts = s["facts"].join(bad, LINE, "left_anti")
        one = checks.ledger(s["read"], LINE, bad, after, merges, _kept(name, facts, prepared, policy))
        one = one.withColumn("source", F.lit(name)).select("source", *LINE, "fate", "reason", "superseded_by", "event_id")
        out = one if out is None else out.unionByName(one)
    return out


def _kept(name: str, facts: DataFrame, prepared: Prepared, policy: Policy) -> DataFrame:
    """``partition, line_number, fate, event_id`` of the facts of a source."""
    none = F.lit(None).cast("string")
    kind = policy.contracts[name].kind
    if kind != "event":
        return facts.select(*LINE, F.lit("snapshot" if kind == "profile" else "rate").alias("fate"), none.alias("event_id"))
    ids = prepared.events.where((F.col("source") == name) & (F.col("event_type") != "APP_SESSION")).select(F.col("source_record_id").alias("__id"), "event_id")
    events = facts.join(ids, F.col("source_record_id") == F.col("__id")).select(*LINE, F.lit("event").alias("fate"), "event_id")
    if name != policy.session_source:
        return events
    acts = facts.where(F.col("action").isin([c for c, t in policy.codes[name].items() if t is None]))
    rows = sessions.numbered(acts, list(policy.session_starts), policy.session_gap_seconds)
    first = rows.groupBy(F.col("client_id").alias("__c"), F.col("session_no").alias("__no")).agg(F.min(F.struct("ts", "source_record_id")).alias("k"))
    first = first.select("__c", "__no", hashing.event_id(F.lit(name), F.col("k.source_record_id"), F.lit("APP_SESSION"), F.col("k.ts")).alias("event_id"))
    own = rows.join(first, F.col("client_id").eqNullSafe(F.col("__c")) & (F.col("session_no") == F.col("__no")))
    return events.unionByName(own.select(*LINE, F.lit("action").alias("fate"), "event_id"))
