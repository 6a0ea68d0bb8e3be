"""Counts of a preparation run, from the tables that its steps yield, and the data-quality report made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import buckets, checks
from .config import Policy


class Tallies:
    """Rows (rate or total, label, n), gathered as plans: nothing is counted before ``report`` is evaluated.

    Everything is derived from rows, never from counters, so a task run twice counts once.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.hits: list[DataFrame] = []
        self.totals: list[DataFrame] = []

    def _add(self, df: DataFrame, hits: list[tuple[str, str | None, Column]], totals: list[tuple[str, str | None, Column]]) -> None:
        """One aggregation for all counts of a table; a labelled count also counts for the whole."""
        every = [*hits, *totals]
        if not every:
            return
        row = df.agg(*[c.cast("long").alias(f"n{i}") for i, (_, _, c) in enumerate(every)])

        def rows(part: list, first: int) -> DataFrame:
            told = [F.struct(F.lit(name).alias("name"), F.lit(at).cast("string").alias("label"), F.coalesce(f"n{first + i}", F.lit(0)).alias("n")) for i, (name, label, _) in enumerate(part) for at in ([label, None] if label else [None])]
            return row.select(F.explode(F.array(*told)).alias("x")).select("x.*")

        if hits:
            self.hits.append(rows(hits, 0))
        if totals:
            self.totals.append(rows(totals, len(hits)))

    def rows(self, checked: DataFrame, source: str) -> None:
        self._add(checked, [], [("records_read", source, F.count("*"))])

    def times(self, before: DataFrame, good: DataFrame, source: str) -> None:
        self._add(before, [], [("timestamps_parsed", None, F.count("*"))])
        self._add(good, [("calendar_timezone_fallback_rate", source, F.count_if("zone_fallback")), ("late_arriving_rate", source, F.count_if("is_late"))], [("timezones_resolved", source, F.count("*"))])

    def copies(self, rows: DataFrame, source: str) -> None:
        self._add(rows.groupBy("source_record_id").count(), [], [("duplicate_groups", None, F.count_if(F.col("count") > 1))])

    def mapped(self, rows: DataFrame) -> None:
        self._add(rows, [], [("records_mapped", None, F.count("*"))])

    def sessions(self, rows: DataFrame, policy: Policy) -> None:
        """An anomaly is a negative or excessive length, a session without an action, or with more screens than its field allows."""
        most = {n: f.numeric.most for n, f in policy.sections["APP_SESSION"].items() if f.numeric}
        odd = (F.col("duration_seconds") < 0) | (F.col("n_actions") < 1)
        if most.get("duration_bucket"):
            odd = odd | (F.col("duration_seconds") > int(most["duration_bucket"]))
        if most.get("screens_count_bucket"):
            odd = odd | (F.col("screens_count") > int(most["screens_count_bucket"]))
        self._add(rows, [("session_anomaly_rate", None, F.count_if(odd))], [("sessions_built", None, F.count("*"))])

    def prepared(self, events: DataFrame, profiles: DataFrame, rejects: DataFrame, policy: Policy) -> None:
        """Missing fields, numbers, rates of exchange, profiles and rejects."""
        hits: list = [("cutoff_violation_rate", None, F.count_if(F.col("ts") > F.lit(policy.cutoff).cast("timestamp_ntz")))]
        totals: list = [("events_validated", None, F.count("*"))]
        kept = {t: {n: f for n, f in model.items() if f.vocabulary != "excluded"} for t, model in policy.sections.items()}
        for n in dict.fromkeys(n for model in kept.values() for n in model):
            here = F.col("event_type").isin([t for t, model in kept.items() if n in model])
            hits.append(("missing_rate", n, F.count_if(here & F.col(n).isNull())))
            totals.append(("fields_emitted", n, F.count_if(here)))
        for n in dict.fromkeys(n for model in kept.values() for n, f in model.items() if f.numeric and f"{n}__reason" in events.columns):
            self._numbers(n, F.col(n).isNotNull() | F.col(f"{n}__reason").isNotNull() | (F.col("fx_missing") if any(m[n].fx for m in kept.values() if n in m) else F.lit(False)), hits, totals)
        hits.append(("fx_missing_rate", None, F.count_if("fx_missing")))
        fx = next((n for model in kept.values() for n, f in model.items() if f.fx), None)
        if fx:
            totals.append(("fx_conversions", None, F.count_if(F.col(fx).isNotNull() | F.col("fx_missing"))))
        self._add(events, hits, totals)
        hits, totals = [("profile_missing_rate", None, F.count_if("profile_missing"))], [("clients_processed", None, F.count("*")), ("events_validated", None, F.count("*"))]
        for n, f in policy.profile.items():
            hits.append(("missing_rate", n, F.count_if(F.col(n).isNull())))
            totals.append(("fields_emitted", n, F.count("*")))
            if f"{n}__reason" in profiles.columns:
                self._numbers(n, F.col(n).isNotNull() | F.col(f"{n}__reason").isNotNull(), hits, totals)
        self._add(profiles, hits, totals)
        # of a conflict all rows are rejected, and it counts once
        once = rejects.select("reason", F.when(F.col("reason") == "unresolved_duplicate_conflict", F.struct("source", "source_record_id")).alias("group"), F.when(F.col("reason") != "unresolved_duplicate_conflict", F.struct("source", "partition", "line_number")).alias("row")).distinct()
        by = [(rate, None, F.count_if(F.col("reason").isin([r for r, x in checks.REASON_RATES.items() if x == rate]))) for rate in sorted(set(checks.REASON_RATES.values()))]
        self._add(once, by, [("quarantined", None, F.count("*"))])

    def _numbers(self, name: str, tried: Column, hits: list, totals: list) -> None:
        reason = F.col(f"{name}__reason")
        hits.append(("numeric_parse_error_rate", None, F.count_if(reason == "parse_error")))
        hits.append(("numeric_nan_rate", None, F.count_if(reason == "non_finite")))
        hits.append(("numeric_business_range_error_rate", name, F.count_if(reason == "business_range")))
        totals.append(("numeric_values", name, F.count_if(tried)))

    def bucketed(self, events: DataFrame, profiles: DataFrame, edges: dict[str, buckets.Edges]) -> None:
        """Values in buckets, and those beyond the training range."""
        for df in (events, profiles):
            own = {n: e for n, e in edges.items() if n in df.columns}
            if own:
                self._add(buckets.clip_counts(df, own), [("numeric_clip_rate", None, F.sum(F.col("clipped_low") + F.col("clipped_high")))], [("bucket_values", None, F.sum("assigned"))])

    def labelled(self, events: DataFrame, profiles: DataFrame, edges: dict[str, buckets.Edges]) -> None:
        """Labels that are in no published domain, as edges and domains of two builds would make them."""
        for df in (events, profiles):
            own = [n for n in edges if n in df.columns]
            outside = [F.count_if(F.col(n).isNotNull() & ~F.col(n).isin([*edges[n].domain(), "MISSING"])) for n in own]
            if own:
                self._add(df, [("bucket_domain_violation_rate", None, sum(outside[1:], outside[0]))], [])

    def report(self) -> DataFrame:
        """``metric, label, hits, denominator, total, rate, level`` of all rates."""

        def whole(parts: list[DataFrame], name: str) -> DataFrame:
            out = parts[0]
            for p in parts[1:]:
                out = out.unionByName(p)
            return out.select(F.col("name").alias(name), "label", "n")

        return checks.report(whole(self.hits, "metric"), whole(self.totals, "total"))
