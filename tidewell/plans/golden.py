"""A frozen result, and the first place where a later run differs from it."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import blocks
from ..operators.checks import first_difference
from ..sources import storage
from .documents import bucket_domains, canonical, code_state


class GoldenMismatch(RuntimeError):
    """A run does not give what was frozen."""


#: Frozen table -> the columns that name its rows.
KEYS = {"prepared_events": ["client_id", "position"], "prepared_profile": ["client_id"]}


def _tables(encoded) -> dict[str, DataFrame]:
    text = lambda df: df.withColumn("fields", F.to_json("fields"))
    return {"prepared_events": text(storage.event_lines(encoded.events)), "prepared_profile": text(storage.profile_lines(encoded.profiles))}


def _documents(artifacts) -> dict[str, object]:
    return {"bucket_field_domains": bucket_domains(artifacts.edges), "preprocessing_state_sha256": artifacts.sha256()}


def freeze(spark: SparkSession, encoded, artifacts, path: str, version: str, dataset: str) -> None:
    """Write the four parts of a golden result and a manifest of what made them; an existing one is not overwritten."""
    if storage.exists(spark, f"{path}/manifest.json"):
        raise GoldenMismatch(f"{path} holds a frozen result already")
    for name, df in _tables(encoded).items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
    for name, doc in _documents(artifacts).items():
        storage.write_text(spark, f"{path}/{name}.json", canonical(doc))
    manifest = {"golden_vectors_version": version, "dataset": dataset, "items": [*KEYS, *_documents(artifacts)], "code_state_sha256": code_state()["sha256"]}
    storage.write_text(spark, f"{path}/manifest.json", canonical(manifest))


def differences(spark: SparkSession, encoded, artifacts, path: str) -> dict[str, str]:
    """Part -> its first difference, of the parts that are not as frozen; one row a table comes to the driver."""
    if not storage.exists(spark, f"{path}/manifest.json"):
        raise GoldenMismatch(f"{path} holds no frozen result")
    out = {}
    for name, doc in _documents(artifacts).items():
        want = json.loads(storage.read_text(spark, f"{path}/{name}.json"))
        got = json.loads(canonical(doc))
        if got != want:
            key = next((k for k in sorted({*got, *want}) if got.get(k) != want.get(k)), None) if isinstance(got, dict) and isinstance(want, dict) else None
            out[name] = f"key {key}: {got.get(key)} for {want.get(key)}" if key else f"{got} for {want}"
    for name, df in _tables(encoded).items():
        found = first_difference(df, spark.read.parquet(f"{path}/{name}"), KEYS[name])
        if found:
            key, column, got, want = found
            out[name] = f"row {key}: {column} is {got} for {want}"
    return out


def compare(spark: SparkSession, encoded, artifacts, path: str) -> None:
    """Raise, naming the first difference of each part, unless the run gives what was frozen."""
    found = differences(spark, encoded, artifacts, path)
    if found:
        raise GoldenMismatch("; ".join(f"{k}: {v}" for k, v in sorted(found.items())))


def texts(encoded, block: int = blocks.BLOCK) -> dict[str, blocks.Text]:
    """The outputs as the lines that files have, in order of client and position, with their hash trees."""
    events, prof = storage.event_lines(encoded.events), storage.profile_lines(encoded.profiles)
    shown = F.to_json(F.struct(*[c for c in events.columns if c != "position"]))
    return {"prepared_events": blocks.text(events, KEYS["prepared_events"], shown, block), "prepared_profile": blocks.text(prof, KEYS["prepared_profile"], F.to_json(F.struct(*prof.columns)), block)}


def freeze_bytes(encoded, path: str, block: int = blocks.BLOCK) -> dict[str, str | None]:
    """Write the lines and trees of both outputs; returns their root hashes. An existing result is not overwritten."""
    spark = encoded.events.sparkSession
    out = {}
    for name, t in texts(encoded, block).items():
        if storage.exists(spark, f"{path}/{name}"):
            raise GoldenMismatch(f"{path}/{name} holds a frozen result already")
        blocks.freeze(t, f"{path}/{name}")
        out[name] = t.root()
    return out


def byte_differences(encoded, path: str, block: int = blocks.BLOCK) -> dict[str, blocks.Difference]:
    """Output -> block, line and byte of its first difference from the frozen one; nothing for equal ones."""
    spark = encoded.events.sparkSession
    found = {name: blocks.first_difference(t, blocks.frozen(spark, f"{path}/{name}", block)) for name, t in texts(encoded, block).items()}
    return {n: d for n, d in found.items() if d}
