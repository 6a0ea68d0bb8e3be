"""All of an output or nothing."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewell.plans.preparation import Encoded
from tidewell.sources import storage


def output(spark, n):
    e = spark.range(n).select(
        F.concat(F.lit("c"), (F.col("id") % 3).cast("string")).alias("client_id"), F.col("id").alias("position"), F.col("id").cast("string").alias("event_id"), F.lit("T").alias("event_type"), F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias("ts"),
        F.lit("UTC").alias("calendar_zone"), F.lpad(F.col("id").cast("string"), 5, "0").alias("ordering_key"), F.lit('{"a":"b"}').alias("fields"), F.lit(1).cast("long").alias("hour_of_day_local"), F.lit(1).cast("long").alias("day_of_week_local"), (F.col("id") < 3).alias("lifetime_first"),
    )
    p = spark.createDataFrame([("c0", datetime(2024, 1, 1), "{}")], "client_id string, profile_ts timestamp_ntz, fields string")
    q = spark.createDataFrame([("app", "r1", "bad"), ("pay", "r2", "bad")], "source string, raw_reference string, reason string")
    return Encoded(e, p, q, spark.createDataFrame([("m", n)], "metric string, hits long"))


def rows(spark, folder):
    return spark.read.json(f"{folder}/prepared_events").count()


def test_a_version_is_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/out"
    with pytest.raises(storage.OutputError, match="nothing is published"):
        storage.current(spark, path)
    storage.publish(output(spark, 20), path, {"doc.json": "{}"})
    first = storage.current(spark, path, verify=True)
    manifest = json.loads(storage.read_text(spark, f"{first}/manifest.json"))
    assert {p: x["rows"] for p, x in manifest["parts"].items()} == {"prepared_events": 20, "prepared_profile": 1, "quarantine": 2, "metrics": 1}
    # a run that ends before any of its later steps leaves what was there
    for step in ("write_text", "_part_digest", "_moved"):
        with monkeypatch.context() as m:
            m.setattr(storage, step, lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt))
            with pytest.raises(KeyboardInterrupt):
                storage.publish(output(spark, 30), path, {"doc.json": "{}"})
        assert storage.current(spark, path, verify=True) == first and rows(spark, first) == 20
    storage.publish(output(spark, 40), path)
    second = storage.current(spark, path, verify=True)
    assert second != first and rows(spark, second) == 40
    assert storage.expire(spark, path) == 4 and storage.current(spark, path, verify=True) == second


def test_changed_parts_are_seen(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    folder = storage.publish(output(spark, 20), path, {"doc.json": "{}"}).removeprefix("file://")
    part = next(f for f in sorted((tmp_path / folder / "prepared_events").glob("part-*")) if f.stat().st_size)
    text = part.read_text()
    part.write_text(text.replace('"T"', '"U"', 1))
    (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    with pytest.raises(storage.OutputError, match="prepared_events has 20 rows"):
        storage.current(spark, path, verify=True)
    part.write_text(text)
    storage.current(spark, path, verify=True)
    doc = tmp_path / folder / "doc.json"
    doc.write_text("[]")
    (doc.parent / ".doc.json.crc").unlink(missing_ok=True)
    with pytest.raises(storage.OutputError, match="doc.json"):
        storage.current(spark, path, verify=True)


def test_the_same_rows_in_other_files_have_the_same_digest(spark, tmp_path):
    folders = [storage.publish(Encoded(*(getattr(e, f) for f in ("events", "profiles", "quarantine", "metrics"))), f"file://{tmp_path}/{i}") for i, e in enumerate([output(spark, 50), output(spark, 50)])]
    one, two = (json.loads(storage.read_text(spark, f"{f}/manifest.json"))["parts"] for f in folders)
    assert one == two
