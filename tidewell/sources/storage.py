"""Tables that cut lineage, and the files that outputs and artifacts are written to."""

from __future__ import annotations

import hashlib
import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, which driver and executors share.

    Where it is unset a local run takes one under /tmp; on a cluster it is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        sc.setCheckpointDir(named or "file:///tmp/checkpoints/tidewell")
    return sc.getCheckpointDir().rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """The table written to the shared folder and read back; what follows reads it and survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(makers: dict) -> dict:
    """Name -> what its function gives, all of them run side by side: small jobs of independent tables need not wait for each other.

    The threads carry the caller's job group; the first error is raised once all have ended.
    """
    own = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max(1, len(makers))) as pool:
        running = {n: pool.submit(own(f)) for n, f in makers.items()}
    return {n: r.result() for n, r in running.items()}


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small document in one file, through Hadoop's file system, so any store will do."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def event_lines(events: DataFrame) -> DataFrame:
    """Prepared events as the records that a reader gets: nested fields and calendar features, the instant as text."""
    return events.select(
        "client_id", "position", "event_id", "event_type", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp_utc"), F.col("calendar_zone").alias("calendar_timezone"), "ordering_key", F.parse_json("fields").alias("fields"),
        F.struct("hour_of_day_local", "day_of_week_local").alias("calendar_time_features"), "lifetime_first",
    )


def profile_lines(profiles: DataFrame) -> DataFrame:
    return profiles.select("client_id", F.date_format("profile_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("profile_time_utc"), F.parse_json("fields").alias("fields"))


def write_outputs(encoded, path: str, documents: dict | None = None) -> None:
    """Prepared events and profiles in order of client and position, the dead letters by source and the metrics, as JSON
    lines; and each of ``documents`` (``plans.documents.prepared``) as a file of its own."""
    spark = encoded.events.sparkSession
    lines = event_lines(encoded.events).repartitionByRange("client_id").sortWithinPartitions("client_id", "position")
    lines.select(F.to_json(F.struct(*[c for c in lines.columns if c != "position"])).alias("value")).write.mode("overwrite").text(f"{path}/prepared_events")
    rows = profile_lines(encoded.profiles).repartitionByRange("client_id").sortWithinPartitions("client_id")
    rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).write.mode("overwrite").text(f"{path}/prepared_profile")
    encoded.quarantine.sortWithinPartitions("raw_reference").write.mode("overwrite").partitionBy("source").json(f"{path}/quarantine")
    encoded.metrics.write.mode("overwrite").json(f"{path}/metrics")
    for name, doc in (documents or {}).items():
        write_text(spark, f"{path}/{name}", doc)


class OutputError(RuntimeError):
    """There is no published output, or it is not what its manifest says."""


#: Parts of an output that are tables.
PARTS = ("prepared_events", "prepared_profile", "quarantine", "metrics")


def _part_digest(spark: SparkSession, folder: str, part: str) -> dict:
    """Number of lines of a part and the digest of them all, in whichever files they are."""
    from ..functions.hashing import table_digest

    lines = spark.read.schema("value string").option("recursiveFileLookup", "true").text(f"{folder}/{part}")
    digest, rows = table_digest(lines)
    return {"rows": rows, "sha256": digest}


def _moved(spark: SparkSession, source: str, target: str) -> None:
    """A file renamed over another one in one step."""
    jvm = spark._jvm
    old, new = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    over = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(over, 1)
    options[0] = over.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(old.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(old, new, options)


def publish(encoded, path: str, documents: dict | None = None) -> str:
    """All of ``write_outputs`` or nothing: a folder of its own for each version, its manifest, and then the marker that readers follow.

    The manifest has the rows and a digest of each part, and the hash of each
    document. A run that ends anywhere before the marker leaves the output that
    was there; what it wrote is not seen by anyone. Returns the version's folder.
    """
    spark = encoded.events.sparkSession
    version = uuid.uuid4().hex
    folder = f"{path}/versions/{version}"
    write_outputs(encoded, folder, documents)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    parts = {p: _part_digest(spark, folder, p) for p in PARTS}
    manifest = json.dumps({"version": version, "parts": parts, "documents": {n: sha(d) for n, d in (documents or {}).items()}}, sort_keys=True)
    write_text(spark, f"{folder}/manifest.json", manifest)
    write_text(spark, f"{path}/CURRENT-{version}", json.dumps({"version": version, "manifest_sha256": sha(manifest)}, sort_keys=True))
    _moved(spark, f"{path}/CURRENT-{version}", f"{path}/CURRENT")
    return folder


def current(spark: SparkSession, path: str, verify: bool = False) -> str:
    """The folder of the published version; with ``verify`` every part is read and held against the manifest."""
    if not exists(spark, f"{path}/CURRENT"):
        raise OutputError(f"nothing is published at {path}")
    marker = json.loads(read_text(spark, f"{path}/CURRENT"))
    folder = f"{path}/versions/{marker['version']}"
    text = read_text(spark, f"{folder}/manifest.json") if exists(spark, f"{folder}/manifest.json") else ""
    if hashlib.sha256(text.encode()).hexdigest() != marker["manifest_sha256"]:
        raise OutputError("the manifest is not the one that was published")
    if verify:
        manifest = json.loads(text)
        for part, told in manifest["parts"].items():
            found = _part_digest(spark, folder, part)
            if found != told:
                raise OutputError(f"{part} has {found['rows']} rows of another content than the {told['rows']} that were published")
        for name, told in manifest["documents"].items():
            if hashlib.sha256(read_text(spark, f"{folder}/{name}").encode()).hexdigest() != told:
                raise OutputError(f"{name} is not the document that was published")
    return folder


def expire(spark: SparkSession, path: str) -> int:
    """Delete all versions but the published one, those of runs that never ended among them; returns how many went."""
    keep = current(spark, path).rsplit("/", 1)[1]
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/versions")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = [f.getPath() for f in fs.listStatus(root) if f.getPath().getName() != keep]
    for p in gone:
        fs.delete(p, True)
    return len(gone)


def _edges_document(e) -> dict:
    text = lambda x: None if x is None else format(x, "f")
    return {"edges": [format(x, "f") for x in e.edges], "least": text(e.least), "most": text(e.most), "n_values": e.n_values, "method": e.method, "asked": e.asked}


def freeze(spark: SparkSession, artifacts, path: str, documents: dict | None = None) -> str:
    """Write edges, policy, identity (as a table) and hash, and each of ``documents`` (``plans.documents.artifacts``).
    Returns the hash."""
    from ..plans.documents import policy_sections

    own = isinstance(artifacts.identity, dict)
    if not own:
        artifacts.identity.table.write.mode("overwrite").parquet(f"{path}/identity")
    doc = {
        "edges": {n: _edges_document(x) for n, x in artifacts.edges.items()},
        "delta": _edges_document(artifacts.delta),
        "identity": artifacts.identity if own else artifacts.identity.document(),
        "identity_is_a_table": not own,
        "policy": policy_sections(artifacts.policy),
        "sha256": artifacts.sha256(),
    }
    write_text(spark, f"{path}/state.json", json.dumps(doc, sort_keys=True, ensure_ascii=False))
    for name, text in (documents or {}).items():
        write_text(spark, f"{path}/{name}", text)
    return doc["sha256"]


def thaw(spark: SparkSession, path: str, policy=None):
    """Artifacts from what ``freeze`` wrote, with the policy that was frozen or another that has to be the same; raises when
    their hash is another one, a changed identity table included."""
    from ..operators.buckets import Edges
    from ..plans.documents import policy_of
    from ..plans.preparation import Artifacts, StateMismatch, identified

    def edges(d: dict) -> Edges:
        number = lambda x: None if x is None else Decimal(x)
        return Edges(tuple(Decimal(e) for e in d["edges"]), number(d["least"]), number(d["most"]), d["n_values"], d["method"], d["asked"])

    doc = json.loads(read_text(spark, f"{path}/state.json"))
    ids = doc["identity"]
    if doc["identity_is_a_table"]:
        ids = identified(spark.read.schema("section string, ref string, client_id string").parquet(f"{path}/identity"), tuple(ids["sections"]))
    out = Artifacts(policy or policy_of(doc["policy"]), ids, {n: edges(x) for n, x in doc["edges"].items()}, edges(doc["delta"]))
    if out.sha256() != doc["sha256"]:
        raise StateMismatch("the policy is not the one that this state was built with")
    return out
