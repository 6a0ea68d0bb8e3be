"""JSON-lines sources under declared contracts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.hashing import tagged

SQL_TYPES = {"string": "string", "integer": "bigint", "string_list": "array<string>"}


class ContractError(ValueError):
    """A contract or a source directory is not well formed."""


@dataclass(frozen=True)
class ColumnSpec:
    """A declared column: string, integer or string_list; key required; null allowed; PII class."""

    type: str
    required: bool = True
    nullable: bool = False
    pii: str = "none"


@dataclass(frozen=True)
class Contract:
    """What a source promises."""

    name: str
    kind: str
    priority: int
    primary_key: tuple[str, ...]
    columns: dict[str, ColumnSpec]
    client_field: str | None = None
    time_field: str = ""
    time_kind: str = ""
    processing_field: str | None = None
    zone_policy: str = "utc"
    zone_field: str | None = None
    default_zone: str | None = None
    version_field: str | None = None
    schema_version: str = "1.0"
    schema_version_field: str | None = None
    max_delay_hours: int = 24

    def __post_init__(self):
        def need(ok: bool, why: str) -> None:
            if not ok:
                raise ContractError(f"{self.name}: {why}")

        need(self.kind in ("event", "profile", "reference"), f"unknown kind {self.kind}")
        need(bool(self.primary_key) and len(set(self.primary_key)) == len(self.primary_key), "the primary key needs distinct columns")
        for k in self.primary_key:
            spec = self.columns.get(k)
            need(spec is not None, f"primary key column {k} is not declared")
            need(spec.required and not spec.nullable and spec.type == "string", f"primary key column {k} has to be a required string without nulls")
            need(spec.pii != "direct_identifier", f"primary key column {k} is a direct identifier")
        need((self.client_field is None) == (self.kind == "reference"), "reference sources, and only they, have no client")
        for c in (self.client_field, self.time_field, self.processing_field, self.zone_field, self.version_field, self.schema_version_field):
            need(c is None or c in self.columns, f"column {c} is not declared")
        need(all(c == c.strip() and c for c in self.columns), "column names have no white space around them")
        need(all(s.type in SQL_TYPES for s in self.columns.values()), "unknown column type")
        need(self.zone_policy in ("utc", "source_default", "client_profile_region", "from_field_mapping"), "unknown zone policy")
        need((self.zone_policy == "from_field_mapping") == (self.zone_field is not None), "a zone field goes with from_field_mapping")
        need(self.zone_policy not in ("source_default", "client_profile_region") or self.default_zone is not None, "a default zone is needed")
        need(self.zone_policy != "utc" or self.default_zone is None, "utc has no default zone")


def check_registry(contracts: dict[str, Contract]) -> None:
    """Names agree and priorities are unique."""
    if any(n != c.name for n, c in contracts.items()):
        raise ContractError("a contract is registered under another name")
    if len({c.priority for c in contracts.values()}) != len(contracts):
        raise ContractError("source priorities repeat")


def check_layout(spark: SparkSession, root: str, contracts: dict[str, Contract], ignored: tuple[str, ...] = ("_meta",)) -> None:
    """The root holds one directory for each source, with .jsonl files and nothing else."""
    jvm, sc = spark._jvm, spark.sparkContext
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    found = {s.getPath().getName(): s for s in fs.listStatus(path) if s.getPath().getName() not in ignored}
    for name, s in found.items():
        if name not in contracts or not s.isDirectory():
            raise ContractError(f"{name} is not a source directory")
        for f in fs.listStatus(s.getPath()):
            if f.isDirectory() or not f.getPath().getName().endswith(".jsonl"):
                raise ContractError(f"{name}/{f.getPath().getName()} is not a .jsonl file")
    if missing := set(contracts) - set(found):
        raise ContractError(f"no directory for {sorted(missing)}")


def read_lines(spark: SparkSession, root: str, source: str, broadcast_blocks: int = 100_000) -> DataFrame:
    """``partition, line_number, value`` of every non-blank line; numbers count from 1 in each file.

    Files are split like any other input. A row's number is that of the lines
    in the file's earlier blocks (one count a block, summed up over the file)
    and its place in its own block, so it does not depend on the split size.
    """
    text = spark.read.option("lineSep", "\n").text(f"{root}/{source}")
    rows = text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value", F.monotonically_increasing_id().alias("seq"))
    blocks = rows.groupBy("path", "block").agg(F.count("*").alias("n"), F.min("seq").alias("first"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("path", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias("shift"))
    if blocks.limit(broadcast_blocks + 1).count() <= broadcast_blocks:
        blocks = F.broadcast(blocks)
    numbered = rows.join(blocks, ["path", "block"])
    out = numbered.select(F.regexp_extract("path", r"[^/]*$", 0).alias("partition"), (F.col("seq") + F.col("shift")).cast("long").alias("line_number"), F.rtrim(F.col("value"), F.lit("\r")).alias("value"))
    return out.where(F.trim("value") != "")


def _fits(kind: Column, spec: ColumnSpec) -> Column:
    ok = {"string": kind == "STRING", "integer": (kind == "BIGINT") | kind.rlike(r"^DECIMAL\(\d+,0\)$") & (kind != "DECIMAL(1,0)"), "string_list": kind.isin("ARRAY<STRING>", "ARRAY<VOID>")}[spec.type]
    return ok | (kind == "VOID") if spec.nullable else ok


BASE = ["source", "source_record_id", "partition", "line_number", "payload"]


def validate(lines: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(typed records, rejects with ``reason`` and ``details``): ``checked`` in two."""
    return divided(checked(lines, contract))


def divided(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return rows.where("reason is null").drop("reason", "details"), rows.where("reason is not null").select(*BASE, "reason", "details")


def checked(lines: DataFrame, contract: Contract) -> DataFrame:
    """All lines as records with ``reason``, null for those that keep the contract, and ``details``.

    ``lines`` has partition, line_number, value. A line is rejected when it is
    no JSON object, has another schema version, an unknown key, no required
    key, a null or a type that is not allowed, a blank key column, or ``|`` in
    a column of a composite key. Booleans and floats are no integers. Records
    have the declared columns, ``source``, ``source_record_id``, ``partition``,
    ``line_number`` and ``payload`` (the line's JSON, keys as given); a declared
    column of one of these names is to be read from the payload.
    """
    rows = lines.withColumn("v", F.try_parse_json("value"))
    is_object = F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False))
    rows = rows.withColumn("__obj", is_object)
    keys = F.when(F.col("__obj"), F.json_object_keys("value"))
    # the variant of each column once; its kind and its value come from that
    parts = {f"__v_{c}": F.when(F.col("__obj"), F.try_variant_get("v", f"$['{c}']", "variant")) for c in contract.columns}
    rows = rows.withColumns({"__keys": keys, **parts})
    rows = rows.withColumns({f"__k_{c}": F.schema_of_variant(f"__v_{c}") for c in contract.columns})
    checks = [F.when(F.size(F.array_except("__keys", F.array(*[F.lit(c) for c in contract.columns]))) > 0, "unknown_field")]
    for c, spec in contract.columns.items():
        k = F.col(f"__k_{c}")
        if spec.required:
            checks.append(F.when(k.isNull(), f"missing:{c}"))
        if not spec.nullable:
            checks.append(F.when(k == "VOID", f"null:{c}"))
        checks.append(F.when(k.isNotNull() & (k != "VOID") & ~_fits(k, spec), f"type:{c}"))
    values = {c: F.try_variant_get(f"__v_{c}", "$", SQL_TYPES[s.type]) for c, s in contract.columns.items()}
    rows = rows.withColumns(values)
    for k in contract.primary_key:
        checks.append(F.when(F.trim(F.col(k)) == "", f"blank_key:{k}"))
        if len(contract.primary_key) > 1:
            checks.append(F.when(F.col(k).contains("|"), f"separator_in_key:{k}"))
    details = F.array_compact(F.array(*checks))
    rows = rows.withColumn("details", F.when(~F.col("__obj"), F.array(F.lit("not_an_object"))).otherwise(details))
    reason = F.when(F.size("details") > 0, "source_contract_violation")
    if contract.schema_version_field:
        other = F.coalesce(F.col(contract.schema_version_field) != contract.schema_version, F.lit(False))
        reason = F.when(F.col("__obj") & other, "incompatible_schema_version").otherwise(reason)
    record_id = F.concat_ws("|", *[F.col(k) for k in contract.primary_key])
    rows = rows.withColumns({"reason": reason, "source": F.lit(contract.name), "source_record_id": record_id, "payload": F.col("value")})
    return rows.select(*BASE, *[c for c in contract.columns if c not in BASE], "reason", "details")


def signature(contract: Contract) -> Column:
    """What makes two payloads the same: which keys they have and every value, without the version column."""
    names = [c for c in contract.columns if c != contract.version_field]
    keys = F.array_sort(F.array_intersect(F.json_object_keys("payload"), F.array(*[F.lit(c) for c in names])))
    values = [tagged(F.to_json(F.col(c)) if contract.columns[c].type == "string_list" else F.col(c)) for c in names]
    return F.concat_ws("\x1f", F.array_join(keys, "\x1e"), *values)
