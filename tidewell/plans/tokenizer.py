"""From prepared clients to model input: a vocabulary frozen beside the state it was built on, and sequences encoded with it.

``fit`` counts open values over prepared training rows and binds the vocabulary
to the hash of the preparation's state; ``freeze`` and ``thaw`` move it between
processes; ``encode`` refuses rows that another state prepared. Events become
ids where they are, without a shuffle; the window drops what a client's
sequence cannot hold before any client is put together, so a client is never
more than one window in a task, however long its history.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field, replace
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import hashing
from ..operators import tokens
from ..operators.buckets import Edges
from ..operators.fields import MISSING
from ..sources import storage
from .documents import canonical
from .preparation import StateMismatch

#: A vocabulary of at most so many rows goes to every task whole; a larger one is joined.
LOOKED_UP = 2_000_000
#: Values of the time channel that are no bucket, by id; bucket i has the id i + 2 (fixed values).
RESERVED = ("FIRST_EVENT", "WINDOW_START")


class ForeignVocabulary(RuntimeError):
    """The vocabulary's content is not what its name says."""


@dataclass(frozen=True)
class Layout:
    """Which fields become tokens, in which order, and within which limits.

    ``events``: event type -> fields in order of priority, ``lists``: fields that
    hold several values, ``closed``: field -> all its values, ``open``: fields
    whose rare values are merged.
    """

    events: dict[str, tuple[str, ...]]
    profile: tuple[str, ...]
    closed: dict[str, tuple[str, ...]]
    open: tuple[str, ...]
    delta: tuple[str, ...] = ()
    lists: tuple[str, ...] = ()
    min_count: int = tokens.MIN_COUNT
    event_limit: int = tokens.EVENT_LIMIT
    sequence_limit: int = tokens.SEQUENCE_LIMIT

    def always(self) -> list[str]:
        """Keys and closed values: in the vocabulary whatever was seen."""
        names = dict.fromkeys(["event_type", *(n for t in self.events.values() for n in t), *self.profile])
        keys = [f"key:{n}" for n in names]
        return keys + [f"value:event_type:{t}" for t in self.events] + [f"value:{n}:{v}" for n, vs in self.closed.items() if n in names for v in dict.fromkeys([*vs, MISSING])]

    def edges(self) -> Edges:
        return Edges(tuple(Decimal(e) for e in self.delta))

    def slots(self, event_type: str) -> list[tokens.Slot]:
        return [tokens.Slot("event_type", required=True), *[tokens.Slot(n, multivalue=n in self.lists) for n in self.events[event_type]]]


def layout_of(documents: dict[str, str], **limits) -> Layout:
    """The layout that the documents beside a prepared output (``plans.documents.prepared``) describe."""
    schema, rank = json.loads(documents["feature_schema.json"]), json.loads(documents["field_priority.json"])
    domains = json.loads(documents["closed_set_domains.json"]) | json.loads(documents["bucket_field_domains.json"])
    kept = {s: tuple(sorted((n for n, f in model.items() if f["vocabulary"] != "excluded"), key=rank[s].get)) for s, model in schema.items()}
    every = {n: f for s, model in schema.items() for n, f in model.items() if n in kept[s]}
    types = domains.pop("event_type")
    return Layout(
        {t: kept[t] for t in types if t in kept}, kept["PROFILE"], {n: tuple(v) for n, v in sorted(domains.items()) if n in every}, tuple(sorted(n for n, f in every.items() if f["vocabulary"] == "frequency_pruned")),
        tuple(json.loads(documents["time_delta_edges.json"])["edges"]), tuple(sorted(n for n, f in every.items() if f["multivalue"])), **limits,
    )


@dataclass(frozen=True)
class Prepared:
    """Prepared rows and the hash of the state that made them.

    ``events``: client_id, event_id, event_type, position, ts,
    hour_of_day_local, day_of_week_local, lifetime_first, fields (JSON text);
    ``profiles``: client_id, fields.
    """

    events: DataFrame
    profiles: DataFrame
    state_sha256: str


def read_prepared(spark: SparkSession, path: str) -> tuple[Prepared, dict[str, str]]:
    """What ``storage.write_outputs`` wrote, with its documents. Positions are those of the ordering key."""
    names = ("feature_schema", "closed_set_domains", "bucket_field_domains", "field_priority", "time_delta_edges", "metadata")
    documents = {f"{n}.json": storage.read_text(spark, f"{path}/{n}.json") for n in names}
    shape = "client_id string, event_id string, event_type string, timestamp_utc string, ordering_key string, fields string, calendar_time_features struct<hour_of_day_local:long,day_of_week_local:long>, lifetime_first boolean, position long"
    e = spark.read.schema(shape).json(f"{path}/prepared_events")
    ts = F.to_timestamp_ntz("timestamp_utc", F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    e = e.select("client_id", "event_id", "event_type", ts.alias("ts"), "ordering_key", "fields", "calendar_time_features.*", "lifetime_first")
    p = spark.read.schema("client_id string, fields string").json(f"{path}/prepared_profile")
    return Prepared(e, p, json.loads(documents["metadata.json"])["preprocessing_state_sha256"]), documents


def of_encoded(encoded, artifacts) -> Prepared:
    """The rows that ``preparation.encode`` gave, as they are."""
    return Prepared(encoded.events, encoded.profiles, artifacts.sha256())


def _columns(names, lists) -> list[Column]:
    """The fields of a JSON object as columns: a text, or a list of texts where the field holds several."""
    out = []
    for n in names:
        value = F.col("__f").getField(n)
        out.append((F.when(value.startswith("["), F.from_json(value, "array<string>")) if n in lists else value).alias(n))
    return out


def event_tokens(events: DataFrame, layout: Layout) -> DataFrame:
    """``events`` without ``fields`` and with ``tokens``, each event within the limit; types that the layout does not have are an error."""
    names = list(dict.fromkeys(n for t in layout.events.values() for n in t))
    rest = [c for c in events.columns if c != "fields"]
    shape = "struct<" + ",".join(f"`{n}`:string" for n in names or ["none"]) + ">"
    flat = events.withColumn("__f", F.from_json("fields", shape)).select(*rest, *_columns(names, layout.lists))
    shown = F.raise_error(F.concat(F.lit("no fields are known of the event type "), F.col("event_type"))).cast("array<string>")
    for t in layout.events:
        shown = F.when(F.col("event_type") == t, tokens.limited(layout.slots(t), layout.event_limit)).otherwise(shown)
    return flat.select(*rest, shown.alias("tokens"))


def profile_tokens(profiles: DataFrame, layout: Layout) -> DataFrame:
    """``client_id, tokens``."""
    shape = "struct<" + ",".join(f"`{n}`:string" for n in layout.profile or ["none"]) + ">"
    flat = profiles.withColumn("__f", F.from_json("fields", shape)).select("client_id", *_columns(layout.profile, layout.lists))
    return flat.select("client_id", tokens.sequence("[USR]", {n: n in layout.lists for n in layout.profile}).alias("tokens"))


@dataclass(frozen=True)
class Tokenizer:
    """A frozen vocabulary (token, block, id), its layout and the state that its training rows were prepared with."""

    layout: Layout
    vocab: DataFrame
    state_sha256: str
    digest: str = ""
    rows: int = 0
    meta: dict = field(default_factory=dict)

    def document(self) -> dict:
        return {"layout": asdict(self.layout), "preprocessing_state_sha256": self.state_sha256, "vocabulary": {"sha256": self.digest, "rows": self.rows}, "reserved_deltas": list(RESERVED)}

    def sha256(self) -> str:
        return hashlib.sha256(canonical(self.document()).encode()).hexdigest()


def _bound(t: Tokenizer) -> Tokenizer:
    digest, rows = hashing.table_digest(t.vocab.select("token", "block", "id"))
    return replace(t, digest=digest, rows=rows)


def fit(prepared: Prepared, layout: Layout) -> Tokenizer:
    """Build the vocabulary over prepared training rows: counts only for open values, everything else from the layout."""
    lists = event_tokens(prepared.events, layout).select("tokens").unionByName(profile_tokens(prepared.profiles, layout).select("tokens"))
    vocab = storage.stored(tokens.vocabulary(lists, list(layout.open), layout.always(), layout.min_count))
    return _bound(Tokenizer(layout, vocab, prepared.state_sha256))


def freeze(t: Tokenizer, path: str) -> str:
    """Write the vocabulary and the document that names it; returns the tokenizer's hash."""
    spark = t.vocab.sparkSession
    t.vocab.repartitionByRange("block", "id").sortWithinPartitions("block", "id", "token").write.mode("overwrite").json(f"{path}/vocabulary")
    storage.write_text(spark, f"{path}/tokenizer.json", canonical(t.document() | {"sha256": t.sha256()}))
    return t.sha256()


def thaw(spark: SparkSession, path: str) -> Tokenizer:
    """What ``freeze`` wrote; raises when the vocabulary or the document is not the one that the hash names."""
    doc = json.loads(storage.read_text(spark, f"{path}/tokenizer.json"))
    tuples = lambda x: tuple(x) if isinstance(x, list) else {k: tuple(v) for k, v in x.items()} if isinstance(x, dict) else x
    layout = Layout(**{k: tuples(v) for k, v in doc["layout"].items()})
    vocab = spark.read.schema("token string, block int, id long").json(f"{path}/vocabulary")
    out = _bound(Tokenizer(layout, vocab, doc["preprocessing_state_sha256"]))
    if out.sha256() != doc["sha256"] or out.digest != doc["vocabulary"]["sha256"]:
        raise ForeignVocabulary("the vocabulary differs from the one that was frozen")
    return out


def _looked_up(rows: DataFrame, vocab: DataFrame, open_: list[str]) -> DataFrame:
    """``rows`` with ``ids, n_unk, n_rare`` for their ``tokens``: one vectorised look-up a batch, no shuffle."""
    import pyarrow as pa

    known = {r["token"]: (r["id"], r["block"]) for r in vocab.collect()}  # at most LOOKED_UP rows, counted
    rare = {t.split(":")[1]: i for t, (i, b) in known.items() if b == 4}
    names = pa.array(known, pa.string())
    own = [i if i is not None else rare[t.split(":")[1]] for t, (i, _) in known.items()]
    sent = rows.sparkSession.sparkContext.broadcast((names, own, [i is None for i, _ in known.values()]))
    unk, opened = tokens.UNK, tuple(f"value:{n}:" for n in open_)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        names, own, is_rare = sent.value
        own, is_rare = np.append(np.array(own, np.int64), unk), np.append(np.array(is_rare), False)
        for b in batches:
            at = b.schema.get_field_index("tokens")
            lists = b.column(at)
            flat = lists.flatten()
            found = pc.index_in(flat, value_set=names)
            new = flat.filter(pc.is_null(found))
            strange = [t for t in pc.unique(new).to_pylist() if not t.startswith(opened)]
            if strange:
                raise ValueError(f"no token of the vocabulary and no open value: {strange[0]}")
            place = found.fill_null(len(names)).to_numpy(zero_copy_only=False)
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            counted = [np.concatenate([[0], np.cumsum(x)]) for x in (place == len(names), is_rare[place])]
            n = [pa.array((c[ends[1:]] - c[ends[:-1]]).astype(np.int32)) for c in counted]
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(own[place]))
            rest = [i for i in range(b.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in rest], ids, *n], names=[*[b.schema.names[i] for i in rest], "ids", "n_unk", "n_rare"])

    schema = rows.drop("tokens").schema.add("ids", T.ArrayType(T.LongType())).add("n_unk", T.IntegerType()).add("n_rare", T.IntegerType())
    return rows.mapInArrow(run, schema)


def _joined(rows: DataFrame, vocab: DataFrame, open_: list[str], key: list[str]) -> DataFrame:
    """The same by joins, for vocabularies of any size."""
    each = tokens.encode(rows, vocab, open_, key)
    ids = each.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "id"))), lambda x: x["id"]).alias("ids"), *[F.count_if(F.col("fate") == f).cast("int").alias(f"n_{f}") for f in ("unk", "rare")])
    return rows.drop("tokens").join(ids, key)


def with_ids(rows: DataFrame, t: Tokenizer, key: list[str]) -> DataFrame:
    """``rows`` with ``ids`` (and how many are UNK and RARE) in place of ``tokens``; a token that breaks the contract stops the job."""
    few = t.vocab.limit(LOOKED_UP + 1).count() <= LOOKED_UP
    return _looked_up(rows, t.vocab, list(t.layout.open)) if few else _joined(rows, t.vocab, list(t.layout.open), key)


def encode(prepared: Prepared, t: Tokenizer, pad_to: int | None = None, heavy: int | None = None) -> DataFrame:
    """A row for each client: its profile and its latest whole events within the limit, as ids with the time channel.

    ``client_id, n_events`` (of the window), ``all_events, n_ids, n_unk, n_rare, input_ids, attention_mask`` (both
    padded on the right to ``pad_to``, where that is given), ``event_at`` (where
    each event begins), ``event_ids, delta`` (seconds since the event before it *in the window* as frozen buckets), ``delta_ids,
    hours, weekdays``. A client with events only has no profile tokens but
    [USR]; one with a profile only has no events. Refuses rows that another state prepared.
    """
    if prepared.state_sha256 != t.state_sha256:
        raise StateMismatch("the rows were not prepared with the state that the vocabulary was built on")
    limit = t.layout.sequence_limit
    kw = {} if heavy is None else {"heavy": heavy}
    events = _positioned(prepared.events)
    profile = with_ids(profile_tokens(prepared.profiles, t.layout), t, ["client_id"]).select("client_id", F.col("ids").alias("profile_ids"), F.struct("n_unk", "n_rare").alias("of_profile"))
    rows = with_ids(event_tokens(events, t.layout), t, ["client_id", "event_id"])
    # counted, windowed and summed up: the look-up is made once
    rows = storage.stored(rows.withColumn("n_tokens", F.size("ids")))
    used = profile.select("client_id", F.size("profile_ids").alias("__used"))
    # events alone first: what a window of all tokens cannot hold goes before anything meets the profile
    kept = storage.stored(tokens.window(rows, limit - 1, **kw))
    kept = kept.join(used, "client_id", "left").withColumn("__used", F.coalesce("__used", F.lit(1)))
    kept = tokens.window(kept, limit, F.col("__used"), **kw).drop("__used")
    kept = tokens.deltas_after(kept, t.layout.edges(), first=F.col("lifetime_first"), **kw)
    reserved = F.when(F.col("delta") == RESERVED[0], 0).when(F.col("delta") == RESERVED[1], 1).otherwise(2 + F.regexp_extract("delta", "[0-9]+", 0).cast("int"))
    part = F.struct("position", "event_id", "ids", "delta", F.when(F.col("delta").isNotNull(), reserved).alias("delta_id"), F.col("hour_of_day_local").alias("hour"), F.col("day_of_week_local").alias("weekday"))
    # a window has at most ``limit`` tokens, so a client's list is bounded
    windows = kept.groupBy("client_id").agg(F.array_sort(F.collect_list(part)).alias("e"), F.sum("n_unk").alias("u"), F.sum("n_rare").alias("r"))
    totals = rows.groupBy("client_id").agg(F.count("*").alias("all_events"))
    out = totals.join(windows, "client_id", "left").join(profile, "client_id", "full")
    head = F.coalesce("profile_ids", F.array(F.lit(tokens.SPECIAL.index("[USR]")).cast("long")))
    e = F.coalesce("e", F.array().cast(windows.schema["e"].dataType))
    ids = F.concat(head, F.flatten(F.transform(e, lambda x: x["ids"])))
    begins = F.aggregate(e, F.struct(F.size(head).alias("at"), F.array().cast("array<int>").alias("all")), lambda a, x: F.struct((a["at"] + F.size(x["ids"])).alias("at"), F.concat(a["all"], F.array(a["at"])).alias("all")))["all"]
    out = out.select("client_id", F.size(e).cast("long").alias("n_events"), F.coalesce("all_events", F.lit(0)).alias("all_events"), ids.alias("ids"), begins.alias("event_at"), e.alias("e"), *[(F.coalesce(a, F.lit(0)) + F.coalesce(F.col("of_profile")[b], F.lit(0))).cast("long").alias(b) for a, b in (("u", "n_unk"), ("r", "n_rare"))])
    full, mask = tokens.padded(F.col("ids"), pad_to or 0)
    each = lambda n: F.transform("e", lambda x: x[n])
    return out.select(
        "client_id", "n_events", "all_events", F.size("ids").cast("long").alias("n_ids"), "n_unk", "n_rare", full.alias("input_ids"), mask.alias("attention_mask"), "event_at",
        each("event_id").alias("event_ids"), each("delta").alias("delta"), each("delta_id").alias("delta_ids"), each("hour").alias("hours"), each("weekday").alias("weekdays"),
    )


def _positioned(events: DataFrame) -> DataFrame:
    """With ``position``: rows read back from files have the ordering key, whose text order it is."""
    return events if "position" in events.columns else events.withColumn("position", F.col("ordering_key"))


def write(sequences: DataFrame, t: Tokenizer, path: str, lengths: tuple[int, ...] = (512, 2048, 8192)) -> None:
    """Sequences by length class, so that a batch pads little, and the name of the tokenizer that made them."""
    of = F.lit(lengths[-1])
    for n in reversed(lengths[:-1]):
        of = F.when(F.col("n_ids") <= n, n).otherwise(of)
    sequences.withColumn("length", of).write.mode("overwrite").partitionBy("length").parquet(f"{path}/sequences")
    storage.write_text(sequences.sparkSession, f"{path}/sequences.json", canonical({"tokenizer_sha256": t.sha256(), "preprocessing_state_sha256": t.state_sha256, "lengths": list(lengths)}))


def report(sequences: DataFrame, length: int) -> DataFrame:
    """``metric, hits, total, rate, level`` over all sequences: unknown ids, cut histories, windows that begin in the middle, padding."""
    cut = F.col("n_events") < F.col("all_events")
    one = lambda name, hits, total: F.struct(F.lit(name).alias("metric"), F.coalesce(hits, F.lit(0)).cast("long").alias("hits"), F.coalesce(total, F.lit(0)).cast("long").alias("total"))
    rows = sequences.agg(F.array(
        one("unk_rate", F.sum("n_unk"), F.sum("n_ids")), one("rare_rate", F.sum("n_rare"), F.sum("n_ids")), one("truncation_rate", F.count_if(cut), F.count("*")),
        one("window_start_rate", F.count_if(cut & (F.col("n_events") > 0)), F.count_if(F.col("n_events") > 0)), one("pad_ratio", F.sum(F.greatest(F.lit(0), length - F.col("n_ids"))), F.count("*") * length),
    ).alias("m")).select(F.explode("m").alias("m")).select("m.*")
    return tokens.judged(rows)


