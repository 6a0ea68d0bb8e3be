"""Token streams for sequence models: blocks, limits, vocabulary, ids, windows, padding, masks, monitoring."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import priority
from ..sources.storage import stored
from . import ranges
from .buckets import Edges
from .identity import small

#: Special tokens in the order of their ids (fixed values).
SPECIAL = ["[PAD]", "[UNK]", "[MASK]", "[EVT]", "[USR]"]
PAD, UNK, MASK = 0, 1, 2
MISSING = "MISSING"
MIN_COUNT, EVENT_LIMIT, SEQUENCE_LIMIT = 20, 24, 8000
#: Rates above which a run is to be looked at, and stopped (fixed values).
THRESHOLDS = {"unk_rate": (0.01, 0.05), "closed_set_violation_rate": (0.0, 0.0), "truncation_rate": (0.2, 0.5), "pad_ratio": (0.3, 0.6)}


@dataclass(frozen=True)
class Slot:
    """A field of an event's block; the order of slots is their priority, the first the highest."""

    name: str
    required: bool = False
    multivalue: bool = False


def key_token(field: str) -> Column:
    return F.lit(f"key:{field}")


def value_tokens(field: str, c: Column, is_list: bool = False) -> Column:
    """One key, then a value for each item."""
    return F.concat(F.array(key_token(field)), _values(field, c, is_list))


def _values(field: str, c: Column, is_list: bool) -> Column:
    values = F.when(F.coalesce(F.size(c), F.lit(0)) > 0, c).otherwise(F.array(F.lit(MISSING))) if is_list else F.array(F.coalesce(c.cast("string"), F.lit(MISSING)))
    return F.transform(values, lambda v: F.concat(F.lit(f"value:{field}:"), F.coalesce(v, F.lit(MISSING))))


def sequence(head: str, fields: dict[str, bool], event_type: str | None = None) -> Column:
    """``[head, key, value, ...]`` in field order; ``fields``: name -> is a list."""
    parts = [F.array(F.lit(head))]
    if event_type:
        parts.append(value_tokens("event_type", F.col(event_type)))
    parts += [value_tokens(f, F.col(f), is_list) for f, is_list in fields.items()]
    return F.concat(*parts)


def limited(slots: list[Slot], most: int = EVENT_LIMIT, head: str = "[EVT]") -> Column:
    """An event's tokens within the limit.

    Lists that are not required are cut at their end first, down to one value,
    the least important list first; then fields that are not required go, the
    least important first. A key never stays without a value, a required field
    is never cut. An event whose required fields do not fit is an error.
    """
    # bound once: every cut below asks for the values again
    given = F.struct(*[_values(s.name, F.col(s.name), s.multivalue).alias(f"v{i}") for i, s in enumerate(slots)])
    return F.transform(F.array(given), lambda v: _cut({s.name: v[f"v{i}"] for i, s in enumerate(slots)}, slots, most, head))[0]


def _cut(values: dict[str, Column], slots: list[Slot], most: int, head: str) -> Column:
    size = {s.name: F.size(values[s.name]) if s.multivalue else F.lit(1) for s in slots}
    zero = F.lit(0)
    over = F.lit(1 + len(slots) - most) + sum(size.values(), zero)
    kept = dict(values)
    spare = zero  # what lists of less importance can give
    for s in reversed(slots):
        if s.multivalue and not s.required:
            own = size[s.name] - 1
            kept[s.name] = F.slice(values[s.name], F.lit(1), size[s.name] - F.greatest(zero, F.least(own, over - spare)))
            spare = spare + own
    # where that is not enough each list is down to one value, so a field that goes gives two tokens
    left = over - spare
    open_ = [s.name for s in reversed(slots) if not s.required]
    empty = F.array().cast("array<string>")
    parts = []
    for s in slots:
        block = F.concat(F.array(key_token(s.name)), kept[s.name])
        parts.append(block if s.required else F.when(left > 2 * open_.index(s.name), empty).otherwise(block))
    stop = F.raise_error(F.lit(f"the required fields of an event do not fit in {most} tokens")).cast("array<string>")
    return F.when(left > 2 * len(open_), stop).otherwise(F.concat(F.array(F.lit(head)), *parts))


def _field() -> Column:
    return F.split_part("token", F.lit(":"), F.lit(2))


def counts(token_lists: DataFrame, column: str = "tokens") -> DataFrame:
    """``token, n`` over all lists; counted before the shuffle, so a frequent token does not travel."""
    return token_lists.select(F.explode(column).alias("token")).groupBy("token").agg(F.count("*").alias("n"))


def numbered(rows: DataFrame, order: list[str], first: int, name: str = "id") -> DataFrame:
    """``rows`` with consecutive numbers in an order, without a task that sees them all: ranges are numbered and their sizes summed up."""
    dealt = stored(rows.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    sizes = dealt.groupBy("__part").agg(F.count("*").alias("__n"))
    # one row a range
    before = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select(F.col("__part").alias("__p"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    within = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return dealt.withColumn("__own", within).join(small(base), F.col("__part") == F.col("__p")).withColumn(name, (F.col("__base") + F.col("__own") - 1 + first).cast("long")).drop("__part", "__p", "__base", "__own")


def vocabulary(token_lists: DataFrame, pruned: list[str], always: list[str], min_count: int = MIN_COUNT, column: str = "tokens") -> DataFrame:
    """``token, block, id`` of special tokens (0), keys (1), closed values (2), open values that are kept (3), RARE tokens (4), each block in UTF-8 order;
    and, with a null id and block 5, the open values that were seen but rarely.

    ``pruned``: fields whose values need ``min_count`` occurrences, but for
    MISSING, which is always in; ``always``: tokens that are in whatever the
    counts. Where there are any they are all keys and closed values of the
    schema, so a value outside its domain is not learned; without them the ones
    that were seen are.
    """
    is_value = F.col("token").startswith("value:")
    open_ = is_value & _field().isin(pruned)
    known = counts(token_lists, column)
    block = F.when(F.col("token").startswith("key:"), 1).when(is_value & ~open_, 2).when(open_ & ((F.col("n") >= min_count) | F.col("token").endswith(f":{MISSING}")), 3).when(open_, 5)
    seen = known.withColumn("block", block).where("block > 2" if always else "block is not null").select("token", "block")
    spark = token_lists.sparkSession
    fixed = [(t, 1 if t.startswith("key:") else 3 if t.split(":")[1] in pruned else 2) for t in always] + [(f"value:{f}:{MISSING}", 3) for f in pruned] + [(f"value:{f}:RARE", 4) for f in pruned]
    base = seen.unionByName(spark.createDataFrame(fixed, "token string, block int")) if fixed else seen
    whole = stored(base.groupBy("token").agg(F.min("block").alias("block")))
    special = spark.createDataFrame([(t, 0, i) for i, t in enumerate(SPECIAL)], "token string, block int, id long")
    ids = numbered(whole.where("block < 5"), ["block", "token"], len(SPECIAL)).select("token", "block", "id")
    return special.unionByName(ids).unionByName(whole.where("block = 5").select("token", "block", F.lit(None).cast("long").alias("id")))


def encode(token_lists: DataFrame, vocab: DataFrame, pruned: list[str], key: list[str], column: str = "tokens", strict: bool = True) -> DataFrame:
    """``key..., pos, token, id, fate`` with fate known, rare, unk or violation.

    An open value that was seen but rarely is its field's RARE token, one that
    is new is UNK. Any other token that the vocabulary does not have (a value
    outside a closed domain, an unknown key) breaks the contract: it stops the
    encoding or, without ``strict``, has a null id.
    """
    rows = token_lists.select(*key, F.posexplode(column).alias("pos", "token"))
    v = small(vocab.select(F.col("token").alias("__t"), F.col("id").alias("__id"), F.col("block").alias("__b")))
    rows = rows.join(v, F.col("token") == F.col("__t"), "left")
    open_ = F.col("token").startswith("value:") & _field().isin(pruned)
    fate = F.when(F.col("__id").isNotNull(), "known").when(F.col("__b") == 5, "rare").when(open_, "unk").otherwise("violation")
    rows = rows.withColumn("fate", fate).drop("__t", "__b")
    # at most one RARE token a field: a literal look-up
    rare = small(vocab.where("block = 4").select(F.split_part("token", F.lit(":"), F.lit(2)).alias("__f"), F.col("id").alias("__rare")))
    rows = rows.join(rare, (F.col("fate") == "rare") & (_field() == F.col("__f")), "left")
    stop = F.raise_error(F.concat(F.lit("no token of the vocabulary and no open value: "), F.col("token"))).cast("long") if strict else F.lit(None).cast("long")
    number = F.when(F.col("fate") == "known", F.col("__id")).when(F.col("fate") == "rare", F.col("__rare")).when(F.col("fate") == "unk", F.lit(UNK).cast("long")).otherwise(stop)
    return rows.select(*key, F.col("pos").cast("long").alias("pos"), "token", number.alias("id"), "fate")


def window(events: DataFrame, most: int = SEQUENCE_LIMIT, used: Column | None = None, client: str = "client_id", n_tokens: str = "n_tokens", heavy: int = ranges.HEAVY) -> DataFrame:
    """The most recent whole events of each client that fit in ``most`` tokens beside the ``used`` ones (the profile's).

    Clients of more than ``heavy`` events are summed up by several tasks.
    """
    last = Window.partitionBy(client).orderBy(F.col("position").desc()).rowsBetween(Window.unboundedPreceding, 0)
    plain = lambda rows: rows.withColumn("__sum", F.sum(n_tokens).over(last))
    scan = lambda rows: ranges.ranged(rows, client, ["position"]).summed(n_tokens, "__sum", backward=True).done()
    rows = ranges.by_weight(events, client, plain, scan, heavy)
    return rows.where(F.col("__sum") + (used if used is not None else F.lit(0)) <= most).drop("__sum")


def deltas_after(events: DataFrame, edges: Edges | None = None, client: str = "client_id", first: Column | None = None, heavy: int = ranges.HEAVY) -> DataFrame:
    """``delta_seconds`` since the event before *among the rows left*, and ``delta``: its frozen bucket (without ``edges`` the
    seconds), or FIRST_EVENT where an event is its client's first of all (``first``; the one at position 0), or
    WINDOW_START where earlier ones were cut. Clients of more than ``heavy`` events are looked at by several tasks."""
    plain = lambda rows: rows.withColumn("__before", F.lag("ts").over(Window.partitionBy(client).orderBy("position")))
    scan = lambda rows: ranges.ranged(rows, client, ["position"]).before("ts", "__before").done()
    rows = ranges.by_weight(events, client, plain, scan, heavy)
    rows = rows.withColumn("delta_seconds", F.timestamp_diff("SECOND", F.col("__before"), F.col("ts")).cast("long")).drop("__before")
    shown = edges.column(F.col("delta_seconds").cast("decimal(38,8)")) if edges else F.col("delta_seconds").cast("string")
    begins = first if first is not None else F.col("position") == 0
    return rows.withColumn("delta", F.when(F.col("delta_seconds").isNotNull(), shown).when(begins, "FIRST_EVENT").otherwise("WINDOW_START"))


def padded(ids: Column, length: int) -> tuple[Column, Column]:
    """(ids padded on the right with PAD, attention mask)."""
    short = F.greatest(F.lit(0), F.lit(length) - F.size(ids))
    return F.concat(ids, F.array_repeat(F.lit(PAD).cast("long"), short)), F.concat(F.transform(ids, lambda _: F.lit(1)), F.array_repeat(F.lit(0), short))


def masked(encoded: DataFrame, vocab: DataFrame, key: Column, seed: int = 42, share: float = 0.15, mask: float = 0.8, random: float = 0.1) -> DataFrame:
    """``encoded`` (pos, token, id, fate) with ``action``, ``masked_id`` and ``label``.

    Of the value tokens, but those of the event type and unknown ones, a
    ``share`` is chosen by a hash of key and position, never by chance: of them
    ``mask`` become MASK, ``random`` another token of the same field (each as
    likely; RARE may be one, MISSING may not), the others stay. Their label is
    the id that they had; other positions have a null label. A field that has no
    token to give keeps its own.
    """
    name = F.concat_ws("|", key, F.col("pos").cast("string"))
    unit = lambda s: (priority(F.concat(F.lit(s), name), seed).cast("double") + 2.0**63) / 2.0**64
    field = _field()
    open_to = F.col("token").startswith("value:") & (field != "event_type") & F.col("fate").isin("known", "rare")
    kind = F.when(unit("kind") < mask, "mask").when(unit("kind") < mask + random, "random").otherwise("same")
    rows = encoded.withColumn("action", F.when(open_to & (unit("pick") < share), kind).otherwise("keep"))
    pool = vocab.where(F.col("token").startswith("value:") & F.col("id").isNotNull() & ~F.col("token").endswith(f":{MISSING}")).select(field.alias("__f"), F.col("id").alias("__new"))
    pool = pool.withColumn("__no", (F.row_number().over(Window.partitionBy("__f").orderBy("__new")) - 1).cast("long"))
    sizes = small(pool.groupBy("__f").agg(F.count("*").alias("__n")))
    swaps = F.col("action") == "random"
    rows = rows.join(sizes, swaps & (field == F.col("__f")), "left").withColumn("__at", F.floor(unit("swap") * F.col("__n"))).withColumnRenamed("__f", "__g").drop("__n")
    rows = rows.join(small(pool), (F.col("__g") == F.col("__f")) & (F.col("__at") == F.col("__no")), "left").drop("__g", "__f", "__no", "__at")
    new = F.when(F.col("action") == "mask", F.lit(MASK).cast("long")).when(swaps, F.coalesce("__new", "id")).otherwise(F.col("id"))
    return rows.withColumn("masked_id", new).withColumn("label", F.when(F.col("action") != "keep", F.col("id"))).drop("__new")


def decode(encoded: DataFrame, vocab: DataFrame, key: list[str]) -> DataFrame:
    """Token lists from ids."""
    named = encoded.drop("token").join(small(vocab.where("id is not null").select("id", "token")), "id")
    return named.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "token"))), lambda x: x["token"]).alias("tokens"))


def judged(rows: DataFrame) -> DataFrame:
    level = F.lit(None).cast("string")
    for metric, (warn, stop) in THRESHOLDS.items():
        level = F.when(F.col("metric") == metric, F.when(F.col("rate") > stop, "critical").when(F.col("rate") > warn, "warning").otherwise("normal")).otherwise(level)
    rate = F.try_divide(F.col("hits").cast("double"), F.col("total").cast("double"))
    return rows.withColumn("rate", rate).withColumn("level", F.when(F.col("rate").isNotNull(), level))


def monitoring(encoded: DataFrame, pruned: list[str], windows: DataFrame, length: int, client: str = "client_id") -> DataFrame:
    """``metric, label, hits, total, rate, level``: unknown and rare open values by field, broken contracts, cut histories,
    windows that start in the middle, padding.

    ``encoded``: token, fate of every position, not strictly encoded;
    ``windows``: a row a client with ``all_events``, ``kept_events`` and ``n_ids``, padded to ``length``.
    """
    value = F.col("token").startswith("value:")
    own = encoded.where(value & _field().isin(pruned)).groupBy(_field().alias("label")).agg(F.count("*").alias("total"), *[F.count_if(F.col("fate") == f).alias(f) for f in ("unk", "rare")])
    open_ = own.select("label", F.explode(F.array(*[F.struct(F.lit(f"{f}_rate").alias("metric"), F.col(f).alias("hits")) for f in ("unk", "rare")])).alias("m"), "total").select("m.metric", "label", "m.hits", "total")
    closed = encoded.where(~value | ~_field().isin(pruned)).agg(F.lit("closed_set_violation_rate").alias("metric"), F.lit("").alias("label"), F.count_if(F.col("fate") == "violation").alias("hits"), F.count("*").alias("total"))
    cut = F.col("kept_events") < F.col("all_events")
    three = windows.agg(F.array(
        F.struct(F.lit("truncation_rate").alias("metric"), F.count_if(cut).alias("hits"), F.count("*").alias("total")),
        F.struct(F.lit("window_start_rate").alias("metric"), F.count_if(cut & (F.col("kept_events") > 0)).alias("hits"), F.count_if(F.col("kept_events") > 0).alias("total")),
        F.struct(F.lit("pad_ratio").alias("metric"), F.coalesce(F.sum(F.greatest(F.lit(0), length - F.col("n_ids"))), F.lit(0)).cast("long").alias("hits"), (F.count("*") * length).alias("total")),
    ).alias("m")).select(F.explode("m").alias("m")).select("m.metric", F.lit("").alias("label"), "m.hits", "m.total")
    return judged(open_.unionByName(closed).unionByName(three))
