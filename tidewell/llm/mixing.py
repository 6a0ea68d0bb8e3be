"""Mixing sources to target weights with a low-discrepancy source schedule.

The mix is a sequence of slots of equally many words. Slot ``i`` falls on the
golden-ratio point ``frac((i + 1) * phi)``; mapped through the cumulative target
shares, it names a source. The slots of a source are ranked; the documents of a
source, in shuffled (hash) order, are one stream of words cut into blocks as long
as a slot; the slot of rank ``k`` takes block ``k`` (again from the first when
the stream ends). Every prefix of the schedule is near the target shares, and a
source takes its target exactly (rounded to a word): slots past it fall out, and
where the points gave too few, slots are added at the end.

Ranks and running sums never go through one task a source: rows are counted in
chunks of a source, the chunks are summed, and rows are ranked within a chunk.
Only DataFrame and SQL functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, broadcastable, materialize, pick, release

#: Fractional part of the golden ratio, the step of the points (fixed value).
PHI = 0.6180339887498949
WEIGHTS = (5, 2, 1)
#: Equal cells of the unit interval through which points find their source: so many at least, and four a source.
CELLS = 1024
CHUNK = 8192
#: Sources beyond which the source table is shuffled and no longer broadcast.
MAX_BROADCAST_SOURCES = 10_000


def n_words(text: Column) -> Column:
    """Number of runs of non-white-space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``src, no, source_size, target, quota`` for each source (``src``, ``source_size``).

    Sources by code point, null last, weigh ``weights`` in turn and share
    ``share`` times all sizes; none gets more than ``most`` times its size, and
    the excess goes to the others by weight until none is above. That end state
    is found at once: sorted by cap over weight, the first sources are at their
    cap and the level of the others is the rest over their weight. This is a
    window over one row a source.
    """
    order = Window.orderBy(F.col("src").isNull(), "src")
    s = sizes.withColumn("no", F.row_number().over(order) - 1)
    s = s.withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("no") % len(weights) + 1).cast("int")))
    s = s.withColumn("cap", most * F.col("source_size"))
    before = Window.orderBy(F.col("cap") / F.col("w"), "no").rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).partitionBy()
    s = s.withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0))).withColumn("spent", F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    s = s.withColumn("level", (share * F.sum("source_size").over(everyone) - F.col("capped")) / (F.sum("w").over(everyone) - F.col("spent")))
    # the level that holds: that of the first source, in this order, which it does not lift above its cap
    s = s.withColumn("held", F.min_by("level", F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), "no"))).over(everyone))
    target = F.least("cap", F.coalesce(F.col("held") * F.col("w"), F.col("cap")))
    return s.select("src", F.col("no").cast("long").alias("no"), "source_size", target.alias("target")).withColumn("quota", F.least(F.floor(F.col("target") + 0.5), (most * F.col("source_size")).cast("long")).cast("long"))


def stream(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """``docs`` (doc_id, src, size, h) of a size above 0 with ``no`` and ``start``, the words of the source before them."""
    rows = docs.where("size > 0").join(broadcastable(sources.select(F.col("src").alias("s"), "no", "n_docs"), MAX_BROADCAST_SOURCES), F.col("src").eqNullSafe(F.col("s"))).drop("s")
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n_docs") / CHUNK))).cast("int")
    rows = rows.withColumn("bits", bits).withColumn("chunk", F.expr("shiftright(h, 60 - bits)")).drop("bits")
    sums = rows.groupBy("no", "chunk").agg(F.sum("size").alias("words"))
    base = sums.withColumn("base", F.coalesce(F.sum("words").over(Window.partitionBy("no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("words")
    within = Window.partitionBy("no", "chunk").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("own", F.coalesce(F.sum("size").over(within), F.lit(0)))
    return rows.join(base, ["no", "chunk"]).withColumn("start", F.col("base") + F.col("own")).drop("base", "own", "chunk", "n_docs", "h")


def schedule(spark, sources: DataFrame, slot_words: int) -> DataFrame:
    """``slot, no, rank``: which source each slot takes, and the slot's rank among that source's.

    ``sources``: no, target, quota. Slots whose rank lies past the source's quota are out.
    """
    total = sources.agg(F.sum("quota")).first()[0] or 0
    n = -(-int(total) // slot_words)
    everyone = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = Window.orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    cum = sources.where("quota > 0").withColumn("hi", F.sum("target").over(upto) / F.sum("target").over(everyone))
    cum = cum.withColumn("lo", F.coalesce(F.lag("hi").over(Window.orderBy("no")), F.lit(0.0))).withColumn("hi", F.when(F.lead("no").over(Window.orderBy("no")).isNull(), 1.0).otherwise(F.col("hi")))
    cum = cum.withColumn("need", F.ceil(F.col("quota") / slot_words).cast("long"))
    # through cells: an equi-join; a large source has many cells, a small one shares a cell with few others on average
    n_cells = max(CELLS, 4 * sources.count())
    cells = cum.withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") * n_cells), F.least(F.lit(n_cells - 1), F.floor(F.col("hi") * n_cells)))))
    cells = broadcastable(materialize(cells.select("no", "lo", "hi", "need", "cell")), MAX_BROADCAST_SOURCES + CELLS)
    points = spark.range(n).select(F.col("id").alias("slot"), ((F.col("id") + 1) * PHI).alias("u")).withColumn("u", F.col("u") - F.floor("u"))
    points = points.withColumn("cell", F.floor(F.col("u") * n_cells)).withColumn("chunk", F.floor(F.col("slot") / CHUNK))
    drawn = points.join(cells, "cell").where("u >= lo AND u < hi").select("slot", "chunk", "no", "need")
    sums = drawn.groupBy("no", "chunk").agg(F.count("*").alias("n"))
    base = sums.withColumn("base", F.coalesce(F.sum("n").over(Window.partitionBy("no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    ranked = drawn.withColumn("rank", F.row_number().over(Window.partitionBy("no", "chunk").orderBy("slot")) - 1).join(base, ["no", "chunk"]).withColumn("rank", F.col("rank") + F.col("base"))
    ranked = ranked.where("rank < need").select("slot", "no", "rank")
    # slots that the points did not give: behind all others, in order of source and rank
    had = sums.groupBy("no").agg(F.sum("n").alias("had"))
    short = cum.join(had, "no", "left").withColumn("had", F.coalesce("had", F.lit(0))).where("had < need")
    added = short.select("no", F.explode(F.sequence("had", F.col("need") - 1)).alias("rank")).select((F.lit(n) + F.xxhash64("no", "rank").bitwiseAND(F.lit((1 << 40) - 1))).alias("slot"), "no", "rank")
    return ranked.unionByName(added)


def plan(docs: DataFrame, slot_words: int = 1024, seed: str = "mix", source: str = "source") -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(documents, sources, stream, mix).

    documents: doc_id, src, size; sources: src, no, source_size, target, quota;
    stream: doc_id, size, no, start of the documents with words; mix: slot, no, rank, start,
    doc_id, size, from_word, to_word, one row for each part of a document that a
    slot takes, in the order of ``slot`` and ``from_word + start``.
    """
    base = pick(docs, "doc_id", source, "text").select("doc_id", F.col(source).alias("src"), n_words(F.col("text")).alias("size"))
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    base = materialize(base.withColumn("key", key).withColumn("h", F.conv(F.substring("key", 1, 15), 16, 10).cast("long")))
    by = base.groupBy("src").agg(F.sum("size").alias("source_size"), F.count(F.when(F.col("size") > 0, 1)).alias("n_docs"))
    by = materialize(by)
    sources = materialize(targets(by.drop("n_docs")).join(by.select(F.col("src").alias("s"), "n_docs"), F.col("src").eqNullSafe(F.col("s"))).drop("s"))
    rows = materialize(stream(base, sources))
    release(docs.sparkSession)
    # stored: its broadcasts are not held together with those of what follows
    slots = materialize(schedule(docs.sparkSession, sources, slot_words))
    release(docs.sparkSession)
    facts = broadcastable(sources.select("no", "source_size", "quota"), MAX_BROADCAST_SOURCES)
    # a slot takes the words [rank * slot_words, + slot_words) of the source's endless stream, up to the quota;
    # where the stream ends inside a slot, its blocks are two
    cut = slots.join(facts, "no").withColumn("a", F.col("rank") * slot_words).withColumn("b", F.least(F.col("a") + slot_words, "quota"))
    turns = cut.withColumn("turn", F.explode(F.sequence(F.floor(F.col("a") / F.col("source_size")), F.floor((F.col("b") - 1) / F.col("source_size")))))
    turns = turns.withColumn("a", F.greatest(F.lit(0).cast("long"), F.col("a") - F.col("turn") * F.col("source_size"))).withColumn("b", F.least("source_size", F.col("b") - F.col("turn") * F.col("source_size")))
    blocks = turns.withColumn("block", F.explode(F.sequence(F.floor(F.col("a") / slot_words), F.floor((F.col("b") - 1) / slot_words)))).select("slot", "no", "rank", "a", "b", "block")
    parts = rows.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / slot_words), F.floor((F.col("start") + F.col("size") - 1) / slot_words))))
    met = parts.join(blocks, ["no", "block"])
    lo = F.greatest("a", "start", F.col("block") * slot_words)
    hi = F.least("b", F.col("start") + F.col("size"), (F.col("block") + 1) * slot_words)
    mix = met.withColumn("from_word", lo - F.col("start")).withColumn("to_word", hi - F.col("start")).where("to_word > from_word")
    return base, sources, rows, mix.select("slot", "no", "rank", "start", "doc_id", "size", "from_word", "to_word")


def mixed(docs: DataFrame, slot_words: int = 1024) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken`` (words the mix takes, repeats counted).

    Null and empty texts have size 0 and are never taken; a null source is a
    source of its own, the last; repeated rows are documents of their own;
    without any words all targets are 0; an empty table gives no rows.
    """
    base, sources, rows, mix = plan(docs, slot_words)
    # every row with words has a place of its own in its source's stream
    taken = mix.groupBy("no", "start").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    full = rows.select("doc_id", "size", "no", "start").join(taken, ["no", "start"], "left").select("doc_id", "size", "no", F.coalesce("taken", F.lit(0)).alias("taken"))
    known = broadcastable(sources.select(F.col("src").alias("s"), F.col("no").alias("n")), MAX_BROADCAST_SOURCES)
    empty = base.where("size = 0").join(known, F.col("src").eqNullSafe(F.col("s"))).select("doc_id", "size", F.col("n").alias("no"), F.lit(0).cast("long").alias("taken"))
    facts = broadcastable(sources.select(F.col("no").alias("n"), "source_size", "target"), MAX_BROADCAST_SOURCES)
    return full.unionByName(empty).join(facts, F.col("no") == F.col("n")).select("doc_id", "size", "source_size", "target", "taken")
