"""Exact Jaccard join of shingle sets by parity sketches.

A token flips one bit of a sketch, the one that its hash names. Two sketches of
the same length differ in at most as many bits as their sets have tokens that
only one of them holds, and a similarity bounds those: of sizes a and b at most
(a + b)(1 - s)/(1 + s). Sizes are cut into bands such that similar sets are of
one band or of neighbours. Within a band at most k tokens differ, so of k + g
64-bit words of a sketch at least g are equal: the words, g at a time, are keys.
Sets of few tokens, whose words would be nearly empty, have larger g. A
set is filed under the sketch of its own band and asks with that of the band below.

Keys of one set alone are dropped by a count. First each set stands against
the least one of its keys, then the greatest set of each key against what is
still of another class, which makes one class of most that belong together; then every pair of a key is looked at whose two are still in
different classes, in parts whose number grows with the key, if their
sketches differ in few enough bits. What is left is decided on the sets themselves.
"""

from __future__ import annotations

import sys
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcastable, components, discard, mark, materialize, pick, sized_slices, slices
from .simhash import _pairs, _whole_keys, mixed, shingles

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Keys of more sets are compared in parts of about so many, each against each, a task for two.
PART = 1024
#: Sets of a hub and of a block of pairs travel once for so many pairs.
STAR, BLOCK = 64, 64
#: Words that a key takes by the number of tokens that may differ, one beyond (sets of under some 50 tokens).
WORDS = {1: 4, 2: 3, 3: 2, 4: 2}
#: Rows of one or two numbers that are sent to all tasks at most (some 200 MB as hash tables); more are joined by a shuffle.
SHARED = 2_000_000


class Bands:
    """Bands of sizes for a similarity of num/den; of each its first and last size, words and words of a key."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.ends: list[int] = []

    def __reduce__(self):
        return Bands, (self.num, self.den)

    def of(self, size: int) -> int:
        """The band of a size; bands are laid out as sizes come."""
        while not self.ends or self.ends[-1] < size:
            low = self.ends[-1] + 1 if self.ends else 1
            self.ends.append(low * self.den // self.num)
        return int(np.searchsorted(self.ends, size))

    def below(self, size: int) -> int | None:
        """The band below, if sets of it can be similar to one of this size."""
        band = self.of(size)
        return band - 1 if band and -(-size * self.num // self.den) <= self.ends[band - 1] else None

    def apart(self, a, b):
        """How many tokens are in one of two similar sets only, at most."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def most(self, band: int) -> int:
        """Of a set of the band and another of it or of the band above."""
        high = self.ends[band]
        return self.apart(high, high * self.den // self.num)

    def words(self, band: int) -> int:
        k = self.most(band)
        return k + WORDS.get(k, 1) if k else 0


def parity(hashes: np.ndarray, words: int) -> np.ndarray:
    """The sketch of distinct token hashes: each flips one of 64 * words bits."""
    bits = 64 * words
    at = (mixed(hashes, 13) >> np.uint64(32)) * np.uint64(bits) >> np.uint64(32)
    return np.packbits((np.bincount(at.astype(np.int64), minlength=bits) & 1).astype(np.uint8), bitorder="little").view(np.uint64)


@lru_cache(256)
def _combined(k: int) -> np.ndarray:
    """Rows of the words' positions that make a key."""
    g = WORDS.get(k, 1)
    return np.array(list(combinations(range(k + g), g)), np.int64)


def keys_of(sketch: np.ndarray, band: int, most: int) -> np.ndarray:
    """64-bit keys of a sketch of a band in which at most ``most`` tokens differ."""
    chosen = _combined(most)
    key = mixed(np.arange(len(chosen), dtype=np.uint64) + np.uint64(band << 32), 14)
    for c in range(chosen.shape[1]):
        key = mixed(key ^ sketch[chosen[:, c]], 15 + c)
    return key


def folded(sketch: np.ndarray) -> np.ndarray:
    """A sketch of an eighth of the words, four at least; still no more bits differ than tokens."""
    n = max(4, -(-len(sketch) // 8))
    out = np.zeros(-(-len(sketch) // n) * n, np.uint64)
    out[: len(sketch)] = sketch
    return np.bitwise_xor.reduce(out.reshape(-1, n), 0)


def sets(docs: DataFrame, bands: Bands, shingle: int) -> DataFrame:
    """``key, doc_id, node, n, own, low`` of ``key, doc_id, text`` rows: the set's hash and size, its sketches in its own band and the one below.

    Texts without words have no node; small sets that only equal ones can be similar to have no sketch.
    """

    def run(batches):
        for b in sized_slices(batches, 2):
            node, size, own, low = [], [], [], []
            for t in b.column(2).cast(pa.binary()).to_pylist():
                s = np.unique(shingles(t or b"", shingle)[0])
                size.append(len(s))
                node.append(int(np.uint64(xxhash.xxh64_intdigest(s.tobytes(), 7)).view(np.int64)) if len(s) else None)
                made = [parity(s, n).tobytes() if len(s) and band is not None and (n := bands.words(band)) else None for band in (bands.of(max(1, len(s))), bands.below(max(1, len(s))))]
                own.append(made[0])
                low.append(made[1])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(node, pa.int64()), pa.array(size, pa.int64()), pa.array(own, pa.binary()), pa.array(low, pa.binary())], names=["key", "doc_id", "node", "n", "own", "low"])

    return docs.mapInArrow(run, f"key long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, node long, n long, own binary, low binary")


def keys(nodes: DataFrame, bands: Bands) -> DataFrame:
    """``key, node, ask`` of ``node, n, own, low`` rows."""

    def run(batches):
        for b in sized_slices(batches, 2, 2048):
            key, node, ask = [], [], []
            for name, n, *made in zip(*(b.column(i).to_pylist() for i in range(4))):
                for asks, sketch in enumerate(made):
                    if sketch is not None:
                        band = bands.of(n) - asks
                        k = keys_of(np.frombuffer(sketch, np.uint64), band, bands.most(band))
                        key.append(k)
                        node.append(np.full(len(k), name))
                        ask.append(np.full(len(k), bool(asks)))
            if key:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(key).view(np.int64)), pa.array(np.concatenate(node)), pa.array(np.concatenate(ask))], names=["key", "node", "ask"])

    return nodes.select("node", "n", "own", "low").mapInArrow(run, "key long, node long, ask boolean")


def shared_keys(made: DataFrame) -> DataFrame:
    """``key, node, ask, many, hub, far``: rows of the keys that two sets have, not both only asking, with the key's least and greatest set.

    Keys alone are counted, as nearly all of them belong to one set; the few others are looked up again.
    """
    often = materialize(made.groupBy("key").agg(F.count("*").alias("many")).where("many > 1"))
    rows = materialize(made.join(broadcastable(often, SHARED), "key"))
    ends = rows.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("far"), F.min("ask").alias("asked")).where("not asked").drop("asked")
    return materialize(rows.join(broadcastable(materialize(ends), SHARED), "key"))


def _pair_block(a, b):
    """A block of pairs that share the sets of ``a``, of at most about STAR pairs: the others are dealt by hash into as many blocks as the key has room for."""
    return F.xxhash64(a, F.pmod(F.xxhash64(b), F.greatest(F.lit(1), F.ceil(F.col("many") / STAR))))


def star_pairs(shared: DataFrame) -> DataFrame:
    """``block, a, b, ra, rb``: each set with one other, the least that is the least of a key of both: one journey of a set is enough for most."""
    pairs = shared.where("node != hub").groupBy(F.col("node").alias("b")).agg(F.min("hub").alias("a"), F.max("many").alias("many"))
    return pairs.select(_pair_block("a", "b").alias("block"), "a", "b", F.col("a").alias("ra"), F.col("b").alias("rb"))


def far_pairs(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """``block, a, b, ra, rb``: the greatest set of each key with every other one of it that is still of another class, each pair once."""
    rows = shared.where("node != far").select("node", "far", "many").distinct()
    rows = rows.join(roots, "node").join(roots.toDF("far", "ra"), "far").where("root != ra")
    pairs = rows.groupBy(F.col("far").alias("a"), F.col("node").alias("b")).agg(F.max("many").alias("many"), F.min("ra").alias("ra"), F.min("root").alias("rb"))
    return pairs.select(_pair_block("a", "b").alias("block"), "a", "b", "ra", "rb")


def folds(whole: DataFrame, bands: Bands) -> DataFrame:
    """``node, n, own, low``: sizes and folded sketches of whole sets (``node, s``)."""

    def run(batches):
        for b in sized_slices(batches, 1, 1024):
            made = []
            for s in b.column(1).to_pylist():
                s = np.frombuffer(s, np.uint64)
                made.append((len(s), *[folded(parity(s, n)).tobytes() if band is not None and (n := bands.words(band)) else None for band in (bands.of(len(s)), bands.below(len(s)))]))
            n, own, low = zip(*made)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(own, pa.binary()), pa.array(low, pa.binary())], names=["node", "n", "own", "low"])

    return whole.mapInArrow(run, "node long, n long, own binary, low binary")


def near_sketches(pairs: DataFrame, told: DataFrame, bands: Bands) -> DataFrame:
    """``block, a, b, ra, rb`` of the pairs whose sizes and sketches do not speak against them: no set of another pair has to travel."""

    def near(na, own_a, low_a, nb, own_b, low_b) -> bool:
        one, two = bands.of(na), bands.of(nb)
        x, y = (own_a if one <= two else low_a), (own_b if two <= one else low_b)
        if abs(one - two) > 1 or x is None or y is None or min(na, nb) * bands.den < max(na, nb) * bands.num:
            return False
        return int(np.bitwise_count(np.frombuffer(x, np.uint64) ^ np.frombuffer(y, np.uint64)).sum()) <= bands.apart(na, nb)

    def run(batches):
        for b in slices(batches, 4096):
            ok = [near(*r) for r in zip(*(b.column(i).to_pylist() for i in range(5, 11)))]
            yield pa.RecordBatch.from_arrays(b.columns[:5], names=b.schema.names[:5]).filter(pa.array(ok, pa.bool_()))

    a, b = told.toDF("a", "na", "own_a", "low_a"), told.toDF("b", "nb", "own_b", "low_b")
    rows = pairs.join(a, "a").join(b, "b").select("block", "a", "b", "ra", "rb", "na", "own_a", "low_a", "nb", "own_b", "low_b")
    return rows.mapInArrow(run, "block long, a long, b long, ra long, rb long")


def open_pairs(shared: DataFrame, roots: DataFrame, told: DataFrame, bands: Bands) -> DataFrame:
    """``block, a, b, ra, rb``: all pairs of sets of different classes that share a key and whose sketches are near enough, each once."""
    rows = shared.select("key", "node", "ask", "many").join(roots, "node")
    undone = rows.groupBy("key").agg(F.min("root").alias("one"), F.max("root").alias("other")).where("one != other").select("key")
    rows = rows.join(broadcastable(materialize(undone), SHARED), "key")
    parts = F.ceil(F.col("many") / PART)
    rows = rows.withColumns({"part": F.pmod(F.xxhash64("node", F.lit(3)), parts), "to": F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))})
    # a task has two parts of a key; pairs within one are looked at where it meets itself
    task = F.xxhash64("key", F.least("part", "to"), F.greatest("part", "to"))
    side = F.when(F.col("part") == F.col("to"), 2).otherwise((F.col("part") > F.col("to")).cast("int")).cast("long")
    rows = rows.select(task.alias("task"), side.alias("side"), "node", "root", F.col("ask").cast("long").alias("ask"))
    rows = rows.join(told, "node").select("task", "side", "node", "root", "ask", "n", F.when(F.col("ask") == 1, F.col("low")).otherwise(F.col("own")).alias("sketch"))

    def near(i, j, side, root, ask, n, lanes):
        ok = (root[i] != root[j]) & ((side[i] != side[j]) | (side[i] == 2)) & ((ask[i] == 0) | (ask[j] == 0))
        ok &= np.minimum(n[i], n[j]) * bands.den >= np.maximum(n[i], n[j]) * bands.num
        i, j = i[ok], j[ok]
        ok = np.bitwise_count(lanes[i] ^ lanes[j]).sum(1, dtype=np.int64) <= bands.apart(n[i], n[j])
        return i[ok], j[ok]

    def found(first, size, lanes, *cols):
        """Pairs of one sketch length, many small tasks at once, large ones row by row."""
        small = size <= 64
        for i, j in _pairs(first[small], size[small]):
            for at in range(0, len(i), 1 << 14):
                yield near(i[at : at + (1 << 14)], j[at : at + (1 << 14)], *cols, lanes)
        for f, m in zip(first[~small].tolist(), size[~small].tolist()):
            for i in range(f, f + m - 1):
                rest = np.arange(i + 1, f + m)
                yield near(np.full(len(rest), i), rest, *cols, lanes)

    def compare(batches):
        names = ["task", "a", "b", "ra", "rb"]
        for task, side, node, root, ask, n, sketch in _whole_keys(batches):
            size = np.array([len(s) for s in sketch])
            order = np.lexsort((task, size))  # sketches of a task are of one length
            for length in np.unique(size):
                use = order[size[order] == length]
                t = task[use]
                lanes = np.frombuffer(b"".join(sketch[use].tolist()), np.uint64).reshape(len(use), -1)
                first = np.concatenate([[0], np.flatnonzero(np.diff(t)) + 1])
                held: list[np.ndarray] = []
                cols = [x[use] for x in (side, root, ask, n)]
                for i, j in found(first, np.diff(np.concatenate([first, [len(t)]])), lanes, *cols):
                    if len(i):
                        a, b = node[use][i], node[use][j]
                        turn = a > b
                        i, j = np.where(turn, j, i), np.where(turn, i, j)
                        held.append(np.stack([t[i], node[use][i], node[use][j], root[use][i], root[use][j]]))
                    if sum(h.shape[1] for h in held) > 50_000:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in np.concatenate(held, 1)], names=names)
                        held = []
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in np.concatenate(held, 1)], names=names)

    dealt = rows.where("sketch is not null").repartition("task").sortWithinPartitions("task")
    pairs = dealt.mapInArrow(compare, "task long, a long, b long, ra long, rb long")
    pairs = pairs.groupBy("a", "b").agg(F.min("task").alias("task"), F.min("ra").alias("ra"), F.min("rb").alias("rb"))
    cell = lambda c: F.pmod(F.xxhash64(c, F.lit(5)), F.lit(PART // BLOCK))
    return pairs.select(F.xxhash64("task", cell("a"), cell("b")).alias("block"), "a", "b", "ra", "rb")


def whole_sets(asked: DataFrame, nodes: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """``node, s``: sorted hashes of the distinct shingles of the nodes asked for, made again from one text of each."""

    def run(batches):
        for b in sized_slices(batches, 1, 512):
            made = [np.unique(shingles(t or b"", shingle)[0]).tobytes() for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.binary())], names=["node", "s"])

    wanted = materialize(nodes.select("node", F.col("doc_id").alias("id"), F.col("key").alias("k")).join(asked, "node"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("k"))
    made = materialize(texts.join(broadcastable(wanted, SHARED), same).select("node", "text").mapInArrow(run, "node long, s binary"))
    return made if made.count() == wanted.count() else made.dropDuplicates(["node"])  # repeated rows


def confirmed(pairs: DataFrame, whole: DataFrame, bands: Bands) -> DataFrame:
    """``a, b``: the classes (``ra, rb``) of the pairs that are similar, decided on the sets.

    All pairs of a ``block`` are looked at by one task, to which each set goes once.
    """

    def verify(batches):
        at, held = None, {}
        for b in slices(batches, 512):
            ok = set()
            for block, x, y, ra, rb, s in zip(*(b.column(i).to_pylist() for i in range(6))):
                if block != at:
                    at, held = block, {}
                if s is not None:
                    held[x] = np.frombuffer(s, np.uint64)
                    continue
                n = len(held[x]) + len(held[y])
                union = len(np.union1d(held[x], held[y]))
                if bands.den * (n - union) >= bands.num * union:
                    ok.add((ra, rb))
            if ok:
                a, b = zip(*ok)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    none = lambda t: F.lit(None).cast(t)
    asked = materialize(pairs.select("block", F.explode(F.array("a", "b")).alias("node")).distinct())
    sent = whole.join(broadcastable(asked, SHARED), "node")
    rows = sent.select("block", F.col("node").alias("x"), none("long").alias("y"), none("long").alias("ra"), none("long").alias("rb"), "s")
    rows = rows.unionByName(pairs.select("block", F.col("a").alias("x"), F.col("b").alias("y"), "ra", "rb", none("binary").alias("s")))
    dealt = rows.repartition("block").sortWithinPartitions("block", F.col("y").asc_nulls_first())
    return dealt.mapInArrow(verify, "a long, b long").distinct()


def similar_roots(rows: DataFrame, texts: DataFrame, bands: Bands, shingle: int) -> DataFrame:
    """``node, root`` of the nodes that are similar to another one, directly or over others."""
    # one row of each set has its sketches looked at; only its number is compared with others
    first = materialize(rows.where("node is not null").groupBy("node").agg(F.min("row").alias("row")).select("row"))
    nodes = rows.join(broadcastable(first, SHARED), "row", "left_semi")
    shared = shared_keys(keys(nodes, bands))
    root = materialize(shared.select("node").distinct().withColumn("root", F.col("node")))
    whole = whole_sets(root.select("node"), nodes, texts, shingle)

    def grown(root: DataFrame, pairs: DataFrame) -> DataFrame:
        wide = components(confirmed(materialize(pairs), whole, bands)).toDF("root", "wide")
        return materialize(root.join(wide, "root", "left").select("node", F.coalesce("wide", "root").alias("root")))

    told = materialize(folds(whole, bands))
    root = grown(root, near_sketches(star_pairs(shared), told, bands))
    root = grown(root, near_sketches(far_pairs(shared, root), told, bands))
    return grown(root, open_pairs(shared, root, told, bands))


def classes(docs: DataFrame, similarity: tuple[int, int] = (90, 100), shingle: int = 3) -> DataFrame:
    """One row per document: ``doc_id, n_shingles`` (distinct ones) and ``component_id``.

    Documents link where den * |both| >= num * |either| for (num, den) =
    ``similarity``, at least one half. ``component_id`` is the smallest doc_id reachable by links,
    itself included; a text of fewer words is one shingle; null texts and those without words have
    none and stand alone. Repeated rows are documents of their own; a row without a doc_id
    gets the smallest of its class (null where none has one). An empty table
    gives no rows; other columns are ignored. ``docs`` is read twice and has to give the same rows.
    """
    bands = Bands(*similarity)
    texts = pick(docs, "doc_id", "text").select(F.xxhash64("text").alias("key"), "doc_id", "text")
    rows = materialize(sets(texts, bands, shingle).withColumn("row", F.monotonically_increasing_id()))
    since = mark()
    root = similar_roots(rows, texts, bands, shingle)
    low = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("low")).join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = low.groupBy("root").agg(F.min("low").alias("component_id"))
    member = materialize(low.join(least, "root").select("node", "component_id"))
    discard(docs.sparkSession, since, keep=1)
    out = rows.select("node", "doc_id", F.col("n").alias("n_shingles")).join(member, "node", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
