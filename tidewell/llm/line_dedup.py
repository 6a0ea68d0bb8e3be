"""Line deduplication with a sharded minimal perfect hash.

Line keys are counted by their 128-bit hash (documents a key occurs in, each
document once). Keys that reach the threshold are dealt into shards by hash
bits; each shard becomes a minimal perfect hash over its keys (levels of bit
arrays, a key sits at the first level where it is alone) that numbers them
0..n-1, with a compact fingerprint array (64 further hash bits) and a count
array under those numbers. Documents probe the arrays: no line is joined or
shuffled a second time.

An index of at most ``group_bytes`` is broadcast, and documents probe it where
they are. Of a larger one each shard goes to the tasks that its probes are dealt
to: line hashes travel once, whatever the index's size, the lines themselves
never, and only what is to be dropped comes back to its document. A shard whose
keys are found very often is sent to several tasks.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, mark, materialize, pick, sized_slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_STRIP = b" \t\n\v\f\r"


def line_hashes(text: str | None) -> tuple[list[str], np.ndarray]:
    """The lines of a text and, per line, two uint64 hashes of its key; (0, 0) for an empty key."""
    text = text or ""
    lines = text.split("\n")
    digest = xxhash.xxh3_128_digest
    raw = [k.strip(_STRIP) for k in text.encode().lower().split(b"\n")]
    packed = b"".join([digest(k) if k else bytes(16) for k in raw])
    return lines, np.frombuffer(packed, np.uint64).reshape(-1, 2)


def mix(h: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finalizer, one member of a family for each seed."""
    x = h ^ np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class PerfectHash:
    """A minimal perfect hash over distinct uint64 keys, about three bits a key."""

    def __init__(self, keys: np.ndarray, gamma: float = 2.0, max_levels: int = 40):
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        base, left = 0, keys
        for level in range(max_levels):
            if not len(left):
                break
            size = max(64, -(-int(gamma * len(left)) // 64) * 64)
            at = (mix(left, level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            bits = np.packbits(alone, bitorder="little").view(np.uint64)
            ranks = base + np.concatenate([[0], np.cumsum(np.bitwise_count(bits))[:-1]]).astype(np.int64)
            self.levels.append((size, bits, ranks))
            base += int(alone.sum())
            left = left[~alone[at]]
        self.rest = np.sort(left)  # keys equal in every level: none in practice, exact all the same
        self.base = base
        self.n = base + len(self.rest)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; of a key that is not among them any number or -1."""
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, (size, bits, ranks) in enumerate(self.levels):
            if not len(todo):
                break
            at = (mix(keys[todo], level) % np.uint64(size)).astype(np.int64)
            word, off = at >> 6, (at & 63).astype(np.uint64)
            hit = (bits[word] >> off) & np.uint64(1) == 1
            below = np.bitwise_count(bits[word] & ((np.uint64(1) << off) - np.uint64(1)))
            out[todo[hit]] = (ranks[word] + below)[hit]
            todo = todo[~hit]
        if len(self.rest) and len(todo):
            p = np.minimum(np.searchsorted(self.rest, keys[todo]), len(self.rest) - 1)
            ok = self.rest[p] == keys[todo]
            out[todo[ok]] = self.base + p[ok]
        return out


class Shard:
    """Perfect hash, fingerprints and counts of one shard's keys."""

    def __init__(self, h1: np.ndarray, h2: np.ndarray, counts: np.ndarray):
        self.number = PerfectHash(h1)
        at = self.number(h1)
        self.fingerprints = np.empty(len(h1), np.uint64)
        self.counts = np.empty(len(h1), np.int64)
        self.fingerprints[at], self.counts[at] = h2, counts

    def plain(self) -> dict:
        """The arrays alone, for storage."""
        return {"number": dict(vars(self.number)), "fingerprints": self.fingerprints, "counts": self.counts}

    @classmethod
    def of(cls, plain: dict) -> Shard:
        out = cls.__new__(cls)
        out.number = PerfectHash.__new__(PerfectHash)
        vars(out.number).update(plain["number"])
        out.fingerprints, out.counts = plain["fingerprints"], plain["counts"]
        return out

    def count(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        at = self.number(h1)
        ok = at >= 0
        ok[ok] = self.fingerprints[at[ok]] == h2[ok]
        return np.where(ok, self.counts[np.where(ok, at, 0)], 0) if len(self.counts) else np.zeros(len(h1), np.int64)


def count_lines(docs: DataFrame, min_docs: int) -> DataFrame:
    """``h1, h2, n``: the hash of every line key found in at least ``min_docs`` documents, and in how many."""

    def run(batches):
        for b in sized_slices(batches, 0, 2048, 16 << 20):
            found = [np.unique(h.view("V16")) for h in (line_hashes(t)[1] for t in b.column(0).to_pylist())]
            keys, n = np.unique(np.concatenate(found), return_counts=True)
            h = keys.view(np.uint64).reshape(-1, 2)
            some = (h != 0).any(1)
            h, n = h[some], n[some]
            yield pa.RecordBatch.from_arrays([pa.array(h[:, 0].copy().view(np.int64)), pa.array(h[:, 1].copy().view(np.int64)), pa.array(n.astype(np.int64))], names=["h1", "h2", "n"])

    part = docs.select("text").mapInArrow(run, "h1 long, h2 long, n long")
    return part.groupBy("h1", "h2").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs)


def build_index(counted: DataFrame, keys_a_shard: int = 250_000) -> DataFrame:
    """``shard, bytes, load, body``: the pickled shards, each built by the task that holds its keys, and how often these are found."""
    import pickle

    n = counted.count()
    shards = 1 << max(0, math.ceil(math.log2(max(1, n) / keys_a_shard)))

    def build(key, pdf):
        pdf = pdf.sort_values(["h1", "h2"])
        h1, h2 = (pdf[c].to_numpy(np.int64).view(np.uint64) for c in ("h1", "h2"))
        one = np.concatenate([[True], h1[1:] != h1[:-1]])  # equal 64-bit halves: the later ones get a shard body of their own
        bodies = []
        left = np.arange(len(h1))
        while len(left):
            bodies.append(Shard(h1[left[one]], h2[left[one]], pdf["n"].to_numpy(np.int64)[left[one]]))
            left = left[~one]
            one = np.concatenate([[True], h1[left[1:]] != h1[left[:-1]]]) if len(left) else one
        body = pickle.dumps([x.plain() for x in bodies])
        import pandas as pd

        return pd.DataFrame({"shard": [int(key[0])], "bytes": [len(body)], "load": [int(pdf["n"].sum())], "body": [body]})

    bits = int(math.log2(shards))
    shard = F.shiftrightunsigned("h2", 64 - bits).cast("long") if bits else F.lit(0).cast("long")
    return counted.withColumn("shard", shard).groupBy("shard").applyInPandas(build, "shard long, bytes long, load long, body binary")


#: A shard goes to one more task for so many lines that have one of its keys.
LOAD = 2_000_000


def shard_of(h: np.ndarray, bits: int) -> np.ndarray:
    return (h[:, 1] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)


def counts_in(bodies: list[Shard], h: np.ndarray) -> np.ndarray:
    out = np.zeros(len(h), np.int64)
    for shard in bodies:
        out = np.maximum(out, shard.count(h[:, 0], h[:, 1]))
    return out


def kept(b: pa.RecordBatch, at: int, parts: list, flags: list[np.ndarray]) -> tuple[list, list[str]]:
    """A batch's columns with the lines that are flagged taken out of its texts, and the numbers of lines."""
    cols = list(b.columns)
    texts = ["\n".join([x for x, gone in zip(lines, f.tolist()) if not gone]) if f.any() else "\n".join(lines) for (lines, _), f in zip(parts, flags)]
    cols[at] = pa.array(texts, pa.string())
    return [*cols, pa.array([len(p[0]) for p in parts], pa.int64()), pa.array([int(f.sum()) for f in flags], pa.int64())], [*b.schema.names, "n_lines", "n_dropped"]


def _with_counts(flat: DataFrame) -> T.StructType:
    return T.StructType([*flat.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])


def probe_in_place(flat: DataFrame, at: int, index: DataFrame, bits: int, min_docs: int) -> DataFrame:
    """Documents probe a broadcast index; ``flat``: the text is column ``at``."""
    import pickle

    packed = flat.sparkSession.sparkContext.broadcast({r["shard"]: bytes(r["body"]) for r in index.collect()})

    def run(batches):
        shards = {s: [Shard.of(x) for x in pickle.loads(body)] for s, body in packed.value.items()}
        for b in sized_slices(batches, at, 512, 16 << 20):
            parts = [line_hashes(t) for t in b.column(at).to_pylist()]
            ends = np.cumsum([len(p[0]) for p in parts])
            h = np.concatenate([p[1] for p in parts])
            where = shard_of(h, bits)
            drop = np.zeros(len(h), bool)
            for s, bodies in shards.items():
                own = np.flatnonzero((where == s) & (h != 0).any(1))
                drop[own] = counts_in(bodies, h[own]) >= min_docs
            cols, names = kept(b, at, parts, np.split(drop, ends[:-1]))
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return flat.mapInArrow(run, _with_counts(flat))


def probe_by_shard(flat: DataFrame, at: int, index: DataFrame, bits: int, min_docs: int, load: int) -> DataFrame:
    """Probes are dealt to the tasks of their shards; ``flat`` has a ``uid`` beside the text in column ``at``."""
    import pickle

    # a number a shard on the driver: tasks of shard s are first[s] .. first[s + 1] - 1
    copies = np.ones(1 << bits, np.int64)
    for r in index.select("shard", "load").collect():
        copies[r["shard"]] = 1 + r["load"] // load
    first = np.concatenate([[0], np.cumsum(copies)])
    tasks = flat.sparkSession.sparkContext.broadcast(first)
    text = flat.columns[at]

    def probes(batches):
        first = tasks.value
        for b in sized_slices(batches, 1, 2048, 16 << 20):
            parts = [line_hashes(t)[1] for t in b.column(1).to_pylist()]
            n = np.array([len(p) for p in parts])
            h = np.concatenate(parts)
            uid = np.repeat(b.column(0).to_numpy(zero_copy_only=False), n)
            line = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
            some = (h != 0).any(1)
            h, uid, line = h[some], uid[some], line[some]
            s = shard_of(h, bits)
            task = first[s] + mix(uid.view(np.uint64), 11).view(np.int64) % (first[s + 1] - first[s])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (task, uid, line.astype(np.int32), h[:, 0].copy().view(np.int64), h[:, 1].copy().view(np.int64))], names=["task", "uid", "line", "h1", "h2"])

    def meet(batches):
        at_task, bodies = None, []
        for b in batches:
            task, uid, line, h1, h2 = (b.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            begins = np.concatenate([[0], np.flatnonzero(np.diff(task)) + 1, [len(task)]]) if len(task) else np.zeros(1, np.int64)
            for s, e in zip(begins[:-1].tolist(), begins[1:].tolist()):
                if task[s] != at_task:
                    at_task, bodies = task[s], []
                if line[s] < 0:
                    bodies = [Shard.of(x) for x in pickle.loads(b.column(5)[s].as_py())]
                    s += 1
                if not bodies or s == e:
                    continue  # no key of the shard reaches the threshold
                hit = counts_in(bodies, np.stack([h1[s:e], h2[s:e]], 1).view(np.uint64)) >= min_docs
                yield pa.RecordBatch.from_arrays([pa.array(uid[s:e][hit]), pa.array(line[s:e][hit])], names=["uid", "line"])

    asked = flat.select("uid", text).mapInArrow(probes, "task long, uid long, line int, h1 long, h2 long").withColumn("body", F.lit(None).cast("binary"))
    here = flat.sparkSession.createDataFrame([(s, int(first[s]), int(first[s + 1] - 1)) for s in range(1 << bits)], "shard long, first long, last long")
    zero = lambda n, t: F.lit(0).cast(t).alias(n)
    sent = index.select("shard", "body").join(here, "shard").select(F.explode(F.sequence("first", "last")).alias("task"), zero("uid", "long"), F.lit(-1).alias("line"), zero("h1", "long"), zero("h2", "long"), "body")
    hits = asked.unionByName(sent).repartition("task").sortWithinPartitions("task", "line").mapInArrow(meet, "uid long, line int")
    marks = hits.groupBy("uid").agg(F.collect_list("line").alias("gone"))  # no more than the document has lines

    def run(batches):
        for b in sized_slices(batches, at, 512, 16 << 20):
            parts = [line_hashes(t) for t in b.column(at).to_pylist()]
            flags = [np.zeros(len(p[0]), bool) for p in parts]
            for f, gone in zip(flags, b.column(b.num_columns - 1).to_pylist()):
                f[gone or []] = True
            cols, names = kept(b.select(list(range(b.num_columns - 1))), at, parts, flags)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    whole = flat.join(marks, "uid", "left").select(*flat.columns, "gone")
    return whole.mapInArrow(run, _with_counts(flat))


def drop_lines(docs: DataFrame, min_docs: int = 10, group_bytes: int = 32 << 20, keys_a_shard: int = 250_000, load: int = LOAD) -> DataFrame:
    """``docs`` with every line removed whose key is in at least ``min_docs`` documents.

    A key is the line stripped of ASCII white space with A-Z lower-cased; empty
    keys are never dropped. Other lines stay, joined by newlines. Same columns
    plus ``n_lines``, ``n_dropped`` (longs). A null or empty text is one empty
    line and becomes the empty string; repeated rows are documents of their
    own; an empty table gives no rows. Keys are told apart by 128 hash bits.
    The result does not depend on ``group_bytes``, which decides how an index is probed.
    """
    spark = docs.sparkSession
    since = mark()
    index = materialize(build_index(materialize(count_lines(pick(docs, "text"), min_docs)), keys_a_shard))
    size = index.agg(F.sum("bytes").alias("bytes"), F.max("shard").alias("last")).first()
    bits = max(0, math.ceil(math.log2(1 + (size["last"] or 0))))
    names = docs.columns
    at = names.index("text")
    flat = docs.toDF(*[f"c{i}" for i in range(len(names))])
    if (size["bytes"] or 0) <= group_bytes:
        out = probe_in_place(flat, at, index, bits, min_docs)
        discard(spark, since)  # the index is in a broadcast by now
    else:
        out = probe_by_shard(materialize(flat.withColumn("uid", F.monotonically_increasing_id())), at, index, bits, min_docs, load).drop("uid")
    return out.toDF(*names, "n_lines", "n_dropped")
