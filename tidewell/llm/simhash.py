"""SimHash near-duplicates by Golay-code fuzzy hashing.

Fingerprints of 64 bits link when at most three bits differ. The 64 bits are
two parts of 23, which the perfect (23,12) Golay code decodes, and a rest of 18.
A word at distance one decodes to one of at most six codewords that the query's
own neighbourhood decodes to, so the index side files a fingerprint under one
codeword index and the query side asks for at most six. Where three errors can
be leaves no case out:

* none in the rest: a part has at most one, and the key is its codeword index
  with the rest;
* one in the rest, so a half of the rest has none: the key is that half with a
  part that has none or, where both parts have one, with the codeword index of the
  first and the half of the second that has none;
* more in the rest: a part has none and a half of the other one neither; they are the key.

Keys have 30 to 35 bits. Index and query rows meet by key, candidates are
verified on all 64 bits, and only a spanning forest of each key's links is
emitted, never all its pairs. Components of those links equal components of all
links.

``keep_one`` goes further, to documents whose distinct five-word shingles have a
similarity (Jaccard) of 0.8 or more. Links of up to three bits are candidates
there, as are documents that agree in one of 42 bands of six min-hash lanes: a
pair at 0.8 agrees in none with a chance of 0.738^42, three in a million,
however it was edited. First one document of each band stands against the others,
which makes one class of most that belong together; then every pair of a band is
looked at whose two are still in different classes, whatever the band's size.
All 256 lanes have to agree as a pair at 0.8 does but for one chance in 100,000,
and what is left is confirmed on the shingle sets themselves. Sets are sent once
for a block of pairs, not for each.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcastable, components, discard, mark, materialize, pick, release, sized_slices, slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Generator polynomial of the binary Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 (fixed value).
GOLAY_GENERATOR = 0b101011100011
#: Buckets of up to so many fingerprints are compared pair by pair, larger ones by search.
SMALL_BUCKET = 64


class _Golay:
    """The decoding table, made once a process; it is not sent with the functions that use it."""

    def __init__(self):
        self.made: np.ndarray | None = None

    def __reduce__(self):
        return _Golay, ()

    def table(self) -> np.ndarray:
        if self.made is None:
            words = np.zeros(4096, np.int64)
            for bit in range(12):
                words[(np.arange(4096) >> bit) & 1 == 1] ^= GOLAY_GENERATOR << bit
            bits = 1 << np.arange(23)
            errors = [0, *bits]
            errors += [a | b for i, a in enumerate(bits) for b in bits[:i]]
            errors += [a | b | c for i, a in enumerate(bits) for j, b in enumerate(bits[:i]) for c in bits[:j]]
            self.made = np.empty(1 << 23, np.int16)
            for e in errors:
                self.made[words ^ int(e)] = np.arange(4096)
        return self.made


_GOLAY = _Golay()


def golay_table() -> np.ndarray:
    """For each 23-bit word the index (0..4095) of the one codeword within three bits."""
    return _GOLAY.table()


def parts(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two parts of 23 bits and the rest of 18 of fingerprints (uint64)."""
    cut = lambda at, n: ((fp >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64)
    return cut(0, 23), cut(23, 23), cut(46, 18)


def _halves(x: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray]:
    return x & ((1 << low) - 1), x >> low


def exact_keys(fp: np.ndarray) -> list[np.ndarray]:
    """Eight keys of bits taken as they are: index and query at once."""
    one, two, rest = parts(fp)
    keys = [x << 9 | h for x in (one, two) for h in _halves(rest, 9)] + [x << 12 | h for x, y in ((one, two), (two, one)) for h in _halves(y, 12)]
    return [np.int64(t) << 40 | k for t, k in enumerate(keys)]


def index_keys(fp: np.ndarray) -> list[np.ndarray]:
    """Six keys with a codeword index that a fingerprint (uint64 array) is filed under."""
    one, two, rest = parts(fp)
    code = [golay_table()[x].astype(np.int64) for x in (one, two)]
    keys = [c << 18 | rest for c in code] + [code[0] << 21 | h << 9 | r for h in _halves(two, 12) for r in _halves(rest, 9)]
    return [np.int64(8 + t) << 40 | k for t, k in enumerate(keys)]


def query_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all keys with a codeword index to ask for: at most six for each of ``index_keys``."""
    rows, keys = [], []
    one, two, rest = parts(fp)
    for part, others in ((one, [(8, rest)]), (two, [(9, rest)]), (one, [(10 + 2 * i + j, h << 9 | r) for i, h in enumerate(_halves(two, 12)) for j, r in enumerate(_halves(rest, 9))])):
        near = np.stack([golay_table()[part]] + [golay_table()[part ^ (1 << b)] for b in range(23)], 1).astype(np.int64)
        near.sort(1)
        new = np.ones(near.shape, bool)
        new[:, 1:] = near[:, 1:] != near[:, :-1]
        r, c = np.nonzero(new)
        for t, other in others:
            rows.append(r)
            keys.append(np.int64(t) << 40 | near[r, c] << (18 if t < 10 else 21) | other[r])
    return np.concatenate(rows), np.concatenate(keys)


def shingles(text: bytes, *sizes: int) -> list[np.ndarray]:
    """XXH64 (seed 42) of all runs of so many words, repeats included, of a text in UTF-8 with A-Z lower-cased;
    of a text of fewer words one hash of them all, of one without words none."""
    words = text.lower().split()  # bytes: ASCII white space and A-Z only
    if not words:
        return [np.zeros(0, np.uint64) for _ in sizes]
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()
    digest = xxhash.xxh64_intdigest
    return [np.fromiter((digest(line[s:e], 42) for s, e in zip(starts, ends[min(k, len(words)) - 1 :])), np.uint64, max(1, len(words) - k + 1)) for k in sizes]


def majority(hashes: np.ndarray) -> int:
    """The 64 bits of which over half of the hashes are 1."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        block = hashes[at : at + 4096]
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The 64-bit fingerprint of a text in UTF-8; zero without words."""
    return majority(shingles(text, shingle)[0])


#: Lanes of a min-hash signature, a byte each; bands of them that are keys, and the lanes of a band.
LANES, BANDS, BAND = 256, 42, 6


def mixed(h: np.ndarray, seed: int) -> np.ndarray:
    """Further hashes from 64-bit ones, a family by seed."""
    x = h ^ np.uint64((0x9E3779B97F4A7C15 * seed) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def sketch(text: bytes) -> tuple[int, int, bytes]:
    """(fingerprint, hash of the set of distinct five-word shingles, min-hash signature) of a text in UTF-8."""
    three, five = shingles(text, 3, 5)
    if not len(five):
        return 0, 0, bytes(LANES)
    low = np.full(LANES, np.iinfo(np.uint64).max, np.uint64)
    lanes = np.random.default_rng(17).integers(1, 2**63, LANES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    distinct = np.unique(five)
    for at in range(0, len(distinct), 512):
        low = np.minimum(low, (mixed(distinct[at : at + 512], 99)[:, None] * lanes).min(0))
    return majority(three), xxhash.xxh64_intdigest(distinct.tobytes(), 7), ((mixed(low, 98)) >> np.uint64(56)).astype(np.uint8).tobytes()


def band_keys(sig: np.ndarray) -> np.ndarray:
    """A key for each row and band of signatures (rows of LANES bytes); its last six bits are the band's number."""
    lanes = sig[:, : BANDS * BAND].reshape(len(sig), BANDS, BAND).astype(np.uint64)
    word = (lanes << (np.arange(BAND, dtype=np.uint64) * np.uint64(8))).sum(2, dtype=np.uint64) | (np.arange(BANDS, dtype=np.uint64) << np.uint64(48))
    return ((mixed(word, 6) & ~np.uint64(63)) | np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """All columns of ``docs`` but ``text``, which it must have, and ``fp`` long, the fingerprint's 64 bits."""

    def run(batches):
        for b in slices(batches):
            texts = b.column(b.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
            fps = np.array([fingerprint(t or b"", shingle) for t in texts], np.uint64).view(np.int64)
            keep = [i for i, n in enumerate(b.schema.names) if n != "text"]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in keep] + [pa.array(fps)], names=[b.schema.names[i] for i in keep] + ["fp"])

    schema = docs.drop("text").schema.add("fp", "long")
    return docs.mapInArrow(run, schema)


def _forest(fps: np.ndarray, roots: np.ndarray, most: int) -> tuple[list[int], list[int]]:
    """Positions (i, j) of links that join the classes (``roots``) within a bucket: breadth first, what is found leaves the unvisited set."""
    a: list[int] = []
    b: list[int] = []
    left = np.arange(len(fps))
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            same = roots[left] == roots[x]
            near = (np.bitwise_count(fps[left] ^ fps[x]) <= most) | same
            if near.any():
                found = left[near]
                other = found[~same[near]]
                _, one = np.unique(roots[other], return_index=True)
                a += [int(x)] * len(one)
                b += other[one].tolist()
                left = left[~near]
                queue += found.tolist()
    return a, b


def _pairs(first: np.ndarray, size: np.ndarray):
    """Positions (i, j) of all pairs of many small buckets at once: neighbours at each offset."""
    for step in range(1, int(size.max(initial=1))):
        lens = size[size > step] - step
        i = np.repeat(first[size > step] - np.cumsum(lens) + lens, lens) + np.arange(lens.sum())
        yield i, i + step


def _whole_keys(batches):
    """Columns of an Arrow stream sorted by its first column, cut so that no key is divided."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        part = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(part[0]):
            continue
        last = part[0][-1]
        if held and held[-1][0][0] == last:  # the held key goes on over the whole batch
            held.append(part)
            continue
        cut = int(np.searchsorted(part[0], last))
        whole = [np.concatenate(x) for x in zip(*held, [p[:cut] for p in part])]
        held = [[p[cut:] for p in part]]
        if len(whole[0]):
            yield whole
    if held:
        yield [np.concatenate(x) for x in zip(*held)]


def _candidates(key, fp, roots, most, live):
    """Positions (i, j) of verified links between different classes in each key's bucket; large buckets give a forest."""
    first = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1])
    size = np.diff(np.concatenate([first, [len(key)]]))
    use = (size > 1) & live(first, size)
    big = use & (size > SMALL_BUCKET)
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for f, n in zip(first[big], size[big]):
        i, j = _forest(fp[f : f + n], roots[f : f + n], most)
        a.append(np.array(i, np.int64) + f)
        b.append(np.array(j, np.int64) + f)
    for i, j in _pairs(first[use & ~big], size[use & ~big]):
        ok = (np.bitwise_count(fp[i] ^ fp[j]) <= most) & (roots[i] != roots[j])
        a.append(i[ok])
        b.append(j[ok])
    return np.concatenate(a), np.concatenate(b)


def links(distinct: DataFrame, most: int = 3) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints (column ``fp``): a spanning set of all links.

    Rows are dealt by key, so a task holds one key's fingerprints at a time
    (eight bytes each). Exact copies were merged before; a key that very many
    different fingerprints share costs comparisons with those not yet linked,
    not all pairs, and emits at most one link a fingerprint.
    """

    def keys(batches):
        for b in slices(batches, 1 << 13):
            fp = b.column(0).to_numpy(zero_copy_only=False)
            u = fp.view(np.uint64)
            row, key = query_keys(u)
            for k in [*exact_keys(u), *index_keys(u)]:
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(fp), pa.array(np.zeros(len(fp), bool))], names=["key", "fp", "ask"])
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[row]), pa.array(np.ones(len(row), bool))], names=["key", "fp", "ask"])

    def meet(batches):
        for key, fp, ask in _whole_keys(batches):
            fp = fp.view(np.uint64)

            def both_roles(first, size, key=key, ask=ask):
                asked = np.add.reduceat(ask.astype(np.int64), first)
                return (key[first] >> 40 < 8) | (asked > 0) & (asked < size)

            i, j = _candidates(key, fp, fp, most, both_roles)
            if len(i):
                e = np.unique(np.stack([np.maximum(fp[i], fp[j]), np.minimum(fp[i], fp[j])], 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(e[:, 0].copy().view(np.int64)), pa.array(e[:, 1].copy().view(np.int64))], names=["a", "b"])

    dealt = distinct.select("fp").mapInArrow(keys, "key long, fp long, ask boolean").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(meet, "a long, b long").distinct()


def near_duplicates(fps: DataFrame, most: int = 3) -> DataFrame:
    """``fp, root`` for every fingerprint that links to another one."""
    distinct = materialize(fps.select("fp").distinct())
    return components(links(distinct, most)).select(F.col("node").alias("fp"), "root")


def shared_bands(nodes: DataFrame) -> DataFrame:
    """``key, node`` of the bands that two nodes or more agree in; ``nodes``: node, sig."""

    def keys(batches):
        for b in slices(batches, 2048):
            k = band_keys(np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(-1, LANES))
            yield pa.RecordBatch.from_arrays([pa.array(k.ravel()), pa.array(np.repeat(b.column(0).to_numpy(zero_copy_only=False), BANDS))], names=["key", "node"])

    def meet(batches):
        for key, node in _whole_keys(batches):
            same = np.diff(key) == 0
            more = np.concatenate([same, [False]]) | np.concatenate([[False], same])
            yield pa.RecordBatch.from_arrays([pa.array(key[more]), pa.array(node[more])], names=["key", "node"])

    dealt = nodes.select("node", "sig").mapInArrow(keys, "key long, node long").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(meet, "key long, node long")


#: Pairs of a star or a block share a set's journey: so many documents of a star, so many on each side of a block.
STAR, BLOCK = 64, 64
#: Bands of more documents are looked at in parts, each against each, a task for two.
PART = 2048
#: By how much the lanes' agreement of a pair at the similarity can be less: four standard deviations and a half.
DOUBT = 0.1125


def stars(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """``block, a, b, ra, rb``: one node of each key with every other that is of another class (``root``)."""

    def meet(batches):
        for key, node, root in _whole_keys(batches):
            order = np.lexsort((mixed(node.view(np.uint64) ^ key.view(np.uint64), 4), key))  # another hub for each key
            first = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1])
            size = np.diff(np.concatenate([first, [len(key)]]))
            hub = np.repeat(order[first], size)
            place = np.arange(len(key)) - np.repeat(first, size)
            other = root[hub] != root[order]
            i, j, place = hub[other], order[other], place[other]
            block = mixed(node[i].view(np.uint64) ^ (place // STAR).astype(np.uint64), 5).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (block, node[i], node[j], root[i], root[j])], names=["block", "a", "b", "ra", "rb"])

    dealt = shared.join(roots, "node").select("key", "node", "root").repartition("key").sortWithinPartitions("key")
    pairs = dealt.mapInArrow(meet, "block long, a long, b long, ra long, rb long")
    # a pair that meets in several bands is looked at once
    least, most = F.least("a", "b"), F.greatest("a", "b")
    return pairs.groupBy(least.alias("x"), most.alias("y")).agg(F.min(F.struct("block", "a", "b", "ra", "rb")).alias("p")).select("p.*")


def agreeing(shared: DataFrame, roots: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """``block, a, b, ra, rb``: all pairs of nodes of different classes that share a key and agree in enough lanes, each once.

    Keys whose nodes are all of one class are done. A pair is told in the first
    band that it shares, so it comes once without being compared with what
    other bands tell.
    """
    least = (similarity - DOUBT) * (1 - 1 / 256) + 1 / 256

    def undone(batches):
        for key, node, root in _whole_keys(batches):
            first = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1])
            size = np.diff(np.concatenate([first, [len(key)]]))
            several = np.repeat(np.minimum.reduceat(root, first) != np.maximum.reduceat(root, first), size)
            part = (np.arange(len(key)) - np.repeat(first, size)) // PART
            n = -(-np.repeat(size, size) // PART)
            yield pa.RecordBatch.from_arrays([pa.array(x[several].astype(np.int64)) for x in (key, node, root, part, n)], names=["key", "node", "root", "part", "parts"])

    def unlike(root, side, i, j):
        """Those of the pairs that are of two classes, and in tasks of two parts from either side."""
        use = (root[i] != root[j]) & ((side[i] != side[j]) | (side[i] == 2))
        return i[use], j[use]

    def near(i, j, key, lanes):
        same = lanes[i] == lanes[j]
        ok = same.mean(1) >= least
        i, j, same = i[ok], j[ok], same[ok]
        own = same[:, : BANDS * BAND].reshape(len(i), BANDS, BAND).all(2).argmax(1) == (key[i] & 63)
        return i[own], j[own]

    def found(task, side, key, root, lanes, first, size):
        small = size <= SMALL_BUCKET
        for i, j in _pairs(first[small], size[small]):
            i, j = unlike(root, side, i, j)
            for at in range(0, len(i), 1 << 14):
                yield near(i[at : at + (1 << 14)], j[at : at + (1 << 14)], key, lanes)
        for f, n in zip(first[~small].tolist(), size[~small].tolist()):
            for i in range(f, f + n - 1):
                rest = np.arange(i + 1, f + n)
                yield near(*unlike(root, side, np.full(len(rest), i), rest), key, lanes)

    def compare(batches):
        for task, side, key, node, root, sig in _whole_keys(batches):
            lanes = np.frombuffer(b"".join(sig), np.uint8).reshape(-1, LANES)
            first = np.concatenate([[0], np.flatnonzero(np.diff(task)) + 1])
            size = np.diff(np.concatenate([first, [len(task)]]))
            place = np.arange(len(task)) - np.repeat(first, size)
            held: list[np.ndarray] = []
            for i, j in found(task, side, key, root, lanes, first, size):
                if len(i):
                    block = mixed(task[i].view(np.uint64) ^ ((place[i] // BLOCK << 20) + place[j] // BLOCK).astype(np.uint64), 6).view(np.int64)
                    held.append(np.stack([block, node[i], node[j], root[i], root[j]]))
                if sum(h.shape[1] for h in held) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in np.concatenate(held, 1)], names=["block", "a", "b", "ra", "rb"])
                    held = []
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in np.concatenate(held, 1)], names=["block", "a", "b", "ra", "rb"])

    rows = shared.join(roots, "node").select("key", "node", "root").repartition("key").sortWithinPartitions("key")
    rows = materialize(rows.mapInArrow(undone, "key long, node long, root long, part long, parts long"))
    # a row goes to every task of its part and another one
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    side = F.when(F.col("part") == F.col("other"), 2).otherwise((F.col("part") > F.col("other")).cast("int")).cast("long")
    rows = rows.select(F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other")).alias("task"), side.alias("side"), "key", "node", "root")
    dealt = rows.join(nodes.select("node", "sig"), "node").select("task", "side", "key", "node", "root", "sig").repartition("task").sortWithinPartitions("task", "side")
    return dealt.mapInArrow(compare, "block long, a long, b long, ra long, rb long")


def _same(doc_id: str, key: str):
    """The condition that a row (doc_id, key) is the document named by two other columns."""
    return F.col("doc_id").eqNullSafe(F.col(doc_id)) & (F.col("key") == F.col(key))


def shingle_sets(nodes: DataFrame, asked: DataFrame, texts: DataFrame) -> DataFrame:
    """``node, s``: the sorted hashes of the distinct five-word shingles of the nodes asked for."""

    def sets(batches):
        for b in sized_slices(batches, 1, 512):
            made = [np.unique(shingles(t or b"", 5)[0]).tobytes() for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.binary())], names=["node", "s"])

    wanted = materialize(nodes.select("node", F.col("doc_id").alias("id"), F.col("key").alias("k")).join(asked, "node"))
    made = materialize(texts.join(broadcastable(wanted, 500_000), _same("id", "k")).select("node", "text").mapInArrow(sets, "node long, s binary"))
    return made if made.count() == wanted.count() else made.dropDuplicates(["node"])  # repeated rows


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``a, b``: the classes (``ra, rb``) of the pairs whose sets of distinct five-word shingles are so similar.

    All pairs of a ``block`` are looked at by one task, to which each set goes once.
    """

    def verify(batches):
        at, held = None, {}
        for b in slices(batches, 1024):
            ok: list[tuple[int, int]] = []
            cols = [b.column(i).to_pylist() for i in range(6)]
            for block, x, y, ra, rb, s in zip(*cols):
                if block != at:
                    at, held = block, {}
                if s is not None:
                    held[x] = np.frombuffer(s, np.uint64)
                    continue
                x, y = held[x], held[y]
                n, least = len(x) + len(y), min(len(x), len(y))
                if least < similarity * (n - least) - 1e-9:
                    continue
                both = n - len(np.unique(np.concatenate([x, y])))
                if both >= similarity * (n - both) - 1e-9:
                    ok.append((ra, rb))
            if ok:
                a, b = zip(*set(ok))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    pairs = materialize(pairs)
    sent = pairs.select("block", F.col("a").alias("node")).unionByName(pairs.select("block", F.col("b").alias("node"))).distinct().join(sets, "node")
    none = lambda t: F.lit(None).cast(t)
    rows = sent.select("block", F.col("node").alias("x"), none("long").alias("y"), none("long").alias("ra"), none("long").alias("rb"), "s").unionByName(pairs.select("block", F.col("a").alias("x"), F.col("b").alias("y"), "ra", "rb", none("binary").alias("s")))
    dealt = rows.repartition("block").sortWithinPartitions("block", F.col("y").asc_nulls_first())
    return dealt.mapInArrow(verify, "a long, b long").distinct()


def similar_classes(fps: DataFrame, texts: DataFrame, most: int, similarity: float) -> DataFrame:
    """``node, root`` of all nodes: classes of confirmed links; ``fps``: key, doc_id, node, fp, sig, ``texts``: key, doc_id, text."""
    nodes = materialize(fps.groupBy("node").agg(F.min(F.struct("key", "doc_id", "fp", "sig")).alias("s")).select("node", "s.*"))
    root = nodes.select("node", F.col("node").alias("root"))
    shared = materialize(shared_bands(nodes))
    # one node stands for each fingerprint: candidates are the others with it, and links to other fingerprints
    rep = materialize(nodes.groupBy("fp").agg(F.min("node").alias("rep")))
    far = links(rep.select("fp"), most).join(rep.toDF("a", "x"), "a").join(rep.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    equal = nodes.select("node", "fp").join(rep, "fp").where("node != rep").select(F.col("rep").alias("a"), F.col("node").alias("b"))
    met = materialize(far.unionByName(equal))
    # blocks of about STAR pairs, as many as a node's pairs need
    room = F.greatest(F.lit(1), F.ceil(F.col("many") / STAR))
    met = met.join(met.groupBy("a").agg(F.count("*").alias("many")), "a").withColumns({"block": F.xxhash64("a", F.pmod(F.xxhash64("b"), room)), "ra": F.col("a"), "rb": F.col("b")}).drop("many")
    asked = shared.select("node").unionByName(met.select(F.col("a").alias("node"))).unionByName(met.select(F.col("b").alias("node"))).distinct()
    sets = shingle_sets(nodes, asked, texts)

    def grown(root: DataFrame, pairs: DataFrame) -> DataFrame:
        links = confirmed(pairs, sets, similarity)
        release(fps.sparkSession)
        wide = components(links).select(F.col("node").alias("root"), F.col("root").alias("wide"))
        out = materialize(root.join(wide, "root", "left").select("node", F.coalesce("wide", "root").alias("root")))
        release(fps.sparkSession)
        return out

    # large groups become one class by the stars of two bands, then of all; then all pairs between classes are left
    names = ["block", "a", "b", "ra", "rb"]
    root = grown(root, met.select(*names).unionByName(stars(shared.where("key & 63 < 2"), root)))
    root = grown(root, stars(shared, root))
    return grown(root, agreeing(shared, root, nodes, similarity))


def sketches(docs: DataFrame) -> DataFrame:
    """``key, doc_id, node, fp, sig`` of ``key, doc_id, text`` rows; a node is a set of distinct five-word shingles."""

    def run(batches):
        for b in slices(batches):
            made = [sketch(t or b"") for t in b.column(2).cast(pa.binary()).to_pylist()]
            fps, sets = (np.array([m[k] for m in made], np.uint64).view(np.int64) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sets), pa.array(fps), pa.array([m[2] for m in made], pa.binary())], names=["key", "doc_id", "node", "fp", "sig"])

    return docs.mapInArrow(run, f"key long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, node long, fp long, sig binary")


def classes(docs: DataFrame, most: int = 3, shingle: int = 3) -> DataFrame:
    """One row per document: ``doc_id, fingerprint`` (16 hex digits) and ``component_id``.

    ``component_id`` is the smallest doc_id reachable over links, itself
    included. Null and empty texts have fingerprint zero and link like any
    other; repeated rows are documents of their own; rows without a doc_id get
    the smallest one of their component (null where none has one); an empty
    table gives no rows; other columns are ignored.
    """
    fps = materialize(fingerprints(pick(docs, "doc_id", "text"), shingle))
    by_fp = fps.groupBy("fp").agg(F.min("doc_id").alias("low"))
    root = materialize(near_duplicates(fps, most))
    joined = by_fp.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lows = joined.groupBy("root").agg(F.min("low").alias("component_id"))
    member = joined.join(lows, "root").select("fp", "component_id")
    return fps.join(member, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, most: int = 3, similarity: float | None = 0.8) -> DataFrame:
    """``docs`` without all but one document of each near-duplicate class.

    Classes join documents whose distinct five-word shingles have a similarity
    of ``similarity`` or more or, where it is None, whose three-word fingerprints
    differ in at most ``most`` bits. The document with the smallest
    doc_id stays (nulls last; ties: any one, and exactly one). Texts without
    words are copies of each other. Same columns, empty in, empty out.

    ``docs`` is read several times and has to give the same rows each time, in
    any order, as a table does; no copy of it is written. A document is named
    by its doc_id and a hash of its text, so of rows that agree in both one stays.
    """
    names = docs.columns
    flat = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at = {n: f"c{names.index(n)}" for n in ("doc_id", "text")}
    keyed = flat.withColumns({"doc_id": F.col(at["doc_id"]), "key": F.xxhash64(at["text"])})
    texts = keyed.select("key", "doc_id", F.col(at["text"]).alias("text"))
    since = mark()
    if similarity is None:
        fps = materialize(fingerprints(texts).withColumnRenamed("fp", "node"))
        root = materialize(near_duplicates(fps.select(F.col("node").alias("fp")), most)).withColumnRenamed("fp", "node")
    else:
        fps = materialize(sketches(texts))
        root = similar_classes(fps, texts, most, similarity)
    first = fps.groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("low"), F.count("*").alias("n"))
    known = materialize(first.join(root, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "low", "n"))
    groups = known.groupBy("root").agg(F.min("low").alias("low"), F.sum("n").alias("size")).where("size > 1")
    # only documents of groups of two and more are looked at again; their number decides between broadcast and shuffle
    shared = known.select("node", "root").join(groups, "root").select("node", F.col("low.doc_id").alias("id"), F.col("low.key").alias("k"))
    members = fps.select("node", "doc_id", "key").join(shared, "node").groupBy("doc_id", "key").agg(F.max(_same("id", "k")).alias("stays"), F.count("*").alias("n"))
    told = materialize(members.where("not stays or n > 1").select(F.col("doc_id").alias("id"), F.col("key").alias("k"), "stays"))
    discard(docs.sparkSession, since, keep=1)
    gone, repeated = (broadcastable(told.where(x).select("id", "k"), 500_000) for x in ("not stays", "stays"))
    out = keyed.join(gone, _same("id", "k"), "left_anti")
    if not repeated.isEmpty():  # rows that agree in doc_id and text
        out = out.join(repeated, _same("id", "k"), "left_anti").unionByName(out.join(repeated, _same("id", "k"), "left_semi").dropDuplicates(["doc_id", "key"]))
    return out.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
