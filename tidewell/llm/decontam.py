"""Benchmark decontamination with template windows.

Text becomes a template: numbers, units and names turn into typed placeholders,
other words are lower-cased, the punctuation around words goes, signs of
arithmetic stay. Runs of template words are hashed and hash-joined with those of
the benchmark items, so a question with other numbers or other names still meets
its original. A window begins at every word and is as long as it takes to hold
eight words, three of them no placeholders; a question full of numbers has longer
windows, not none. Where three plain words are not to be had, windows of eight
are compared by their values.

Each text is read twice: with names as words, whatever their case, and with each
run of capitalised words as one name, so a swapped name at the beginning of a
sentence is a swapped name too. The slots decide: within a match one original
value has to become one value, and two names must not become one. A match that
contradicts itself counts for nothing but unbroken runs of words beside the
contradicted slots.

Items that differ in their slots only (one template, the values paired off one
to one) are one class; results name its smallest item. A document is
contaminated by a class when what agrees covers at least 13 of the item's words
(all that windows can cover of a shorter item).
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcastable, discard, mark, materialize, pick, release, sized_slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW, LEAST_PLAIN, COVER = 8, 3, 13
#: Classes that share windows of more classes than this are looked at together, by what they share; no result depends on it.
COMMON = 64
#: Parts of one match are shifted against each other by at most so many words.
SHIFT = 8
#: Bits of the window filter: a fixed size whatever the benchmark's.
FILTER_BITS = 23
#: Units of measure that become a placeholder (fixed values).
UNITS = "mm cm m km in inch inches ft feet foot yard yards mile miles mg g kg lb lbs oz ton tons ml l litre litres liter liters gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks month months year years % percent $ usd eur dollar dollars cent cents euro euros degree degrees mph kmh w kw kwh v hz khz mhz ghz kb mb gb tb".split()
NUMBERS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
_DIGIT = re.compile(r"\d")
_SIGNS = "+-*/=^<>×÷"
_EDGE = re.compile(r"^[^\w$€£%+-]+|[^\w%$]+$")
_PARTS = re.compile(rf"[$€£]?\d(?:[\d.,:]*\d)?|[^\W\d_]+|[{re.escape(_SIGNS)}%]")
#: SPELLED: a number in letters; AFTER: two letters at most, a unit only after a number.
PLAIN, NUM, UNIT, NAME, SPELLED, AFTER = 0, 1, 2, 3, 4, 5
_NUMBER_WORDS, _UNIT_WORDS = frozenset(NUMBERS), frozenset(UNITS)
#: Windows with names as words, with names as slots, by value.
FOLDED, NAMED, EXACT = 0, 1, 2
#: An odd factor and its inverse modulo 2^64: hashes of runs are differences of prefix sums.
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)


def _value(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "replace"), 1)


def look(word: str) -> list[tuple[int, int]]:
    """(kind, value hash) of the parts of a word: none of mere punctuation, several of ``5kg`` or ``12+7``."""
    core, letters = word, word.isalpha()
    if not letters:
        core = word[:-1]
        letters = core.isalpha() and word[-1] in ".,;:!?)"
    if not letters:
        if word and all(c in _SIGNS for c in word):
            return [(PLAIN, _value(word))]
        core = _EDGE.sub("", word)
        if core[-2:] in ("'s", "’s", "'S", "’S"):
            core = core[:-2]
    low = core.lower()
    if not low:
        return []
    if low in _NUMBER_WORDS:
        return [(SPELLED, _value(low))]
    if low in _UNIT_WORDS:
        return [(AFTER if len(low) < 3 and low.isalpha() else UNIT, _value(low))]
    if not letters and _DIGIT.search(low):
        parts = _PARTS.findall(low)
        return [(NUM if p[-1].isdecimal() else UNIT if p in _UNIT_WORDS else PLAIN, _value(p)) for p in parts]
    return [(NAME if core != low and core[0].isupper() and len(core) > 1 and not core.isupper() else PLAIN, _value(low))]


class Lexicon:
    """The parts of the distinct words seen so far, a bounded number of them."""

    def __init__(self, limit: int = 200_000):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.first, self.kinds, self.values = array("q", [0]), array("b"), array("Q")

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(the number of each word; where each number's parts begin, one more at the end; kinds; values)."""
        if len(self.known) > self.limit:
            self.clear()
        known = self.known
        for w in words:
            if w not in known:
                known[w] = len(known)
                for k, v in look(w):
                    self.kinds.append(k)
                    self.values.append(v)
                self.first.append(len(self.kinds))
        number = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        # copies: the arrays grow with the next words
        return number, np.array(self.first), np.array(self.kinds, np.int8), np.array(self.values, np.uint64)


class Reading:
    """The template words of all texts in a row.

    ``kind``, ``value``, the number of the ``text``, the first and the last
    word (counted within the text) that each stands for, and ``start``: where
    each text begins (one more at the end).
    """

    def __init__(self, kind, value, text, first, last, n_texts):
        self.kind, self.value, self.text, self.first, self.last = kind, value, text, first, last
        self.start = np.searchsorted(text, np.arange(n_texts + 1))
        self.n_texts = n_texts

    def merged(self, which: int, becomes: int) -> tuple[Reading, np.ndarray]:
        """With each run of one kind as one template word; and the new number of each old one."""
        it = self.kind == which
        goes_on = np.zeros(len(it), bool)
        goes_on[1:] = it[1:] & it[:-1] & (self.text[1:] == self.text[:-1])
        number = np.cumsum(~goes_on) - 1
        begin = np.flatnonzero(~goes_on)
        place = np.arange(len(it)) - begin[number] if len(it) else number
        value = self.value * _powers(_STEP, int(place.max(initial=0)) + 1)[place]
        total = np.add.reduceat(value, begin) if len(begin) else value
        end = np.concatenate([begin[1:], [len(it)]]) - 1 if len(begin) else begin
        kind = np.where(it, becomes, self.kind)[begin].astype(np.int8)
        return Reading(kind, total, self.text[begin], self.first[begin], self.last[end], self.n_texts), number

    def codes(self, by_value: bool = False) -> np.ndarray:
        return self.value if by_value else np.where(self.kind == PLAIN, self.value, (self.kind.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F))

    def windows(self, size: int, long: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(begins, ends, which of them hold three plain words) of the windows of ``size`` words
        or, with ``long``, of the more words that it takes to have three plain ones."""
        n = len(self.kind)
        plain = self.kind == PLAIN
        count = np.concatenate([[0], np.cumsum(plain)])
        at = np.arange(n)
        end = at + size
        if long:
            where = np.concatenate([np.flatnonzero(plain), np.full(LEAST_PLAIN, n)])
            end = np.maximum(end, where[count[:-1] + LEAST_PLAIN - 1] + 1)
        at = at[end <= self.start[1:][self.text]] if n else at
        end = end[at]
        return at, end, count[end] - count[at] >= LEAST_PLAIN


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def run_hashes(codes: np.ndarray, at: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each run of codes, whatever its length, at the cost of two look-ups."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * _powers(_STEP, len(codes)), dtype=np.uint64)])
    h = (total[end] - total[at]) * _powers(_BACK, len(codes) + 1)[at]
    h ^= (end - at).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) ^ np.uint64(seed + 1)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def read(texts: pa.Array, lexicon: Lexicon) -> tuple[Reading, Reading, np.ndarray]:
    """All texts with names as words and with names as slots, and the latter's number of each template word of the former."""
    words = pc.utf8_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
    coded = words.flatten().dictionary_encode()
    number, first, kinds, values = lexicon.of(coded.dictionary.to_pylist())
    at = number[coded.indices.to_numpy(zero_copy_only=False)]
    parts = first[at + 1] - first[at] if len(at) else np.zeros(0, np.int64)
    text_of_word = np.repeat(np.arange(len(texts)), np.diff(words.offsets.to_numpy()))
    number = np.cumsum(parts > 0)
    before = np.concatenate([[0], number])[np.searchsorted(text_of_word, np.arange(len(texts)))] if len(at) else np.zeros(len(texts), np.int64)
    part = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts) + np.repeat(first[at], parts) if len(at) else np.zeros(0, np.int64)
    word = np.repeat(number - 1, parts)
    text = np.repeat(text_of_word, parts)
    word = word - before[text] if len(word) else word
    base, _ = Reading(kinds[part], values[part], text, word, word, len(texts)).merged(SPELLED, NUM)
    counted = np.zeros(len(base.kind), bool)
    counted[1:] = (base.kind[:-1] == NUM) & (base.text[1:] == base.text[:-1])
    base.kind = np.where(base.kind == AFTER, np.where(counted, UNIT, PLAIN), base.kind).astype(np.int8)
    named, number = base.merged(NAME, NAME)
    folded = Reading(np.where(base.kind == NAME, PLAIN, base.kind).astype(np.int8), base.value, base.text, base.first, base.last, len(texts))
    return folded, named, number


def window_sets(folded: Reading, named: Reading, short: list[tuple[int, int]]):
    """(sort, reading, begins, ends, hashes) of all windows of the texts.

    ``short``: (sort, words) of items that are one window each because they
    have fewer than eight template words.
    """
    for sort, r in ((FOLDED, folded), (NAMED, named)):
        names = np.concatenate([[0], np.cumsum(r.kind == NAME)])
        for size in (WINDOW, *(n for s, n in short if s == sort)):
            at, end, plain = r.windows(size, size == WINDOW)
            use = plain if sort == FOLDED else plain & (names[end] > names[at])  # without names both readings are alike
            yield sort, r, at[use], end[use], run_hashes(r.codes(), at[use], end[use], sort)
    for size in (WINDOW, *(n for s, n in short if s == EXACT)):
        at, end, plain = folded.windows(size, False)
        yield EXACT, folded, at[~plain], end[~plain], run_hashes(folded.codes(True), at[~plain], end[~plain], EXACT)


def slots_of(kind: np.ndarray, value: np.ndarray) -> np.ndarray:
    """For each template word the number of its slot, by first occurrence of kind and value; -1 for plain ones."""
    seen: dict[tuple[int, int], int] = {}
    return np.array([-1 if k == PLAIN else seen.setdefault((k, v), len(seen)) for k, v in zip(kind.tolist(), value.tolist())], np.int64)


def item_windows(items: DataFrame, id_type: str) -> DataFrame:
    """``item_id, class, h, sort, size, t0, t1, slots, names, first, last`` of all windows of the items (item_id, text).

    ``t0, t1``: the window in template words with names as slots; ``slots``:
    the numbers of its slots, ``names`` those that are names; ``first, last``:
    the item's words of each template word.
    """

    def run(batches):
        lexicon = Lexicon()
        for b in sized_slices(batches, 1):
            cols: list[list] = [[] for _ in range(11)]
            folded, named, number = read(b.column(1), lexicon)
            n_named, n_folded = np.diff(named.start), np.diff(folded.start)
            short = sorted({(FOLDED, int(n)) for n in n_folded if 0 < n < WINDOW} | {(NAMED, int(n)) for n in n_named if 0 < n < WINDOW} | {(EXACT, int(n)) for n in n_folded if 0 < n < WINDOW})
            whole = {FOLDED: n_folded, NAMED: n_named, EXACT: n_folded}
            per: list[tuple] = []
            for i in range(b.num_rows):
                s, e = named.start[i], named.start[i + 1]
                slots = slots_of(named.kind[s:e], named.value[s:e])
                if (named.kind[s:e] == PLAIN).sum() >= LEAST_PLAIN:
                    key = np.where(slots < 0, named.value[s:e].view(np.int64), slots * 4 + named.kind[s:e])
                else:
                    key = folded.value[folded.start[i] : folded.start[i + 1]].view(np.int64)
                names = set(slots[named.kind[s:e] == NAME].tolist())
                per.append((xxhash.xxh64_intdigest(key.tobytes(), len(key)) >> 1, slots, names, named.first[s:e].tolist(), named.last[s:e].tolist()))
            for sort, r, at, end, h in window_sets(folded, named, short):
                for p, q, x in zip(at.tolist(), end.tolist(), h.view(np.int64).tolist()):
                    i = int(r.text[p])
                    if q - p < WINDOW and q - p != whole[sort][i]:
                        continue
                    t = np.arange(p, q) if sort == NAMED else number[p:q]
                    t0, t1 = int(t[0] - named.start[i]), int(t[-1] + 1 - named.start[i])
                    slots = [int(per[i][1][k - named.start[i]]) for k, kind in zip(t, r.kind[p:q]) if kind != PLAIN]
                    row = (b.column(0)[i].as_py(), per[i][0], x, sort, q - p, t0, t1, slots, sorted(set(slots) & per[i][2]), per[i][3], per[i][4])
                    for c, y in zip(cols, row):
                        c.append(y)
            ints = pa.list_(pa.int32())
            kinds = [b.schema.types[0], pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), ints, ints, ints, ints]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["item_id", "class", "h", "sort", "size", "t0", "t1", "slots", "names", "first", "last"])

    return items.mapInArrow(run, f"item_id {id_type}, class long, h long, sort int, size int, t0 int, t1 int, slots array<int>, names array<int>, first array<int>, last array<int>")


def document_windows(docs: DataFrame, id_type: str, short: list[tuple[int, int]], mask) -> DataFrame:
    """``doc_id, key, h, pos, values`` of the windows that pass the filter, of doc_id, text, key rows."""

    def run(batches):
        seen = np.frombuffer(mask.value, np.uint8)
        lexicon = Lexicon()
        for b in sized_slices(batches, 1):
            cols: list[list] = [[] for _ in range(5)]
            folded, named, _ = read(b.column(1), lexicon)
            for _, r, at, end, h in window_sets(folded, named, short):
                bit = (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
                ok = np.flatnonzero((seen[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1)
                for k in ok.tolist():
                    p, q = int(at[k]), int(end[k])
                    i = int(r.text[p])
                    values = r.value[p:q][r.kind[p:q] != PLAIN].view(np.int64).tolist()
                    for c, x in zip(cols, (b.column(0)[i].as_py(), b.column(2)[i].as_py(), int(h[k].view(np.int64)), int(r.first[p]), values)):
                        c.append(x)
            kinds = [b.schema.types[0], pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "key", "h", "pos", "values"])

    return docs.mapInArrow(run, f"doc_id {id_type}, key long, h long, pos int, values array<long>")


def partial_filters(hashes: DataFrame) -> DataFrame:
    """``bits``: a filter for each of at most eight parts of the hashes, packed, as few bits are set in each."""

    def run(batches):
        bits = np.zeros(1 << FILTER_BITS, bool)
        for b in batches:
            h = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            bits[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(np.packbits(bits, bitorder="little"), 1)], pa.binary())], names=["bits"])

    return hashes.select("h").coalesce(8).mapInArrow(run, "bits binary")


def window_filter(hashes: DataFrame) -> bytes:
    """A bit for each top-bits value that a benchmark window has; one fixed size, merged from partial ones."""
    out = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for r in partial_filters(hashes).collect():
        out |= np.frombuffer(zlib.decompress(r["bits"]), np.uint8)
    return out.tobytes()


def contradicted(windows: list[tuple]) -> set[int]:
    """Slots that stand for two values, and names of which two stand for one value; ``windows``: (.., slots, names, values)."""
    ahead: dict[int, set[int]] = defaultdict(set)
    back: dict[int, set[int]] = defaultdict(set)
    for *_, slots, names, values in windows:
        for s, v in zip(slots, values):
            ahead[s].add(v)
            if s in names:
                back[v].add(s)
    return {s for s, vs in ahead.items() if len(vs) > 1} | {s for ss in back.values() if len(ss) > 1 for s in ss}


def _covered(windows: list[tuple]) -> set[int]:
    return {w for _, first, last, *_ in windows for w in range(first, last + 1)}


def _longest_run(words: set[int]) -> int:
    best = run = 0
    before = None
    for w in sorted(words):
        run = run + 1 if before is not None and w == before + 1 else 1
        best, before = max(best, run), w
    return best


def judge(windows: list[tuple], item_words: int, need: int, cover: int = COVER) -> tuple[int, int]:
    """(words of the item that are covered, windows that cover them); (0, 0) when what agrees is too little.

    ``windows``: (position in the document, first and last word in the item,
    slots, names, values). All of them count together when they do not
    contradict each other. Otherwise each match, windows shifted by few words
    against each other, is on its own; one that contradicts itself counts by
    its longest run of ``cover`` words or more in windows beside the
    contradicted slots.
    """
    def told(some: list[tuple]) -> tuple[int, int]:
        words = _covered(some)
        return (len(words), len(some)) if len(words) >= need else (0, 0)

    windows = sorted(windows)
    if not contradicted(windows):
        return told(windows)
    matches: list[list[tuple]] = []
    slack = min(SHIFT, item_words // 2)
    for w in sorted(windows, key=lambda w: (w[0] - w[1], w)):
        if not matches or w[0] - w[1] > matches[-1][-1][0] - matches[-1][-1][1] + slack:
            matches.append([])
        matches[-1].append(w)
    best = (0, 0)
    for match in matches:
        # a phrase that the item repeats meets itself: each place counts once, on the diagonal of most windows
        size = Counter(w[0] - w[1] for w in match)
        own: dict[int, int] = {}
        used: dict[int, int] = {}
        kept = []
        for w in sorted(match, key=lambda w: (-size[w[0] - w[1]], w[0] - w[1], w)):
            if own.setdefault(w[0], w[1]) == w[1] and used.setdefault(w[1], w[0]) == w[0]:
                kept.append(w)
        bad = contradicted(kept)
        if bad:
            kept = [w for w in kept if not bad & set(w[3])]
            run = _longest_run(_covered(kept))
            found = (run, len(kept)) if run >= cover else (0, 0)
        else:
            found = told(kept)
        best = max(best, found)
    return best


def item_classes(benchmark: DataFrame) -> DataFrame:
    """``item_id, class_item_id, class_items`` of every item with words: the smallest item of its class, and how many there are."""
    items = pick(benchmark, "item_id", "text")
    rows = materialize(item_windows(items, items.schema["item_id"].dataType.simpleString()).select("item_id", "class").distinct())
    whole = rows.groupBy("class").agg(F.min("item_id").alias("class_item_id"), F.count("*").alias("class_items"))
    return rows.join(whole, "class").select("item_id", "class_item_id", "class_items")


def judged(runs: DataFrame, cover: int) -> DataFrame:
    """``runs`` with ``n_windows, covered`` in place of ``ws, reach``, without those of which too little agrees."""
    kept = [c for c in runs.columns if c not in ("ws", "reach")]

    def run(batches):
        for b in batches:
            told = []
            ws, words, reach = (b.column(b.schema.get_field_index(c)).to_pylist() for c in ("ws", "item_words", "reach"))
            for w, n, r in zip(ws, words, reach):
                told.append(judge([(x["pos"], x["first"], x["last"], tuple(x["slots"]), tuple(x["names"]), tuple(x["values"])) for x in w], n, min(cover, r), cover))
            keep = [b.column(b.schema.get_field_index(c)) for c in kept]
            out = pa.RecordBatch.from_arrays([*keep, pa.array([n for _, n in told], pa.int64()), pa.array([c for c, _ in told], pa.int64())], names=[*kept, "n_windows", "covered"])
            yield out.filter(pc.greater(out.column(len(kept) + 1), 0))

    return runs.mapInArrow(run, runs.select(*kept).schema.add("n_windows", "long").add("covered", "long"))


def common_parts(rest: DataFrame, cover: int) -> DataFrame:
    """``part, class, item_words, reach, windows`` of the classes of which the windows in ``rest`` cover enough to tell.

    Classes of one part are told alike by these windows: they stand at the same
    distances from the first one, and their slots are the same by rank.
    ``item_words`` and ``reach`` are cut to what makes a difference.
    """

    def run(batches):
        for b in batches:
            cols: list[list] = [[] for _ in range(5)]
            for cls, words, reach, ws in zip(*(c.to_pylist() for c in b.columns)):
                reach, words = min(cover, reach), min(words, 2 * SHIFT)
                ws = sorted((w["f"], w["l"], tuple(w["slots"]), tuple(w["names"]), w["h"]) for w in ws)
                if len({x for f, l, *_ in ws for x in range(f, l + 1)}) < reach:
                    continue
                rank = {s: k for k, s in enumerate(sorted({s for w in ws for s in w[2]}))}
                low = ws[0][0]
                made = [(h, f - low, l - low, [rank[s] for s in slots], [rank[s] for s in names]) for f, l, slots, names, h in ws]
                part = xxhash.xxh64_intdigest(repr((words, reach, made)).encode()) >> 1
                for c, x in zip(cols, (part, cls, words, reach, [dict(zip(("h", "f", "l", "slots", "names"), m)) for m in made])):
                    c.append(x)
            ints = pa.list_(pa.int32())
            window = pa.struct([("h", pa.int64()), ("f", pa.int32()), ("l", pa.int32()), ("slots", ints), ("names", ints)])
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(window)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["part", "class", "item_words", "reach", "windows"])

    whole = rest.groupBy("class", "item_words", "reach").agg(F.collect_set(F.struct("h", "f", "l", "slots", "names")).alias("ws"))
    return whole.mapInArrow(run, "part long, class long, item_words int, reach int, windows array<struct<h: long, f: int, l: int, slots: array<int>, names: array<int>>>")


def _agreeing(docs: DataFrame, benchmark: DataFrame, cover: int, common: int | None):
    """(contaminated pairs; pairs of a document and a part; the classes of parts; pairs that are no longer a part's); the last three None without parts."""
    kind_of = lambda df, c: df.schema[c].dataType.simpleString()
    most = COMMON if common is None else common
    items = pick(benchmark, "item_id", "text")
    rows = materialize(item_windows(items, kind_of(items, "item_id")))
    whole = rows.groupBy("class").agg(F.min_by(F.struct("first", "last"), F.struct(F.col("item_id").isNull(), "item_id")).alias("at"), F.min("item_id").alias("item_id"), F.count_distinct(F.struct("item_id")).alias("n_items"))
    distinct = rows.select("class", "h", "sort", "size", "t0", "t1", "slots", "names").distinct()
    shared = distinct.select("h", "class").distinct().groupBy("h").agg(F.count("*").alias("classes"))
    parts = distinct.join(shared, "h").join(whole, "class").withColumns({"f": F.col("at.first")[F.col("t0")], "l": F.col("at.last")[F.col("t1") - 1], "item_words": F.element_at("at.last", -1) + 1})
    reach = parts.groupBy("class").agg(F.size(F.array_distinct(F.flatten(F.collect_set(F.sequence("f", "l"))))).alias("reach"), F.min("classes").alias("rarest"))
    names_it = (F.col("classes") <= most) | (F.lit(common is not None) & (F.col("rarest") > most))
    bench = materialize(parts.join(reach, "class").withColumn("names_it", names_it).drop("at", "t0", "t1", "classes", "rarest"))
    short = sorted((r["sort"], r["size"]) for r in bench.where(F.col("size") < WINDOW).select("sort", "size").distinct().collect())  # at most three times the window's words
    mask = docs.sparkSession.sparkContext.broadcast(window_filter(bench))
    release(docs.sparkSession)  # the driver's heap grew for the filters and would fill up while the documents are read
    texts = pick(docs, "doc_id", "text").withColumn("key", F.xxhash64("text"))
    found = materialize(document_windows(texts, kind_of(texts, "doc_id"), short, mask))
    release(docs.sparkSession)
    window = [F.struct("pos", F.col("f").alias("first"), F.col("l").alias("last"), "slots", "names", "values").alias("w")]
    pair = ["doc_id", "key", "class", "item_id", "n_items", "item_words", "reach"]

    def gathered(met: DataFrame) -> DataFrame:
        """No more windows than the document has words."""
        return judged(met.groupBy(*[c for c in met.columns if c != "w"]).agg(F.collect_set("w").alias("ws")), cover)

    met = found.join(bench.where("names_it"), "h").where(F.size("slots") == F.size("values")).select(*pair, *window)
    rest = bench.where("not names_it")
    if rest.isEmpty():
        return gathered(met).drop("class"), None, None, None
    met = materialize(met)
    named = met.select("doc_id", "key", "class").distinct().withColumnsRenamed({"doc_id": "d", "key": "k", "class": "c"})
    asked = found.join(named, found["doc_id"].eqNullSafe(F.col("d")) & (found["key"] == F.col("k"))).join(rest, (F.col("c") == rest["class"]) & (found["h"] == rest["h"]))
    pairs = gathered(met.unionByName(asked.where(F.size("slots") == F.size("values")).select(*pair, *window))).drop("class")
    if common is not None:
        return pairs, None, None, None
    # what no other window names is told by the common ones, once for all classes that have them alike
    told = materialize(common_parts(rest, cover))
    alike = told.groupBy("part").agg(*[F.first(c).alias(c) for c in ("item_words", "reach", "windows")]).select("part", "item_words", "reach", F.inline("windows"))
    by_part = found.join(alike, "h").where(F.size("slots") == F.size("values")).select("doc_id", "key", "part", "item_words", "reach", *window)
    return pairs, materialize(gathered(by_part).drop("item_words")), told.select("part", "class").join(bench.select("class", "item_id", "n_items", "item_words").distinct(), "class"), named


def contaminations(docs: DataFrame, benchmark: DataFrame, cover: int = COVER, common: int | None = None) -> DataFrame:
    """``doc_id, key, item_id, n_items, item_words, n_windows, covered`` of every contaminated pair of a document and a class of items.

    ``docs``: doc_id, text; ``benchmark``: item_id, text. ``item_id`` is the
    smallest of the class, ``n_items`` its size (``item_classes`` tells the
    members). ``key`` (a hash of the text) tells apart texts with the same
    doc_id. Rows with a null or empty text match nothing; null ids are kept as
    ids; repeated rows give one result; an empty table on either side gives no
    rows. Items of fewer words than a window are one window, which documents of
    any length are searched for. Every window names pairs, whatever the number
    of classes that have it. With ``common``, one of more classes does not name
    a pair but counts for pairs that other windows name; classes that have no
    other windows are then named by all of theirs.
    """
    pairs, by_part, classes, named = _agreeing(docs, benchmark, cover, common)
    if by_part is None:
        return pairs
    known = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")) & (F.col("class") == F.col("c"))
    more = by_part.join(classes, "part").join(named, known, "left_anti")
    return pairs.unionByName(more.select(*pairs.columns))


def decontaminate(docs: DataFrame, benchmark: DataFrame, cover: int = COVER) -> DataFrame:
    """``docs`` without contaminated documents; same columns. Clean rows, also repeated ones, all stay."""
    names = docs.columns
    flat = docs.toDF(*[f"c{i}" for i in range(len(names))])
    since = mark()
    pairs, by_part, classes, named = _agreeing(docs, benchmark, cover, None)
    found = pairs.select("doc_id", "key")
    if by_part is not None:  # a part tells when one of its classes at least is not judged with windows of its own
        sizes = classes.groupBy("part").agg(F.count("*").alias("n"))
        own = named.join(classes.select("part", F.col("class").alias("c")), "c").groupBy("d", "k", F.col("part").alias("p")).agg(F.count("*").alias("n_own"))
        known = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")) & (F.col("part") == F.col("p"))
        found = found.unionByName(by_part.join(sizes, "part").join(own, known, "left").where("coalesce(n_own, 0) < n").select("doc_id", "key"))
    hits = materialize(found.select(F.col("doc_id").alias("hit_id"), F.col("key").alias("hit_key")).distinct())
    discard(docs.sparkSession, since, keep=1)
    release(docs.sparkSession)
    hits = broadcastable(hits, 500_000)  # two longs a row; more are joined by shuffle
    same = flat[f"c{names.index('doc_id')}"].eqNullSafe(F.col("hit_id")) & (F.xxhash64(f"c{names.index('text')}") == F.col("hit_key"))
    return flat.join(hits, same, "left_anti").toDF(*names)
