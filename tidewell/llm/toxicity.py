"""Toxicity by a subsequence string kernel and a support vector machine on Nyström landmarks.

Strings are words with their non-letters taken out (so ``i.d.i*o.t`` and
``idiot###`` are ``idiot``; three or more letters standing alone, whatever signs
and blanks are between them, are one word too).
The kernel compares the three-letter subsequences of two words, a gap costing
a factor, within windows of five letters; word ends are letters too. It is a
sum over subsequences, so a machine with weights on landmark words is one sparse
weight vector over subsequences, and scoring a word needs a few lookups.

Labelled sentences are the training examples, bags of words of which the worst
one tells: a sentence scores as its worst word. Every sentence of a clean
document is clean. Of a toxic document those are toxic that hold a witness: at
first a word that begins like words frequent in toxic and rare in clean
documents, or a rarer one, weighed by how much oftener words are found in so many
toxic and no clean documents than the other way round; after each round of
training, the word that the machine itself finds worst, if it finds it toxic.
Other sentences of toxic documents are no examples. The machine is trained on the
witnesses of toxic sentences and on the worst and further words of clean ones.
A document's score, 0 to 1, is a logistic curve over its three worst word
scores, and over how many words score as toxic, fitted on the training documents.
"""

from __future__ import annotations

import heapq
import math
import re
import sys
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pick, received, sent, slices, trim

cloudpickle.register_pickle_by_value(sys.modules[__name__])

GAP = 0.6
#: Offsets of the second and third letter and the number of letters skipped.
PATTERNS = [(a, b, b - 2) for b in range(2, 5) for a in range(1, b)]
LONG_WORD, WINDOW, STEP = 32, 24, 12
#: So many clean words that look worst after a round, and how many times more than others they count in the next.
NEAR, NEAR_WEIGHT = 200, 8.0
_NOT_LETTERS = re.compile(r"[^\w\s]+|[\d_]+")
_SPACED = re.compile(r"(?<!\S)[^\W\d_](?:\s+[^\W\d_]){2,}(?!\w)")
#: A sentence ends with its line, or with a stop after two letters (not within ``i. d. i. o. t``).
_ENDS = re.compile(r"\n+|(?<=\w\w[.!?])\s+")


def words(text: str | None) -> Counter:
    """The words of a whole text and how often each occurs."""
    low = _NOT_LETTERS.sub("", (text or "").lower())
    found = Counter(low.split())
    for m in _SPACED.finditer(low):
        found["".join(m[0].split())] += 1
    return found


def sentences(text: str | None) -> list[list[str]]:
    """The distinct words of each sentence that has any."""
    return [ws for ws in (list(words(s)) for s in _ENDS.split(text or "")) if ws]


def codes(chars: np.ndarray) -> np.ndarray:
    """Six-bit letter codes: a-z, the accented letters of Latin-1, the two word ends; others share codes."""
    c = chars.astype(np.int64)
    out = 1 + c % 59
    out = np.where((c >= 97) & (c <= 122), c - 96, out)
    out = np.where((c >= 223) & (c <= 255), c - 196, out)
    return np.where(c == 94, 60, np.where(c == 36, 61, out))


def spectra(strings: list[str]):
    """(row, subsequence id, weight) of every subsequence of ``^word$``, weights scaled to length one."""
    ends = [f"^{s}$" for s in strings]
    chars = codes(np.frombuffer("".join(ends).encode("utf-32-le", "replace"), np.uint32))
    n = np.array([len(s) for s in ends], np.int64)
    row = np.repeat(np.arange(len(n)), n)
    room = np.repeat(np.cumsum(n), n) - np.arange(len(chars))  # letters from here to the end of the word
    norm = np.sqrt(sum(GAP ** (2 * g) * np.maximum(n - b, 0) for _, b, g in PATTERNS))
    norm[norm == 0] = 1
    for a, b, g in PATTERNS:
        i = np.flatnonzero(room > b)
        yield row[i], (chars[i] << 12) | (chars[i + a] << 6) | chars[i + b], GAP**g / norm[row[i]]


def kernel_rows(strings: list[str], weights: np.ndarray, index: np.ndarray | None = None) -> np.ndarray:
    """<string, column> for each string and each column of a weight table.

    ``weights`` has a row for each subsequence id; with ``index`` one for each
    that is in use, and ``index`` tells which.
    """
    out = np.zeros((len(strings), *weights.shape[1:]))
    for row, sub, w in spectra(strings):
        if weights.ndim == 1:
            out += np.bincount(row, weights[sub] * w, len(strings))
            continue
        sub = sub if index is None else index[sub]
        used = sub >= 0
        row, sub, w = row[used], sub[used], w[used]
        first = np.flatnonzero(np.diff(row, prepend=-1))
        if len(first):
            out[row[first]] += np.add.reduceat(weights[sub] * w[:, None], first, axis=0)
    return out


@dataclass
class Model:
    """Non-zero subsequence weights, and a logistic curve over a document's features."""

    subs: np.ndarray
    weights: np.ndarray
    bias: float
    curve: np.ndarray

    def table(self) -> np.ndarray:
        t = np.zeros(1 << 18)
        t[self.subs] = self.weights
        return t


def score_words(strings: list[str], table: np.ndarray, bias: float) -> np.ndarray:
    """Kernel machine score of each word; of a very long one, of its worst overlapping window."""
    pieces, owner = [], []
    for i, s in enumerate(strings):
        for k in range(0, max(1, len(s) - WINDOW + STEP), STEP) if len(s) > LONG_WORD else (0,):
            pieces.append(s[k : k + WINDOW] if len(s) > LONG_WORD else s)
            owner.append(i)
    out = np.full(len(strings), -np.inf)
    for at in range(0, len(pieces), 20_000):
        np.maximum.at(out, owner[at : at + 20_000], kernel_rows(pieces[at : at + 20_000], table))
    return out + bias


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float, rounds: int = 30) -> np.ndarray:
    """Linear machine with squared hinge loss, by Newton steps on the rows inside the margin; the last column of ``x`` is 1."""
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[-1, -1] = 1e-6
    before = None
    for _ in range(rounds):
        inside = y * (x @ w) < 1
        if before is not None and (inside == before).all():
            break
        before = inside
        near = x[inside]
        xs = near * weight[inside, None]
        w = np.linalg.solve(xs.T @ near + penalty, xs.T @ y[inside])
    return w


def features(found: Counter, known: dict[str, float]) -> list[float]:
    """The three worst words' scores (a word counts as often as it occurs), the logarithm and the share of toxic words, 1."""
    scored = [(known[w], n) for w, n in found.items()]
    top: list[float] = []
    for z, n in heapq.nlargest(3, scored):
        top += [z] * min(n, 3)
    bad = sum(n for z, n in scored if z > 0)
    return [*[max(z, -2.0) for z in [*top, -2.0, -2.0, -2.0][:3]], math.log1p(bad), bad / max(1, found.total()), 1.0]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weights of a logistic curve, by Newton steps."""
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[-1, -1] = 1e-3
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (p - y) + penalty @ w)
        w -= step * min(1, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w


def _stems(toxic: list[Counter], clean: list[Counter]) -> list[str]:
    """Word beginnings (``^abc``) and whole words (``^abc$``) frequent in toxic and rare in clean documents.

    A beginning has to stand out among all that are tried: by a likelihood
    ratio beyond what the best of so many would reach by chance.
    """

    def pieces(ws):
        return {f"^{w[:k]}" for w in ws for k in range(3, min(8, len(w)) + 1)} | {f"^{w}$" for w in ws if len(w) >= 3}

    least = max(3, round(0.01 * len(toxic)))
    up = Counter(p for ws in toxic for p in pieces(ws))
    up = {p: n for p, n in up.items() if n >= least}
    down = Counter(p for ws in clean for p in pieces(ws) if p in up)
    rate = {p: (n / len(toxic)) / ((down[p] + 0.5) / (len(clean) + 1)) for p, n in up.items()}
    share = len(toxic) / (len(toxic) + len(clean))
    beyond = 2 * math.log(max(1, len(up))) + 6

    def ratio(p: str) -> float:
        a, b = up[p], down[p]
        return 2 * (a * math.log(a / ((a + b) * share)) + (b * math.log(b / ((a + b) * (1 - share))) if b else 0.0))

    good = [p for p in up if rate[p] >= 12 and ratio(p) >= beyond]
    chosen: list[str] = []
    for p in sorted(good, key=lambda p: (len(p), -up[p], p)):
        # a longer beginning adds nothing unless it is much surer than a shorter one that was taken
        if not any(p.startswith(q) and rate[p] < 4 * rate[q] for q in chosen):
            chosen.append(p)
    return chosen


def _witnesses(toxic: list[Counter], clean: list[Counter]) -> tuple[dict[str, float], set[str]]:
    """Share, estimated, of real witnesses among words like each that is mainly in toxic documents; and the words that are mainly in toxic documents.

    Words in k toxic and no clean documents are compared with those in k clean
    and no toxic ones, as many documents each: what they are more by is no chance.
    """
    up, down = (Counter(w for ws in side for w in ws) for side in (toxic, clean))
    mainly = {w for w, n in up.items() if n / len(toxic) > 2 * down[w] / len(clean)}
    n = min(len(toxic), len(clean))
    a, b = (Counter(w for ws in side[:n] for w in ws) for side in (toxic, clean))
    here, there = (Counter(min(k, 10) for w, k in x.items() if w not in y) for x, y in ((a, b), (b, a)))
    excess = {k: 1 - (there[k] + 1) / (m + 1) for k, m in here.items()}
    return {w: excess.get(min(a[w], 10), 0.0) for w in mainly if w not in down and len(w) >= 3}, mainly


def _constant(label: int) -> Model:
    return Model(np.zeros(0, np.int64), np.zeros(0), -1.0, np.array([0, 0, 0, 0, 0, 3.0 if label else -3.0]))


def _tells(toxic: list[list[list[str]]], clean: list[list[list[str]]], *most: int) -> bool:
    """Whether machines trained on one half of the documents call more toxic than clean ones of the other half toxic, beyond chance."""
    called = []
    for k in (0, 1):
        half = [(doc, y, i) for y, side in ((1, toxic), (0, clean)) for i, doc in enumerate(side)]
        model = train([x for x in half if x[2] % 2 == k], *most, checked=True)
        table = model.table()
        for doc, y, _ in (x for x in half if x[2] % 2 != k):
            ws = Counter(w for s in doc for w in s)
            known = dict(zip(ws, score_words(list(ws), table, model.bias).tolist()))
            called.append((y, float(np.array(features(ws, known)) @ model.curve) >= 0))
    y, p = np.array(called, float).T
    spread = math.sqrt(p.mean() * (1 - p.mean()) * (1 / len(toxic) + 1 / len(clean)))
    return p[y == 1].mean() - p[y == 0].mean() > 3 * spread


class Bags:
    """Sentences of documents as runs of word numbers."""

    def __init__(self, docs: list[list[list[str]]]):
        number: dict[str, int] = {}
        flat = [number.setdefault(w, len(number)) for d in docs for s in d for w in s]
        self.vocab = list(number)
        self.words = np.array(flat, np.int64)
        sizes = np.array([len(s) for d in docs for s in d], np.int64)
        self.first = np.cumsum(sizes) - sizes
        self.sizes = sizes

    def worst(self, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, its score) of each sentence's worst word; of equal ones the first."""
        if not len(self.words):
            return self.words, np.zeros(0)
        z = score[self.words]
        top = np.maximum.reduceat(z, self.first)
        at = np.flatnonzero(z == np.repeat(top, self.sizes))
        owner = np.repeat(np.arange(len(self.sizes)), self.sizes)[at]
        _, one = np.unique(owner, return_index=True)
        return self.words[at[one]], top


def train(examples: list[tuple[list[list[str]], int, int]], max_landmarks: int = 192, max_clean: int = 10_000, checked: bool = False, rounds: int = 3) -> Model:
    """Fit on (sentences, label, key) of documents; one document stands for all with its key.

    With no toxic or no clean example every score is the same, on the side of
    the label that there is. Where no beginning stands out, the machine has to
    tell each half of the documents by the other one (``checked``: it did), or
    no document is toxic.
    """
    one = {}
    for doc, y, key in examples:
        one.setdefault((key, y), doc)
    sides = {label: [doc for (_, y), doc in sorted(one.items(), key=lambda x: x[0]) if y == label] for label in (1, 0)}
    toxic, clean = ([Counter(w for s in doc for w in s) for doc in sides[label]] for label in (1, 0))
    if not toxic or not clean:
        return _constant(1 if toxic else 0)
    stems = _stems(toxic, clean)
    if not stems and not checked and not _tells(sides[1], sides[0], max_landmarks, max_clean):
        return _constant(0)
    freq = Counter(w for doc in sides[1] for s in doc for w in s)  # sentences of toxic documents
    head = defaultdict(list)
    for p in stems:
        head[p[:4]].append(p)
    hit: dict[str, float] = {w: n for w, n in freq.items() if any(f"^{w}$".startswith(p) for p in head.get(f"^{w}$"[:4], ()))}
    share, mainly = _witnesses(toxic, clean)
    hit |= {w: freq[w] * x * x for w, x in share.items() if x >= 0.5 and w not in hit}
    if not hit:  # nothing stands out: documents as they are, each word by how often it is in toxic ones
        hit = {w: float(freq[w]) for w in mainly}
    vocab = sorted({w for ws in clean for w in ws} - set(hit) - mainly)
    if not hit or not vocab:
        return _constant(0)
    bad = sorted(hit, key=lambda w: (-hit[w], w))
    rng = np.random.default_rng(7)
    order = rng.permutation(len(vocab))
    common = [w for w, _ in Counter(w for ws in clean for w in ws if w not in hit).most_common(max_landmarks // 4)]
    shape = [p.strip("^$") for p in stems if len(p) > 3][: max_landmarks // 4]
    landmarks = list(dict.fromkeys([*shape, *bad[: max_landmarks // 2], *common, *[vocab[i] for i in order[: max_landmarks // 4]]]))[:max_landmarks]

    subs = np.unique(np.concatenate([sub for _, sub, _ in spectra(landmarks)]))
    index = np.full(1 << 18, -1)
    index[subs] = np.arange(len(subs))
    columns = np.zeros((len(subs), len(landmarks)))
    for row, sub, w in spectra(landmarks):
        np.add.at(columns, (index[sub], row), w)
    gram = kernel_rows(landmarks, columns, index)
    gram = (gram + gram.T) / 2
    values, vectors = np.linalg.eigh(gram + 1e-6 * np.eye(len(gram)))
    root = vectors / np.sqrt(np.maximum(values, 1e-6))  # gram^-1/2 up to a rotation

    bags = {label: Bags(side) for label, side in sides.items()}
    allowed = set(vocab)
    used = [vocab[i] for i in order[:max_clean]]
    tables = columns @ root
    dense = np.zeros(1 << 18)
    told = dict(hit)
    near: set[str] = set()
    for left in range(rounds, 0, -1):
        strings = [*sorted(told, key=lambda w: (-told[w], w))[:max_clean], *used]
        y = np.concatenate([np.ones(len(strings) - len(used)), -np.ones(len(used))])
        x = np.ones((len(strings), tables.shape[1] + 1))
        for k in range(0, len(strings), 2000):
            x[k : k + 2000, :-1] = kernel_rows(strings[k : k + 2000], tables, index)
        n = np.array([told.get(s, 1) for s in strings], float)
        weight = np.where(y > 0, np.sqrt(n), np.array([NEAR_WEIGHT if w in near else 1.0 for w in strings]))
        weight *= np.where(y > 0, len(y) / (2 * weight[y > 0].sum()), len(y) / (2 * weight[y < 0].sum()))
        w = _svm(x, y, weight, ridge=1e-4 * len(y))
        dense[subs], bias = tables @ w[:-1], float(w[-1])
        if left == 1:
            break
        # the worst words of clean sentences that look worst are among the next examples
        worst, z = bags[0].worst(score_words(bags[0].vocab, dense, bias))
        hard = [bags[0].vocab[i] for i in worst[np.argsort(-z, kind="stable")].tolist()]
        hard = list(dict.fromkeys(w for w in hard if w in allowed))[:2000]
        near.update(hard[:NEAR])
        used = list(dict.fromkeys([*used, *hard]))
        # toxic are now also the sentences that the machine finds toxic, by a word that clean documents do not have
        worst, z = bags[1].worst(score_words(bags[1].vocab, dense, bias))
        seen = Counter(bags[1].vocab[i] for i in worst[z > 0].tolist())
        told = {w: n / 4 for w, n in seen.items() if n >= 4 and share.get(w, 0.0) >= 0.3} | hit
    every = list({w for ws in [*toxic, *clean] for w in ws})
    known = dict(zip(every, score_words(every, dense, bias).tolist()))
    x = np.array([features(ws, known) for ws in [*toxic, *clean]])
    curve = _logistic(x, np.array([1.0] * len(toxic) + [0.0] * len(clean)))
    return Model(subs, dense[subs], bias, curve)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 2500, max_chars: int = 30_000) -> Model:
    """Train on the sentences of a bounded sample: at most ``per_class`` labelled documents a class, in hash order of doc_id.

    ``labels`` has ``doc_id`` and ``label`` (0/1). Only documents of at most
    ``max_chars`` characters serve for training. Rows with a null doc_id, label
    or text are not used; a doc_id with several labels counts as toxic if one is.
    Of documents with one key (copies with changes) the one of the least hash is
    taken, so the model does not depend on partitions.
    """
    own = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    short = docs.where(F.length("text") <= max_chars).select("doc_id", F.length("text").alias("n"))
    own = own.join(short.select("doc_id").distinct(), "doc_id", "left_semi")
    order = F.xxhash64("doc_id")
    sample = None
    for y in (0, 1):
        part = own.where(F.col("label") == y).orderBy(order, "doc_id").limit(per_class)
        sample = part if sample is None else sample.unionByName(part)
    # at most 2 * per_class rows: a proven bound for the broadcast
    rows = docs.where(F.length("text") <= max_chars).join(F.broadcast(sample), "doc_id")

    def run(batches):
        for b in slices(batches):
            texts, ys = b.column(0).to_pylist(), b.column(1).to_pylist()
            found = ["\n".join(" ".join(s) for s in sentences(t)) for t in texts]
            keys = []
            for t in texts:
                parts = t.lower().split()
                keys.append(min((hash_of(" ".join(parts[i : i + 3])) for i in range(max(1, len(parts) - 2))), default=0))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(ys, pa.int32()), pa.array(keys, pa.int64())], names=["found", "label", "key"])

    got = rows.select("text", F.col("label").cast("int")).mapInArrow(run, "found string, label int, key long")
    got = got.groupBy("label", "key").agg(F.min_by("found", F.struct(F.xxhash64("found"), "found")).alias("found"))
    model = train([([[*map(sys.intern, s.split())] for s in r["found"].split("\n") if s], r["label"], r["key"]) for r in got.toLocalIterator()])
    trim()  # the driver lives on, and what training took of it is several times what it took before
    return model


def hash_of(s: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(s.encode("utf-8", "replace")) >> 1


def score(docs: DataFrame, model: Model, text: str = "text", keep=lambda p: True) -> DataFrame:
    """``docs`` with ``tox_score`` (0..1), of the whole text, rows for which ``keep(score)`` holds.

    Null and empty texts have no words and score lowest. Repeated rows score alike.
    """
    names = docs.columns
    at = names.index(text)
    packed = sent(docs.sparkSession, model)

    def run(batches):
        model = received(packed)
        table = model.table()
        known: dict[str, float] = {}
        for b in slices(batches):
            found = [words(t) for t in b.column(at).to_pylist()]
            new = list({w for ws in found for w in ws if w not in known})
            if len(known) + len(new) > 150_000:
                known.clear()
                new = list({w for ws in found for w in ws})
            known.update(zip(new, score_words(new, table, model.bias).tolist()))
            p = 1 / (1 + np.exp(-np.clip(np.array([features(ws, known) for ws in found]) @ model.curve, -30, 30)))
            stay = np.array([keep(x) for x in p], bool)
            out = pa.RecordBatch.from_arrays([*b.columns, pa.array(np.round(p, 9))], names=[*b.schema.names, "tox_score"])
            yield out.filter(pa.array(stay))

    flat = docs.toDF(*[f"c{i}" for i in range(len(names))])
    return flat.mapInArrow(run, T.StructType([*flat.schema.fields, T.StructField("tox_score", T.DoubleType())])).toDF(*names, "tox_score")


def held_out(modulus: int, rest: int):
    """Whether crc32 of the doc_id as text leaves ``rest``; false for a null doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == rest, F.lit(False))


def training_labels(labels: DataFrame, label: str) -> DataFrame:
    """``doc_id, label`` of the rows that may be learned from (fold 0 of 5 is held out)."""
    own = pick(labels, "doc_id", label)
    return own.where(~held_out(5, 0)).select("doc_id", F.col(label).alias("label"))
