"""Re-parameterised questions are found, contradicting slots are not, and the whole agrees with a plain version."""

from __future__ import annotations

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import data
from tests.llm.test_operators import frame
from tidewell.llm import decontam

NAMES = "Tom Anna Bob Eve Maria Jose Kim Lee Omar Nina Paul Rita Sven Uma Vera Walt".split()
UNITS = "kg km ml hours days litres miles oz".split()
SHAPES = [
    "{A} has {x} apples . {A} gives {y} apples to {B} . How many apples does {A} have now ?",
    "What is {x} + {y} * {z} - {w} / {v} when {A} has {x} {u} ?",
    "Mix {x} ml , {y} ml , {z} ml and {w} ml of water , then pour out {v} ml . How much is left ?",
    "{A} runs {x}{u} on {y} days and {z}{u} on {w} days . How far does {A} run in all ?",
    "Compute {x}*{y}+{z}-{w} and divide the result by {v} to get the price that {A} and {B} pay .",
    "In a shop , {A} buys {x} pens at {y} cents each and {z} books at {w} dollars each ; {B} pays half of it .",
    "{A} is {x} years old . {B} is {y} years older than {A} . How old will {B} be in {z} years ?",
    "A train leaves at {x} and drives {y} {u} at {z} mph until {A} and {B} stop it after {w} minutes .",
    "{x} , {y} , {z} , {w} , {v} : what comes next in this list of numbers that {A} wrote down ?",
    "{A} and {B} share {x} sweets in the ratio {y} : {z} . How many more sweets does {B} get ?",
]


def question(rng: random.Random, shape: str) -> str:
    a, b = rng.sample(NAMES, 2)
    x, y, z, w, v = rng.sample(range(2, 500), 5)
    return shape.format(A=a, B=b, x=x, y=y, z=z, w=w, v=v, u=rng.choice(UNITS))


def test_reparameterised_questions_are_found(spark):
    rng = random.Random(3)
    items = [question(rng, s) for s in SHAPES]
    asked = [(k, question(rng, SHAPES[k])) for k in range(len(SHAPES)) for _ in range(6)]
    docs = [f"{data.words(rng, 30)}\n{q}\n{data.words(rng, 30)}" for _, q in asked] + [data.words(rng, 80) for _ in range(40)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminations(frame(spark, docs), bench).collect()}
    want = {(i, k) for i, (k, _) in enumerate(asked)}
    assert len(got & want) >= 0.9 * len(want) and not got - want, sorted(want - got)


@pytest.mark.parametrize("inserted", ["", "really "])
def test_a_contradiction_outweighs_plain_windows(spark, inserted):
    item = "Now take 3 of the red balls out of the box and then carefully add 3 more of the blue balls to the other small box"
    first, second = item.split("and then ")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    same = f"{first.replace('3', '7')}{inserted}and then {second.replace('3', '7')}"
    other = f"{first.replace('3', '7')}{inserted}and then {second.replace('3', '9')}"
    got = {r.doc_id: r.covered for r in decontam.contaminations(frame(spark, [item, same, other]), bench).collect()}
    assert 0 in got and 1 in got and 2 not in got, got


def test_names_must_not_become_one(spark):
    item = "Yesterday Tom gave Anna the ball and then Anna gave Tom a book while Tom told Anna a long story about it"
    docs = [item.replace("Tom", "Bob").replace("Anna", "Eve"), item.replace("Tom", "Bob").replace("Anna", "Bob")]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert [r.doc_id for r in decontam.contaminations(frame(spark, docs), bench).collect()] == [0]


def test_items_of_one_template_are_one_class(spark):
    rng = random.Random(4)
    items = [(k * 100 + i, question(rng, SHAPES[k])) for k in (0, 2) for i in range(30)] + [(900, "three short words"), (901, "three short words"), (902, "other short words")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    classes = {r.item_id: (r.class_item_id, r.class_items) for r in decontam.item_classes(bench).collect()}
    assert all(classes[i] == (i // 100 * 100, 30) for i, _ in items[:60])
    assert classes[900] == classes[901] == (900, 2) and classes[902] == (902, 1)
    docs = [question(rng, SHAPES[0]) + " " + data.words(rng, 5), "it has three short words in it"]
    got = {(r.doc_id, r.item_id, r.n_items) for r in decontam.contaminations(frame(spark, docs), bench).collect()}
    assert got == {(0, 0, 30), (1, 900, 2)}


def test_shared_boilerplate_names_no_pair_but_counts(spark):
    rng = random.Random(5)
    lead = "please read the following text with care and then answer the question below it"
    items = [f"{lead} {data.words(rng, 9)}" for _ in range(8)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = [f"{data.words(rng, 9)} {lead} {data.words(rng, 9)}", items[3], f"{lead} {' '.join(items[5].split()[-9:])}"]
    got = {(r.doc_id, r.item_id): r.covered for r in decontam.contaminations(frame(spark, docs), bench, common=4).collect()}
    assert got == {(1, 3): 23, (2, 5): 23}
    # without any window of their own, all items of such a window are named
    short = spark.createDataFrame([(i, f"{lead} {'x' * (i + 1)}") for i in range(8)], "item_id long, text string")
    assert len(decontam.contaminations(frame(spark, docs[:1]), short, common=100).collect()) == 8


@pytest.mark.parametrize("at_end", [False, True])
def test_windows_of_very_many_classes_name_all_their_pairs(spark, monkeypatch, at_end):
    rng = random.Random(8)
    lead = "Please read the following 3 texts with care and then answer Tom in 5 words below it"
    put = lambda own: f"{own} {lead}" if at_end else f"{lead} {own}"
    items = [put(data.words(rng, 9 + i % 4)) for i in range(80)] + [data.words(rng, 20) for _ in range(5)]
    items += [f"please answer the next question as well as you can {data.words(rng, 9)}" for _ in range(70)]  # too short to tell
    asked = lead.replace("3", "8").replace("Tom", "Eve")
    docs = [f"{data.words(rng, 9)} {asked} {data.words(rng, 9)}", items[3], items[82], data.words(rng, 60)]
    docs += [f"{data.words(rng, 9)} {items[90].rsplit(' ', 9)[0]} {data.words(rng, 9)}", put(items[7].replace(lead, "")).replace("3", "6"), asked.replace("words", "other words")]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = frame(spark, docs)
    rows = rows.unionByName(rows.where("doc_id = 0").selectExpr("cast(null as long) doc_id", *rows.columns[1:]))
    told = lambda df: sorted(((-1 if r.doc_id is None else r.doc_id, *r[1:]) for r in df.collect()))
    got = told(decontam.contaminations(rows, bench))
    pairs = {(r[0], r[2]) for r in got}
    assert {(d, i) for d in (-1, 0, 1, 5) for i in range(80)} | {(2, 82)} <= pairs and not {d for d, _ in pairs} & {3, 4}
    kept = {r.doc_id for r in decontam.decontaminate(rows, bench).collect()}
    assert kept == set(range(7)) - {d for d, _ in pairs}
    monkeypatch.setattr(decontam, "COMMON", 10**6)  # each pair by itself
    assert got == told(decontam.contaminations(rows, bench))


def plain_windows(ws, size=8):
    return {" ".join(ws[i : i + size]): i for i in range(len(ws) - size + 1)}


def test_plain_text_against_brute_force(spark):
    """Lower-case words only: covered words are those of common runs of eight words."""
    rng = random.Random(6)
    items = [data.words(rng, rng.randint(15, 40)) for _ in range(15)]
    docs, want = [], {}
    for i in range(200):
        k = rng.randrange(15)
        ws = items[k].split()
        a = rng.randint(0, len(ws) - 9)
        part = ws[a : a + rng.randint(6, 20)]
        if i % 3 == 0 and len(part) > 10:
            part = [*part[:9], data.words(rng, 1), *part[9:]]
        body = [*data.words(rng, 15).split(), *part, *data.words(rng, 15).split()]
        docs.append(" ".join(body))
        theirs = plain_windows(ws)
        met = {p for w in plain_windows(body) if (p := theirs.get(w)) is not None}
        covered = len({x for p in met for x in range(p, p + 8)})
        if covered >= 13:
            want[i, k] = covered
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.covered for r in decontam.contaminations(frame(spark, docs), bench).collect()}
    assert got == want


def test_windows_against_slow_ones():
    """Hashes agree exactly where the template words do, whatever stands around them."""
    rng = random.Random(7)
    texts = [" ".join(rng.choice(["12", "7kg", "Tom Lee", "kg", "three", "of", "the", "3*4", "word", "(x)", "—", "it's"]) for _ in range(rng.randint(0, 40))) for _ in range(60)]
    folded, named, _ = decontam.read(pa.array([*texts, None, ""]), decontam.Lexicon())
    seen: dict = {}
    for sort, r, at, end, h in decontam.window_sets(folded, named, [(decontam.FOLDED, 5), (decontam.NAMED, 4), (decontam.EXACT, 3)]):
        for p, q, x in zip(at.tolist(), end.tolist(), h.tolist()):
            assert r.text[p] == r.text[q - 1]
            plain = int((r.kind[p:q] == decontam.PLAIN).sum())
            assert (plain < 3) == (sort == decontam.EXACT)
            words = tuple((k, v) if sort == decontam.EXACT or k == decontam.PLAIN else (k, 0) for k, v in zip(r.kind[p:q].tolist(), r.value[p:q].tolist()))
            if sort == decontam.EXACT:
                words = tuple(v for _, v in words)
            assert seen.setdefault((sort, words), x) == x
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize(("word", "kinds"), [("5kg,", [1, 2]), ("12+7", [1, 0, 1]), ("(Tom's)", [3]), ("A", [0]), ("—", []), ("3x", [1, 0]), ("1,000.50", [1]), ("$5", [1]), ("NASA", [0]), ("=", [0]), ("50%", [1, 2]), ("", []), ("in", [5])])
def test_kinds_of_words(word, kinds):
    assert [k for k, _ in decontam.look(word)] == kinds


def test_order_of_words_is_kept():
    assert re.sub(r"\d", "#", SHAPES[0]) == SHAPES[0]
    a, b = (decontam.read(pa.array([t]), decontam.Lexicon())[0] for t in ("one dog two", "two dog one"))
    assert a.kind.tolist() == b.kind.tolist() and a.value.tolist() != b.value.tolist()


def test_filters_reach_the_driver_packed(spark):
    """A few thousand windows take no megabytes of the driver, and the filter has a bit for each of them and no other."""
    import numpy as np

    hashes = spark.range(0, 4000, 1, 8).select(F.xxhash64("id").alias("h"))
    assert sum(len(r.bits) for r in decontam.partial_filters(hashes).collect()) < 400_000
    want = {(r.h % 2**64) >> (64 - decontam.FILTER_BITS) for r in hashes.collect()}
    got = np.unpackbits(np.frombuffer(decontam.window_filter(hashes), np.uint8), bitorder="little")
    assert len(got) == 1 << decontam.FILTER_BITS and set(np.flatnonzero(got).tolist()) == want
