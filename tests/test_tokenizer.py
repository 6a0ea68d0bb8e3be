"""The chain from prepared rows to sequences, against a plain version of it."""

from __future__ import annotations

import json
import random
from bisect import bisect_right
from collections import Counter
from datetime import datetime, timedelta

import pytest

from tidewell.functions import hashing
from tidewell.operators import tokens
from tidewell.plans import tokenizer as tz
from tidewell.plans.preparation import StateMismatch

LAYOUT = tz.Layout(
    {"BUY": ("bucket", "shop", "tags"), "VISIT": ("shop", "tags")}, ("region", "work"), {"bucket": ("bucket_0", "bucket_1"), "region": ("N", "S")}, ("shop", "tags", "work"), ("60", "3600"), ("tags",),
    min_count=3, event_limit=9, sequence_limit=40,
)
EVENT = "client_id string, event_id string, event_type string, position long, ts timestamp_ntz, hour_of_day_local long, day_of_week_local long, lifetime_first boolean, fields string"


def some(seed, clients=12, most=30, train=True):
    rng = random.Random(seed)
    events, profiles = [], []
    for c in range(clients):
        at = datetime(2024, 1, 1)
        for i in range(rng.randint(0, most)):
            at += timedelta(seconds=rng.choice([0, 5, 100, 5000]))
            f = {"shop": rng.choice(["s1", "s2", "s3", "r%d" % rng.randrange(8), "MISSING", "MISSING" if train else "new"]), "tags": rng.choice(["MISSING", ["t1"], ["t1", "t2", "t3"], ["t4", "t1", "t2", "t3", "t5", "t1", "t2"]])}
            kind = rng.choice(["BUY", "VISIT"])
            if kind == "BUY":
                f["bucket"] = rng.choice(["bucket_0", "bucket_1", "MISSING"])
            events.append((f"c{c}", f"e{c}-{i}", kind, i, at, at.hour, at.weekday(), i == 0, json.dumps(f)))
        if c % 5:
            profiles.append((f"c{c}", json.dumps({"region": rng.choice(["N", "S"]), "work": rng.choice(["w1", "w2", "MISSING"])})))
    return events, profiles + [("only", json.dumps({"region": "MISSING", "work": "w1"}))]


def frames(spark, rows, state="a" * 64):
    return tz.Prepared(spark.createDataFrame(rows[0], EVENT).repartition(3), spark.createDataFrame(rows[1], "client_id string, fields string"), state)


def plain_tokens(kind, fields):
    names = LAYOUT.events[kind]
    value = lambda n: fields.get(n, "MISSING") if isinstance(fields.get(n, "MISSING"), list) else [fields.get(n, "MISSING")]
    blocks = [["event_type", [kind]]] + [[n, list(value(n))] for n in names]
    size = lambda: 1 + sum(1 + len(v) for _, v in blocks)
    for b in reversed(blocks):
        while b[0] in LAYOUT.lists and len(b[1]) > 1 and size() > LAYOUT.event_limit:
            b[1].pop()
    while size() > LAYOUT.event_limit:
        blocks.pop()
    return ["[EVT]"] + [t for n, vs in blocks for t in [f"key:{n}", *[f"value:{n}:{v}" for v in vs]]]


def plain_profile(fields):
    return ["[USR]"] + [t for n in LAYOUT.profile for t in (f"key:{n}", f"value:{n}:{fields[n]}")]


def plain_vocabulary(rows):
    seen = Counter(t for e in rows[0] for t in plain_tokens(e[2], json.loads(e[8]))) + Counter(t for p in rows[1] for t in plain_profile(json.loads(p[1])))
    opened = lambda t: t.startswith("value:") and t.split(":")[1] in LAYOUT.open
    keys = sorted(t for t in LAYOUT.always() if t.startswith("key:"))
    closed = sorted(t for t in LAYOUT.always() if t.startswith("value:"))
    often = sorted({t for t, n in seen.items() if opened(t) and n >= LAYOUT.min_count} | {f"value:{n}:MISSING" for n in LAYOUT.open})
    ids = {t: i for i, t in enumerate(tokens.SPECIAL + keys + closed + often + sorted(f"value:{n}:RARE" for n in LAYOUT.open))}
    return ids, {t for t in seen if opened(t)} - set(often)


def plain(train, rows, pad):
    ids, rare = plain_vocabulary(train)
    of = lambda t: ids[t] if t in ids else ids[f"value:{t.split(':')[1]}:RARE"] if t in rare else 1
    profiles = {c: [of(t) for t in plain_profile(json.loads(f))] for c, f in rows[1]}
    out = {}
    for c in {e[0] for e in rows[0]} | set(profiles):
        mine = sorted((e for e in rows[0] if e[0] == c), key=lambda e: e[3])
        head = profiles.get(c, [4])
        kept, room = [], LAYOUT.sequence_limit - len(head)
        for e in reversed(mine):
            t = [of(t) for t in plain_tokens(e[2], json.loads(e[8]))]
            if len(t) > room:
                break
            room -= len(t)
            kept.insert(0, (e, t))
        seq = head + [i for _, t in kept for i in t]
        delta = []
        for i, (e, _) in enumerate(kept):
            gap = None if not i else int((e[4] - kept[i - 1][0][4]).total_seconds())
            delta.append(("FIRST_EVENT" if e[7] else "WINDOW_START") if gap is None else f"bucket_{bisect_right([60, 3600], gap)}")
        begins, at = [], len(head)
        for _, t in kept:
            begins.append(at)
            at += len(t)
        out[c] = (len(kept), len(mine), len(seq), seq + [0] * (pad - len(seq)), [1] * len(seq) + [0] * (pad - len(seq)), begins, [e[1] for e, _ in kept], delta, [{"FIRST_EVENT": 0, "WINDOW_START": 1}.get(d, 2 + int(d[-1]) if d[-1].isdigit() else 0) for d in delta])
    return out


@pytest.fixture(scope="module")
def frozen(spark):
    return tz.fit(frames(spark, some(1)), LAYOUT)


def shown(df):
    return {r.client_id: (r.n_events, r.all_events, r.n_ids, r.input_ids, r.attention_mask, r.event_at, r.event_ids, r.delta, r.delta_ids) for r in df.collect()}


@pytest.mark.parametrize("heavy", [None, 4])
def test_sequences_against_a_plain_version(spark, frozen, heavy):
    rows = some(2, train=False)
    assert shown(tz.encode(frames(spark, rows), frozen, 50, heavy)) == plain(some(1), rows, 50)


def test_vocabulary_ids_are_canonical(frozen):
    ids, rare = plain_vocabulary(some(1))
    got = frozen.vocab.collect()
    assert {r.token: r.id for r in got if r.id is not None} == ids and {r.token for r in got if r.id is None} == rare


def test_joins_give_what_the_look_up_gives(spark, frozen, monkeypatch):
    rows = tz.event_tokens(frames(spark, some(3, train=False)).events, LAYOUT)
    one = {r.event_id: (r.ids, r.n_unk, r.n_rare) for r in tz.with_ids(rows, frozen, ["client_id", "event_id"]).collect()}
    monkeypatch.setattr(tz, "LOOKED_UP", 3)
    assert {r.event_id: (r.ids, r.n_unk, r.n_rare) for r in tz.with_ids(rows, frozen, ["client_id", "event_id"]).collect()} == one
    assert sum(u for _, u, _ in one.values()) and sum(n for _, _, n in one.values())


def test_a_value_outside_its_domain_stops(spark, frozen):
    events, profiles = some(4)
    bad = [*events, ("c1", "bad", "BUY", 999, datetime(2025, 1, 1), 0, 0, False, '{"bucket":"bucket_99","shop":"s1","tags":"MISSING"}')]
    with pytest.raises(Exception, match="bucket:bucket_99"):
        tz.encode(frames(spark, (bad, profiles)), frozen).collect()
    with pytest.raises(Exception, match="no fields are known of the event type OTHER"):
        tz.encode(frames(spark, ([*events, (*bad[-1][:2], "OTHER", *bad[-1][3:])], profiles)), frozen).collect()


def test_another_state_or_vocabulary_is_refused(spark, frozen, tmp_path):
    with pytest.raises(StateMismatch):
        tz.encode(frames(spark, some(2), state="b" * 64), frozen)
    sha = tz.freeze(frozen, f"file://{tmp_path}/t")
    again = tz.thaw(spark, f"file://{tmp_path}/t")
    assert again.sha256() == sha == frozen.sha256() and again.layout == LAYOUT
    assert shown(tz.encode(frames(spark, some(2)), again)) == shown(tz.encode(frames(spark, some(2)), frozen))
    for part in (tmp_path / "t" / "vocabulary").glob("*.json"):
        part.write_text(part.read_text().replace("s1", "s9"))
        (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    with pytest.raises(tz.ForeignVocabulary):
        tz.thaw(spark, f"file://{tmp_path}/t")


def test_the_hash_tells_what_decides(spark, frozen):
    from dataclasses import replace

    other = tz.fit(frames(spark, some(1)), LAYOUT)
    assert other.sha256() == frozen.sha256()  # other partitions, same rows
    assert len({frozen.sha256(), replace(frozen, state_sha256="c").sha256(), replace(frozen, layout=replace(LAYOUT, sequence_limit=41)).sha256(), tz.fit(frames(spark, some(5)), LAYOUT).sha256()}) == 4


def test_digests_do_not_depend_on_order(spark):
    df = spark.createDataFrame([(i % 7, None if i % 3 else f"t{i % 5}") for i in range(100)], "a int, b string")
    assert hashing.table_digest(df.repartition(7)) == hashing.table_digest(df.coalesce(1).orderBy("b"))
    assert hashing.table_digest(df.union(df.limit(1)))[0] != hashing.table_digest(df)[0] != hashing.table_digest(df.na.fill("n"))[0]
    assert hashing.table_digest(df.limit(0)) == ("0" * 64, 0)


def test_empty_rows_and_writing(spark, frozen, tmp_path):
    none = tz.Prepared(spark.createDataFrame([], EVENT), spark.createDataFrame([], "client_id string, fields string"), "a" * 64)
    assert tz.encode(none, frozen).count() == 0
    assert tz.fit(none, LAYOUT).rows == len(tokens.SPECIAL) + len(LAYOUT.always()) + 2 * len(LAYOUT.open)
    s = tz.encode(frames(spark, some(2)), frozen)
    tz.write(s, frozen, f"file://{tmp_path}/out", (16, 64))
    back = spark.read.parquet(f"{tmp_path}/out/sequences")
    assert back.count() == s.count() and back.where("n_ids > length").count() == 0
    got = {r.metric: (r.hits, r.total) for r in tz.report(s, 64).collect()}
    want = plain(some(1), some(2), 64)
    assert got["truncation_rate"] == (sum(w[0] < w[1] for w in want.values()), len(want)) and got["pad_ratio"] == (sum(64 - w[2] for w in want.values()), 64 * len(want))
