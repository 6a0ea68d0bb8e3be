"""Inputs that once stopped a job or lost part of a row."""

from __future__ import annotations

import random
import struct
import time

import pytest
from pyspark.sql import functions as F

from tidewell.llm import html_extract, media, secrets, url_rules


# --- containers ---


def box(kind, *parts):
    body = b"".join(parts)
    return struct.pack(">I4s", len(body) + 8, kind.encode()) + body


def patched(data, kind, at, code, *numbers):
    """The file with numbers written into the first box of a kind, counted from its content."""
    where = data.index(kind.encode()) + 4 + at
    new = struct.pack(f">{code}", *numbers)
    return data[:where] + new + data[where + len(new) :]


FILE = media.mux(media.pad(bytes(range(256)) * 40))

BAD = {
    "chunk that is not there": patched(FILE, "stsc", 8, "I", 7),
    "chunk zero": patched(FILE, "stsc", 8, "I", 0),
    "key frame that is not there": patched(FILE, "stss", 8, "I", 10**6),
    "very many samples": patched(FILE, "stsz", 4, "II", 576, 2**32 - 1),
    "very many sizes": patched(FILE, "stsz", 4, "II", 0, 2**32 - 1),
    "a table longer than its box": patched(FILE, "stco", 4, "I", 10**6),
    "an empty media header": box("moov", box("trak", box("mdia", box("mdhd")))),
    "nested too deep": b"".join(struct.pack(">I4s", 8 * (1500 - i), b"moov") for i in range(1500)),
    "fragments": FILE + box("moof", box("traf", box("trun", bytes(12)))),
    "no file": b"abc",
}


@pytest.mark.parametrize("data", BAD.values(), ids=BAD)
def test_bad_containers_are_errors(data):
    begin = time.time()
    with pytest.raises(media.MediaError):
        for t in media.parse(data):
            media.samples(data, t), media.feature(t)
    assert time.time() - begin < 2


def test_changed_containers_give_tracks_or_errors():
    rng = random.Random(2)
    good = 0
    for _ in range(10_000):
        data = bytearray(FILE[: rng.choice([len(FILE)] * 9 + [rng.randrange(len(FILE))])])
        for _ in range(rng.randint(1, 6)):
            at = rng.randrange(min(len(data), 900)) if data else 0
            if data:
                data[at] = rng.choice([0, 1, 255, rng.randrange(256)])
        try:
            for t in media.parse(bytes(data)):
                media.samples(bytes(data), t), media.feature(t)
            good += 1
        except media.MediaError:
            pass
    assert 100 < good < 9_900


def test_compact_sample_sizes_are_read():
    sizes = [3, 5, 0, 7, 15]
    for bits, packed in ((4, bytes([0x35, 0x07, 0xF0])), (8, bytes(sizes)), (16, struct.pack(">5H", *sizes))):
        payload = bytes(range(sum(sizes)))
        stbl = box("stbl", box("stz2", struct.pack(">III", 0, bits, 5), packed), box("stsc", struct.pack(">IIIII", 0, 1, 1, 5, 1)), box("stco", struct.pack(">III", 0, 1, 8)))
        data = box("mdat", payload) + box("moov", box("trak", box("mdia", box("minf", stbl))))
        (t,) = media.parse(data)
        assert t.sizes == sizes and media.samples(data, t) == payload


def test_a_bad_row_is_an_error_of_its_own(spark):
    df = spark.createDataFrame([(i, bytearray(d)) for i, d in enumerate([FILE, *BAD.values()])], "id int, media binary")
    got = {r.id: r for r in media.inspect(df).collect()}
    assert got[0].error is None and got[0].n_samples and all(got[i].error and got[i].n_samples is None for i in range(1, len(BAD) + 1))


# --- URLs ---


def test_long_urls_keep_all_tokens(spark):
    url = "http://" + ".".join(f"l{i}" for i in range(40)) + "/" + "/".join(f"s{'abcdefghij'[i % 10]}{'abcdefghij'[i // 10]}" for i in range(100)) + "?q=1"
    df = url_rules.split_url(spark.createDataFrame([(url,), ("http://a/",), ("http://a.b",), ("http://a.b/c",)], "url string"))
    got = [set(r.t) for r in df.select(url_rules.tokens(F.col("host"), F.col("path"), F.col("url")).alias("t")).collect()]
    assert sum(t.startswith("h") and t[1].isdigit() and t[1] != "0" for t in got[0]) == 38 and sum(t.startswith("p=") for t in got[0]) == 99
    assert got[1:] == [{"h0=a"}, {"h0=b", "hh=a.b"}, {"h0=b", "hh=a.b", "p1=c"}]


def labelled(spark, rows):
    return spark.createDataFrame([(sorted(t), v) for t, v in rows], "toks array<string>, verdict string")


def test_templates_of_many_keys_are_mined_soon(spark):
    shared = {f"k{i:02d}" for i in range(30)}
    rows = [(shared | {f"o{i}"}, "block") for i in range(10)] + [({f"x{i % 7}", f"y{i % 11}"}, "allow") for i in range(100)]
    begin = time.time()
    mined = url_rules.mine(labelled(spark, rows))
    got = mined.collect()
    assert time.time() - begin < 30
    assert [(r.antecedent, len(r.alike[0])) for r in got if r.verdict == "block"] == [(["k00"], 30)]
    urls = spark.createDataFrame([(["k17"],), (["k17", "z"],), (["x1"],)], "toks array<string>")
    assert {tuple(r.toks): r.mined for r in url_rules.judge(urls, mined).collect()} == {("k17",): "block", ("k17", "z"): "block", ("x1",): "allow"}


def test_rows_of_many_different_tokens_are_mined_soon_and_alike(spark, monkeypatch):
    rng = random.Random(5)
    rows = [({f"k{i:02d}" for i in range(24) if rng.random() < 0.9}, "block") for _ in range(12)] + [({f"x{i % 7}", f"y{i % 11}"}, "allow") for i in range(100)]
    begin = time.time()
    long = url_rules.mine(labelled(spark, rows), max_tokens=3).collect()
    assert time.time() - begin < 60 and all(len(r.antecedent) <= 3 for r in long) and any(r.verdict == "block" for r in long)
    few = [({t for t in "abcdefg" if rng.random() < 0.5}, rng.choice(["block", "allow"])) for _ in range(200)]
    told = lambda: sorted((tuple(r.antecedent), r.verdict, round(r.confidence, 12), round(r.support, 12)) for r in url_rules.mine(labelled(spark, few), min_confidence=0.5).collect())
    one = told()
    monkeypatch.setattr(url_rules, "SHORT", 0)
    assert told() == one and one


# --- pages, secrets ---


def test_all_words_of_an_element_are_features():
    names = " ".join(f"w{'abcdefghijklmnopqrst'[i]}" for i in range(20))
    assert len(html_extract.signs_of("div", f' class="{names}"', False)) == 20


def test_secrets_of_a_text_of_many_matches_in_linear_time(spark):
    took = []
    for n in (4_000, 16_000):
        text = "".join(f"x token={i:06d}abcdef\n" for i in range(n))
        df = spark.createDataFrame([(1, text, "en", "s")], "doc_id long, text string, lang string, source string")
        begin = time.time()
        row = secrets.find(df).select("doc_id", F.size("base").alias("n"), F.col("base")[n - 1].alias("last")).first()
        took.append(time.time() - begin)
        assert row.n == n and text[row.last.start : row.last.end] == f"token={n - 1:06d}abcdef"
    assert took[1] < 5 * took[0] + 2
