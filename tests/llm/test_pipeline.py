"""The pipeline stage by stage and as a whole, against brute force on a small corpus."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import data
from tests.llm.test_operators import brute_classes, brute_fingerprint, brute_lines
from tidewell.llm import queries as llm_queries


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(12)
    bad = ["grumbix", "vlottek", "quazzel"]
    items = [data.words(rng, 30) for _ in range(5)]
    rows, labels, toxic, leaks = [], [], set(), set()
    for i in range(400):
        ws = data.words(rng, 80).split()
        if i % 5 == 0:
            toxic.add(i)
            for _ in range(6):
                ws.insert(rng.randrange(80), rng.choice(bad))
        elif i % 17 == 0:
            leaks.add(i)
            ws[40:40] = items[i % 5].split()
        lines = [" ".join(ws[k : k + 20]) for k in range(0, len(ws), 20)]
        if i % 3 == 0:
            lines.insert(1, "Subscribe to our letter")
        rows.append((i, "\n".join(lines), "en", f"s{i % 4}", 0))
        if i % 2 == 0 or i % 5 == 0:
            labels.append((i, 1, int(i in toxic)))
    rows += [(1000 + i, rows[i][1], "en", "s1", 0) for i in (1, 2, 3, 4)]
    root = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, data.DOC).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root), {r[0]: r[1] for r in rows}, toxic, leaks


def test_stages(spark, corpus):
    root, texts, toxic, leaks = corpus
    docs = spark.read.parquet(f"{root}/documents.parquet")
    names = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, root))
        assert docs.columns == names, name
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    assert set(texts) - set(kept["toxicity"]) == toxic
    ids = sorted(kept["toxicity"])
    want = dict(zip(ids, brute_lines([texts[i] for i in ids], 10)))
    assert kept["line_dedup"] == want
    classes = brute_classes(ids, [brute_fingerprint(want[i]) for i in ids])
    assert set(kept["simhash_near_dedup"]) == set(classes) and not any(i >= 1000 for i in classes)
    assert set(kept["simhash_near_dedup"]) - set(kept["decontamination"]) == leaks
    assert docs.where("n_chars != length(text)").count() == 0
    out = corpus_pipeline.STAGES[-1][1](spark, docs, root)
    assert {r.doc_id for r in out.collect()} == set(kept["decontamination"])
    import duckdb

    c = duckdb.connect()
    c.register("kept_rows", docs.toPandas())
    shown = lambda r: (r[0], r[1], r[2], round(r[3], 6), r[4])
    assert sorted(shown(r) for r in out.select("doc_id", "size", "source_size", "target", "taken").collect()) == sorted(shown(r) for r in c.execute(llm_queries.OP1_SQL.format(docs="kept_rows")).fetchall())
    before = spark.conf.get(corpus_pipeline._BATCH)
    whole = sorted(map(tuple, corpus_pipeline.run(spark, root).collect()))
    assert spark.conf.get(corpus_pipeline._BATCH) == before
    assert whole == sorted(map(tuple, out.collect()))


def test_stages_on_odd_and_empty_tables(spark, corpus, tmp_path):
    root = corpus[0]
    empty_root = str(tmp_path)
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{root}/{t}.parquet").limit(0).write.parquet(f"{empty_root}/{t}.parquet")
    odd = data.odd(spark)
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, data.empty(spark)):
            for where in (root, empty_root):
                out = stage(spark, docs, where)
                assert (out.columns == docs.columns) or name == "mixing"
                assert (out.agg(F.count("*")).first()[0] > 0) == (docs is odd)
