"""The document about a run."""

import json

import pytest

from tidewell.plans import report


def test_phases_tell_their_jobs_and_how_they_were_divided(spark, tmp_path):
    run = report.Run(spark)
    with run.phase("wide"):
        spark.range(0, 1000, 1, 7).repartition(5).count()
    with run.phase("idle"):
        pass
    with pytest.raises(Exception, match="stop here"), run.phase("bad"):
        spark.range(3).selectExpr("raise_error('stop here')").collect()
    wide, idle, bad = run.phases
    assert (wide["outcome"], idle["outcome"], bad["outcome"]) == ("done", "done", "failed")
    assert wide["most_tasks_of_a_stage"] == 7 and wide["tasks"] >= 13 and wide["failed_tasks"] == 0 and wide["seconds"] > 0
    assert idle["jobs"] == idle["tasks"] == 0 and bad["failed_jobs"] == 1
    (tmp_path / "src").mkdir()
    for i in range(3):
        (tmp_path / "src" / f"{i}.jsonl").write_text("{}\n" * 5)
    doc = run.document(root=f"file://{tmp_path}", contracts=["src"])
    assert doc["splits"]["src"] >= 1 and [p["phase"] for p in doc["phases"]] == ["wide", "idle", "bad"]
    report.write(spark, f"file://{tmp_path}/out", doc)
    assert json.loads((tmp_path / "out" / "run_report.json").read_text()) == json.loads(json.dumps(doc))
