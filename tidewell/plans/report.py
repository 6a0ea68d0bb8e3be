"""A document about one run: its phases with their seconds and Spark jobs, how the work was divided, rates and dead letters."""

from __future__ import annotations

import json
import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from ..sources import storage
from .documents import canonical, code_state


@dataclass
class Run:
    """Collects a run's phases; what Spark's status tracker says of a phase's jobs is taken when it ends."""

    spark: SparkSession
    started: str = field(default_factory=lambda: datetime.now(UTC).isoformat(timespec="seconds").replace("+00:00", "Z"))
    phases: list[dict] = field(default_factory=list)

    @contextmanager
    def phase(self, name: str):
        """All jobs that the block starts belong to the phase, also where it fails."""
        sc = self.spark.sparkContext
        tag = f"phase-{uuid.uuid4().hex}"
        sc.setJobGroup(tag, name)
        began = time.monotonic()
        ended = "failed"
        try:
            yield
            ended = "done"
        finally:
            self.phases.append({"phase": name, "outcome": ended, "seconds": round(time.monotonic() - began, 3)} | self._jobs(tag))
            sc._jsc.clearJobGroup()

    def _jobs(self, tag: str) -> dict:
        """Jobs, stages and tasks of a phase; a stage that was skipped, as its output was there, has no tasks that ran."""
        tracker = self.spark.sparkContext.statusTracker()
        jobs = [j for j in map(tracker.getJobInfo, tracker.getJobIdsForGroup(tag)) if j is not None]
        stages = [s for i in {i for j in jobs for i in j.stageIds} if (s := tracker.getStageInfo(i)) is not None and s.numCompletedTasks]
        widest = max(stages, key=lambda s: s.numTasks, default=None)
        return {
            "jobs": len(jobs), "failed_jobs": sum(j.status == "FAILED" for j in jobs), "stages": len(stages), "tasks": sum(s.numCompletedTasks for s in stages), "failed_tasks": sum(s.numFailedTasks for s in stages),
            "most_tasks_of_a_stage": widest.numTasks if widest else 0,
        }

    def document(self, encoded=None, artifacts=None, root: str | None = None, contracts=()) -> dict:
        """Everything that was collected, with the splits of the sources under ``root`` and the rates of ``encoded``."""
        out = {"run_started_at": self.started, "phases": self.phases, "seconds": round(sum(p["seconds"] for p in self.phases), 3), "parallelism": self.spark.sparkContext.defaultParallelism, "code_sha256": code_state()["sha256"]}
        if root is not None:
            # files are divided by size: as many tasks read a source as it has splits
            out["splits"] = {n: self.spark.read.text(f"{root}/{n}").rdd.getNumPartitions() for n in contracts}
        if artifacts is not None:
            out |= {"preprocessing_state_sha256": artifacts.sha256(), "preprocessing_version": artifacts.policy.version}
        if encoded is not None:
            out["metrics"] = [r.asDict() for r in encoded.metrics.orderBy("metric", "label").collect()]  # a row a rate and label
            letters = encoded.quarantine.groupBy("source", "reason").count().collect()
            out["quarantine"] = {"total": sum(r["count"] for r in letters), "by_source": {s: {r["reason"]: r["count"] for r in letters if r["source"] == s} for s in sorted({r["source"] for r in letters})}}
        return out


def write(spark: SparkSession, path: str, document: dict) -> None:
    """The document as ``run_report.json``, indented for people."""
    storage.write_text(spark, f"{path}/run_report.json", json.dumps(json.loads(canonical(document)), sort_keys=True, ensure_ascii=False, indent=2) + "\n")
