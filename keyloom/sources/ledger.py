"""The ledger of a run: which stages are done, where their rows are and what was counted while they were written.

A stage is recorded after its rows are complete, so a run that broke off goes on with the first stage that is not
recorded, and what a recorded stage wrote is neither computed nor appended a second time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyloom.sources.commits import CommitLog


@dataclass(frozen=True)
class Stage:
    rows: DataFrame
    counts: dict


class RunLedger:
    """``<folder>/run_id=<id>/ledger`` has one entry per finished stage, ``.../<stage>-<attempt>`` its rows."""

    def __init__(self, spark: SparkSession, folder: str, run_id: str):
        self.spark, self.run_id = spark, run_id
        self.path = f"{folder.rstrip('/')}/run_id={run_id}"
        self.log = CommitLog(spark, f"{self.path}/ledger")

    def finished(self) -> dict[str, dict]:
        """The entries by stage; a run has a handful."""
        return {e["stage"]: e for e in map(self.log.read, self.log.numbers())}

    def record(self, stage: str, **entry) -> dict:
        numbers = self.log.numbers()
        entry = {"stage": stage, **entry}
        self.log.put(numbers[-1] + 1 if numbers else 0, entry)
        return entry

    def stage(self, name: str, build: Callable[[], DataFrame], measures: Sequence[Column] = (), more: Callable[[], dict] = dict) -> Stage:
        """The rows of a stage, written once; ``rows`` and ``measures`` are counted by that write, ``more`` is asked after it."""
        done = self.finished().get(name)
        if done is None:
            path, seen = f"{self.path}/{name}-{uuid.uuid4().hex}", Observation()
            df = build()
            df.observe(seen, F.count(F.lit(1)).alias("rows"), *measures).write.parquet(path)
            done = self.record(name, path=path, schema=df.schema.jsonValue(), counts={"rows": 0, **seen.get, **more()})
        return Stage(self.spark.read.schema(T.StructType.fromJson(done["schema"])).parquet(done["path"]), done["counts"])

    def value(self, name: str, compute: Callable[[], dict]) -> dict:
        """A small result, worked out once."""
        done = self.finished().get(name) or self.record(name, counts=compute())
        return done["counts"]

    def append_events(self, name: str, events: DataFrame, audit_path: str) -> dict:
        """Append a stage's events as JSON lines and count them by action; a repeated attempt replaces its own lines."""

        def write() -> dict:
            path = f"{audit_path.rstrip('/')}/run_id={self.run_id}/stage={name}"
            events.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
            written = self.spark.read.schema("action string").json(path)
            return {r["action"]: r["count"] for r in written.groupBy("action").count().collect()}  # one row per kind of event

        return self.value(name, write)
