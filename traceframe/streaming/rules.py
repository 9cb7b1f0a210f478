"""Process lists that can change while a capture runs.

Changes are appended to a log; nothing is overwritten, so a batch that
reads while a change is written sees either state. A change takes effect with the next
micro-batch. A change's number is the version of the lists that it makes. Each batch of a capture
is pinned to the version it began with, so that a batch that is run again sees the same lists.

Reading a version takes a snapshot and the changes after it. Compaction writes a new
snapshot, which counts from the moment its control file appears; older ones stay for versions
that batches are pinned to.
"""

from __future__ import annotations

import hashlib
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traceframe.operators.filters import member_join
from traceframe.operators.manifest import local_table
from traceframe.streaming import files

CHANGES = "seq BIGINT, kind STRING, action STRING, pid BIGINT"


class PidRules:
    """Allow and deny lists kept in the log at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, kind: str, *pids: int) -> None:
        self._append(kind, "add", pids)

    def remove(self, kind: str, *pids: int) -> None:
        self._append(kind, "remove", pids)

    def reset(self, kind: str) -> None:
        self._append(kind, "reset", (None,))

    def _append(self, kind: str, action: str, pids) -> None:
        if kind not in ("allow", "deny"):
            raise ValueError(f"kind is allow or deny, not {kind!r}")
        # Later than all that is there, whatever this writer's clock says.
        seq = max(time.time_ns(), self.version() + 1)
        rows = [(seq, kind, action, pid) for pid in pids]
        tail = f"{self.path}/changes/since={self._snapshots()[-1][0]}"
        local_table(self.spark, rows, CHANGES).coalesce(1).write.mode("append").parquet(tail)

    def version(self) -> int:
        """The number of the last change; 0 before the first."""
        last = self.changes().agg(F.max("seq")).first()[0]
        return max(last or 0, self._snapshots()[-1][1])

    def current(self, version: int | None = None) -> DataFrame:
        """``kind`` and ``pid`` of the lists as they stand, or as they stood at a version."""
        return current_rules(self.changes(version))

    def changes(self, version: int | None = None) -> DataFrame:
        """The last snapshot and the changes after it, up to ``version``; empty before the first change."""
        number, seq = [s for s in self._snapshots() if version is None or s[1] <= version][-1]
        parts = []
        if number:
            parts.append(self._read(f"snapshots/{number}"))
        # A change may have been written beside the snapshot that was made meanwhile.
        for since in range(max(number - 1, 0), self._snapshots()[-1][0] + 1):
            if files.exists(self.spark, f"{self.path}/changes/since={since}"):
                parts.append(self._read(f"changes/since={since}").where(F.col("seq") > seq))
        if not parts:
            return local_table(self.spark, [], CHANGES)
        all_ = parts[0]
        for more in parts[1:]:
            all_ = all_.unionByName(more)
        return all_ if version is None else all_.where(F.col("seq") <= version)

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.schema(CHANGES).parquet(f"{self.path}/{name}")

    def _snapshots(self) -> list[tuple[int, int]]:
        """(number, version) of the snapshots that count; the empty one is number 0."""
        found = [(0, 0)]
        for name in files.names(self.spark, f"{self.path}/snapshots"):
            if name.endswith(".json"):
                value = files.get(self.spark, f"{self.path}/snapshots/{name}")
                if value is not None:
                    found.append((int(name.removesuffix(".json")), value["version"]))
        return sorted(found)

    def compact(self) -> None:
        """Make a snapshot of the lists as they stand. Changes may be written meanwhile; of two compactions one counts."""
        version, number = self.version(), self._snapshots()[-1][0] + 1
        if version == self._snapshots()[-1][1]:
            return
        now = [(version, r.kind, "add", r.pid) for r in self.current(version).collect()]
        path = f"{self.path}/snapshots/{number}"
        local_table(self.spark, now, CHANGES).coalesce(1).write.mode("overwrite").parquet(path)
        files.put_new(self.spark, f"{path}.json", {"version": version})


def current_rules(changes: DataFrame) -> DataFrame:
    """Each process's last change since the last reset of its list, if it is an add."""
    resets = changes.where("action = 'reset'").groupBy("kind").agg(F.max("seq").alias("since"))
    last = changes.where("action <> 'reset'").groupBy("kind", "pid").agg(
        F.max_by("action", "seq").alias("action"), F.max("seq").alias("seq")
    )
    return (
        last.join(resets, "kind", "left")
        .where((F.col("action") == "add") & (F.coalesce("since", F.lit(-1)) < F.col("seq")))
        .select("kind", "pid")
    )


def apply_rules(rules: DataFrame):
    """Filter records by the lists; an allow list, if any, decides alone."""

    def apply(df: DataFrame) -> DataFrame:
        there = {r.kind for r in rules.select("kind").distinct().collect()}
        for kind, keep in (("allow", True), ("deny", False)):
            if kind in there:
                return member_join(df, F.col("ProcessId"), rules.where(F.col("kind") == kind).select("pid"), keep)
        return df

    return apply


class LiveRules:
    """Filter of each micro-batch by the lists at ``path`` as they stand when the batch first begins."""

    def __init__(self, path: str):
        self.path = path

    def __call__(self, batch: DataFrame) -> DataFrame:
        return apply_rules(PidRules(batch.sparkSession, self.path).current())(batch)

    def for_batch(self, batch: DataFrame, batch_id: int, capture: str) -> DataFrame:
        """The same for a numbered batch of a capture, known by its checkpoint: pinned to one version."""
        rules = PidRules(batch.sparkSession, self.path)
        return apply_rules(rules.current(self.pinned(rules, batch_id, capture)))(batch)

    def pinned(self, rules: PidRules, batch_id: int, capture: str) -> int:
        """The version of a batch: the one it was pinned to, or the last, to which it is pinned now."""
        key = hashlib.sha256(capture.encode()).hexdigest()[:16]
        pin = f"{self.path}/pins/{key}/{batch_id}.json"
        known = files.get(rules.spark, pin)
        if known is None:
            files.put_new(rules.spark, pin, {"version": rules.version()})
            known = files.get(rules.spark, pin)
        return known["version"]


def live_rules(path: str) -> LiveRules:
    """Per micro-batch filter by the lists at ``path``."""
    return LiveRules(path)
