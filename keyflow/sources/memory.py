"""The memory of accepted keys between batches: runs of narrow rows, merged as they grow, found without a listing.

Each batch adds one run with the last accepted place of its keys. Runs of one level are merged into one of the next as soon as
there are ``FAN`` of them, so ``n`` batches leave at most ``FAN`` runs for each power of ``FAN`` in ``n``, and a key is
rewritten once per level. A manifest names the runs with the time of their newest place: a run that is over a TTL older than
the batch is not read, and one two TTLs older not kept. What a batch reads depends on the keys of one TTL, not on how many batches there were.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from keyflow import schemas as S
from keyflow.session import remove_folder
from keyflow.sources.manifests import Manifests

FAN = 8
KEPT = S.struct(dedup_key="string", topic="string", partition="int", offset="bigint", arrival_ts="timestamp")


class KeyMemory:
    """The state after a batch is the version with the batch's number; the newest ``keep`` states stay for repeats."""

    def __init__(self, spark: SparkSession, path: str, ttl_us: int, fan: int = FAN, keep: int = 3):
        self.spark, self.path, self.ttl_us, self.fan, self.keep = spark, path.rstrip("/"), ttl_us, fan, keep
        self.manifests = Manifests(spark, f"{self.path}/manifests")

    def state_before(self, batch_id: int) -> tuple[int, list[dict]] | None:
        """The newest state before a batch: its number and runs, -1 and none at the start; None if it is gone."""
        versions = self.manifests.versions()
        before = [version for version in versions if version < batch_id]
        if not before:
            return None if versions else (-1, [])
        return before[-1], self.manifests.read(before[-1])["runs"]

    def read(self, runs: list[dict], alive_us: int | None = None) -> DataFrame | None:
        """Rows of the runs that may hold places after ``alive_us``; None without any."""
        folders = [run["folder"] for run in runs if alive_us is None or run["newest_us"] > alive_us]
        return self.spark.read.schema(KEPT).parquet(*(f"{self.path}/{folder}" for folder in folders)) if folders else None

    def add(self, batch_id: int, accepted: DataFrame, oldest_us: int | None = None) -> None:
        """The accepted rows of a batch become a run of its state; running it again replaces that.

        What is two TTLs older than ``oldest_us``, the first arrival of the batch, goes: the next batch may come from
        the same stretch of time, however long that is. Without it the newest place counts.
        """
        state = self.state_before(batch_id)
        if state is None:
            return
        runs = [*state[1], *self._write(accepted, 0)]
        newest = max((run["newest_us"] for run in runs), default=0)
        expired = (newest if oldest_us is None else min(newest, oldest_us)) - 2 * self.ttl_us
        runs = [run for run in runs if run["newest_us"] > expired]
        level = 0
        while any(run["level"] >= level for run in runs):
            same = [run for run in runs if run["level"] == level]
            if len(same) >= self.fan:
                merged = self.read(same).filter(F.col("arrival_ts") > F.timestamp_micros(F.lit(expired)))
                runs = [run for run in runs if run["level"] != level] + self._write(merged, level + 1)
            level += 1
        replaced = self._folders([batch_id]) if batch_id in self.manifests.versions() else set()
        self.manifests.write(batch_id, {"runs": runs})
        self._clean(replaced)

    def _write(self, rows: DataFrame, level: int) -> list[dict]:
        """One run, with one row per key: its last place. Nothing if there is no row."""
        order = F.struct("arrival_ts", "partition", "offset", "topic")
        last = rows.groupBy("dedup_key").agg(F.max(order).alias("last"))
        folder, seen = f"run-{uuid.uuid4().hex}", Observation()
        newest = F.max(F.unix_micros("arrival_ts")).alias("newest")
        last.select("dedup_key", "last.*").observe(seen, newest).select(*KEPT.names).write.parquet(f"{self.path}/{folder}")
        if seen.get["newest"] is None:
            remove_folder(self.spark, f"{self.path}/{folder}")
            return []
        return [{"folder": folder, "level": level, "newest_us": seen.get["newest"]}]

    def _folders(self, versions: list[int]) -> set[str]:
        return {run["folder"] for version in versions for run in self.manifests.read(version)["runs"]}

    def _clean(self, replaced: set[str]) -> None:
        """Old states go, and the runs that no other state has."""
        versions = self.manifests.versions()
        old, kept = versions[: -self.keep], versions[-self.keep :]
        if not old and not replaced:
            return
        for folder in (replaced | self._folders(old)) - self._folders(kept):
            remove_folder(self.spark, f"{self.path}/{folder}")
        for version in old:
            self.manifests.remove(version)
