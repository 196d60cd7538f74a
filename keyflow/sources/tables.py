"""Sinks: batch-keyed tables, the bucketed and versioned customer snapshot, outbound records.

A batch may be run again after a failure, so each table keeps a batch in a folder of its own that a
repeat overwrites.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow import schemas as S
from keyflow.operators.upsert import merge_snapshot, merge_statement
from keyflow.session import remove_folder, scratch_path
from keyflow.sources.codecs import encode
from keyflow.sources.manifests import Manifests

MISSING = "PATH_NOT_FOUND"
#: Buckets of a new snapshot; one is rewritten as a whole by one task, so size them to some hundred MB.
BUCKETS = 16
#: So many batch numbers are looked up one by one; a longer range lists the folders.
FEW_BATCHES = 64


def _exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def read_if_present(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """A table, or None when its folder does not exist yet or is just being replaced."""
    if not _exists(spark, path):
        return None
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != MISSING:
            raise
        return None


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.drop("batch_id").write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_range(spark: SparkSession, path: str, schema: T.StructType, first: int, last: int) -> DataFrame | None:
    """The batches from ``first`` to ``last`` by their numbers: a short range lists no other folder. None without any."""
    if last - first < FEW_BATCHES:
        found = [number for number in range(first, last + 1) if _exists(spark, f"{path}/batch_id={number}")]
    else:
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id=*")
        listed = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or []
        numbers = sorted(int(status.getPath().getName().partition("=")[2]) for status in listed)
        found = [number for number in numbers if first <= number <= last]
    if not found:
        return None
    return spark.read.schema(schema).option("basePath", path).parquet(*(f"{path}/batch_id={number}" for number in found))


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All batches; a filter on ``batch_id`` prunes folders."""
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def read_batch(spark: SparkSession, path: str, schema: T.StructType, batch_id: int) -> DataFrame:
    """One batch; only its folder is listed."""
    stored = T.StructType([field for field in schema if field.name != "batch_id"])
    rows = spark.read.schema(stored).parquet(f"{path}/batch_id={batch_id}")
    return rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")).select(*schema.names)


class SnapshotTable:
    """Customer snapshot without row-level changes, in hash buckets of ``customerId``.

    A version is a manifest, written last, that says for every bucket which version wrote it. A merge reads and rewrites the
    buckets that its updates touch and refers to the others, so a small batch costs what it changes. Readers take
    the newest manifest, never see a version that is being written, and a failed write changes nothing. The newest
    ``keep`` versions stay for readers that began before; then folders that none of them names are removed.
    """

    def __init__(self, spark: SparkSession, path: str, keep: int = 3, buckets: int = BUCKETS):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keep = keep
        self.buckets = buckets
        self.manifests = Manifests(spark, f"{self.path}/manifests")

    def versions(self) -> list[int]:
        """Complete versions, oldest first."""
        return self.manifests.versions()

    def current(self) -> int:
        """The version in use; -1 before the first write."""
        return max(self.versions(), default=-1)

    def written_by(self, version: int) -> dict[int, int]:
        """For every bucket with rows, the version that wrote it."""
        return {int(bucket): writer for bucket, writer in self.manifests.read(version)["written_by"].items()}

    def read(self) -> DataFrame:
        version = self.current()
        return self._rows({} if version < 0 else self.written_by(version))

    def folder(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def _rows(self, written_by: dict[int, int]) -> DataFrame:
        if not written_by:
            return self.spark.createDataFrame([], S.CUSTOMER)
        folders = [f"{self.folder(writer)}/_bucket={bucket}" for bucket, writer in written_by.items()]
        return self.spark.read.schema(S.CUSTOMER).parquet(*folders)

    def _write(self, rows: DataFrame, version: int, buckets: int) -> None:
        bucket = F.pmod(F.hash("customerId"), F.lit(buckets))
        keyed = rows.select(*S.CUSTOMER.names, bucket.alias("_bucket")).repartition("_bucket")
        keyed.write.mode("overwrite").partitionBy("_bucket").parquet(self.folder(version))

    def replace(self, snapshot: DataFrame, version: int) -> None:
        """A whole new snapshot; its buckets may be more or fewer than before."""
        self._write(snapshot, version, self.buckets)
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder(version)}/_bucket=*")
        found = place.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(place) or []
        written_by = {int(status.getPath().getName().partition("=")[2]): version for status in found}
        self._publish(version, self.buckets, written_by)

    def merge(self, updates: DataFrame, version: int) -> bool:
        """Merge one document per customer as ``version``; False if that version is already in."""
        current = self.current()
        if version <= current:
            return False
        buckets = self.manifests.read(current)["buckets"] if current >= 0 else self.buckets
        before = self.written_by(current) if current >= 0 else {}
        path, seen = scratch_path(self.spark, "updates"), Observation()
        touched = F.collect_set(F.pmod(F.hash("customerId"), F.lit(buckets))).alias("touched")
        updates.select(*S.CUSTOMER.names).observe(seen, touched).write.parquet(path)
        changed = seen.get["touched"]
        if changed:
            old = self._rows({bucket: before[bucket] for bucket in changed if bucket in before})
            self._write(merge_snapshot(old, self.spark.read.schema(S.CUSTOMER).parquet(path)), version, buckets)
        self._publish(version, buckets, before | dict.fromkeys(changed, version))
        return True

    def _publish(self, version: int, buckets: int, written_by: dict[int, int]) -> None:
        self.manifests.write(version, {"buckets": buckets, "written_by": written_by})
        versions = self.versions()
        old, kept = versions[: -self.keep], versions[-self.keep :]
        named = {part for number in kept for part in self.written_by(number).items()} if old else set()
        writers = {writer for _, writer in named}
        for number in old:
            for bucket, writer in set(self.written_by(number).items()) - named:
                remove_folder(self.spark, f"{self.folder(writer)}/_bucket={bucket}" if writer in writers else self.folder(writer))
            self.manifests.remove(number)


def merge_into(updates: DataFrame, target: str) -> None:
    """The same merge for a catalog table whose format supports MERGE."""
    view = "keyflow_updates"
    updates.createOrReplaceTempView(view)
    updates.sparkSession.sql(merge_statement(target, view))


def to_kafka_rows(records: DataFrame, codec: str = "json", schema_id: int | None = None) -> DataFrame:
    """Outbound records in the columns the Kafka sink expects."""
    return records.select(
        "topic",
        F.col("key").cast("binary").alias("key"),
        encode(F.col("event"), codec, schema_id).alias("value"),
        "headers",
    )


def write_kafka(rows: DataFrame, options: dict[str, str]) -> None:
    rows.write.format("kafka").options(**options).option("includeHeaders", "true").save()
