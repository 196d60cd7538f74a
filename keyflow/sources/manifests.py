"""Versions of a small JSON document in a folder of any file system that Spark reaches.

A document is written under another name and renamed to its number, so a reader never sees half of one, and the
newest number is the state. Tables list their data folders in it instead of listing the file system.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Manifests:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _place(self, name: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Complete versions, oldest first."""
        place, files = self._place("*.json")
        return sorted(int(status.getPath().getName().partition(".")[0]) for status in files.globStatus(place) or [])

    def read(self, version: int) -> dict:
        place, files = self._place(f"{version}.json")
        stream = files.open(place)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write(self, version: int, document: dict) -> None:
        unfinished, files = self._place(f"_{version}-{uuid.uuid4().hex}")
        stream = files.create(unfinished, True)
        stream.write(bytearray(json.dumps(document).encode()))
        stream.close()
        final, _ = self._place(f"{version}.json")
        files.delete(final, False)
        if not files.rename(unfinished, final):
            raise OSError(f"{final} could not be written")

    def remove(self, version: int) -> None:
        place, files = self._place(f"{version}.json")
        files.delete(place, False)
