"""Small records that say what counts: each version is a file of its own, and none is ever changed."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from paylode.sources.files import children, read_text, rename_new, remove, write_text


@dataclass(frozen=True)
class VersionedRecord:
    """A record with its history, as ``<path>/<number>.json``.

    ``put`` is a compare-and-set: a version is written under a name of its own and renamed into place, which
    fails if another writer was first.  The rename is exclusive where the file system makes it so (HDFS does; a
    local one looks first and renames then).  A reader sees whole versions only.
    """

    path: str

    def versions(self, spark: SparkSession) -> list[int]:
        return [int(name[:-5]) for name in children(spark, self.path) if name.endswith(".json") and name[:-5].isdigit()]

    def at(self, spark: SparkSession, version: int) -> dict:
        return json.loads(read_text(spark, self._file(version)))

    def newest(self, spark: SparkSession) -> tuple[int, dict | None]:
        """The last version and its content; ``(0, None)`` before the first."""
        found = self.versions(spark)
        return (found[-1], self.at(spark, found[-1])) if found else (0, None)

    def put(self, spark: SparkSession, version: int, content: dict) -> bool:
        """Write ``version``; False if it is there already."""
        staged = f"{self.path}/.{uuid.uuid4().hex}.tmp"
        write_text(spark, staged, json.dumps(content, ensure_ascii=False) + "\n")
        try:
            rename_new(spark, staged, self._file(version))
        except Py4JJavaError as failed:
            remove(spark, staged)
            if "FileAlreadyExistsException" in str(failed.java_exception.getClass().getName()):
                return False
            raise
        return True

    def _file(self, version: int) -> str:
        return f"{self.path}/{version:09d}.json"
