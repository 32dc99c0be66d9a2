"""A stored ledger of datasets, in whole versions.

A version is a folder of its own and a small file that names it; the file is made last and never
changed. Readers take the highest number, so during an update they see the version before it as a whole.
A writer claims the next number of the version it read; if someone else has it, nothing is changed and
the writer is told. The claim is as atomic as the file system's creation of a file that must not exist.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from tablevet.operators.catalog import apply_status


class VersionTaken(RuntimeError):
    """Another writer made this version first."""


@dataclass(frozen=True)
class Ledger:
    spark: SparkSession
    path: str

    def _hadoop(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path.rstrip('/')}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def versions(self) -> list[int]:
        """Numbers of the committed versions, ascending from 1."""
        files, path = self._hadoop("versions")
        if not files.exists(path):
            return []
        return sorted(int(f.getPath().getName()) for f in files.listStatus(path) if f.getPath().getName().isdigit())

    def folder(self, version: int) -> str:
        files, path = self._hadoop(f"versions/{version}")
        stream = files.open(path)
        try:
            name = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return f"{self.path.rstrip('/')}/{name}"

    def read(self, version: int | None = None) -> DataFrame:
        """One version, the newest unless told."""
        numbers = self.versions()
        if not numbers:
            raise LookupError(f"no ledger at {self.path}")
        return self.spark.read.parquet(self.folder(version or numbers[-1]))

    def commit(self, rows: DataFrame, after: int) -> int:
        """Make ``rows`` the version behind ``after`` (0: the first one)."""
        folder = f"data/{after + 1}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path.rstrip('/')}/{folder}")
        files, path = self._hadoop(f"versions/{after + 1}")
        try:
            stream = files.create(path, False)
        except Py4JJavaError as error:
            if files.exists(path):
                raise VersionTaken(f"version {after + 1} of {self.path} was made by another writer") from error
            raise
        stream.write(bytearray(folder.encode()))
        stream.close()
        return after + 1

    def update_status(self, outcomes: DataFrame) -> int:
        """Write back the status of each dataset in ``outcomes``; the others keep theirs."""
        newest = (self.versions() or [0])[-1]
        return self.commit(apply_status(self.read(newest), outcomes), newest)
