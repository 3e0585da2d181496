"""Versioned tables: data folders that never change, and a manifest that is switched last.

A version is a small JSON file that names the folders of its data. A writer puts
new folders beside the old ones and renames the finished manifest into place, so
readers see the version before or after, and a writer that fails leaves nothing
but folders that no manifest names (``vacuum`` removes them). Two writers that
start from the same version can't both finish: the later one fails.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession


@dataclass
class Manifest:
    """``folders``: folder by name, relative to the table; ``info``: what the table keeps beside them."""
    version: int = 0
    folders: dict[str, str] = field(default_factory=dict)
    info: dict = field(default_factory=dict)


class Versions:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _names(self, folder: str) -> list[str]:
        at = self._at(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def _text(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def current(self) -> Manifest:
        """The last finished version; version 0 without folders if there is none."""
        done = [int(n[:-5]) for n in self._names("manifest") if n.endswith(".json") and n[:-5].isdigit()]
        if not done:
            return Manifest()
        return Manifest(**json.loads(self._text(f"manifest/{max(done)}.json")))

    def new_folder(self) -> str:
        """A name for data of the next version, relative to the table."""
        return f"data/{uuid.uuid4().hex}"

    def full(self, folder: str) -> str:
        return f"{self.path}/{folder}"

    def exists(self, folder: str) -> bool:
        return self._fs.exists(self._at(folder))

    def commit(self, after: Manifest, folders: dict[str, str], info: dict) -> Manifest:
        """Make the version that follows ``after`` the current one."""
        new = Manifest(after.version + 1, folders, info)
        target = self._at(f"manifest/{new.version}.json")
        draft = self._at(f"manifest/.{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(new.__dict__).encode()))
        finally:
            stream.close()
        if self._fs.exists(target) or not self._fs.rename(draft, target):
            self._fs.delete(draft, False)
            raise RuntimeError(f"version {new.version} of {self.path} was written by someone else")
        return new

    def vacuum(self) -> int:
        """Remove data that the current version does not name, and older manifests; returns the number of folders removed.
        Not while others read older versions."""
        now = self.current()
        kept = {f.split("/")[1] for f in now.folders.values()}
        gone = [n for n in self._names("data") if n not in kept]
        for n in gone:
            self._fs.delete(self._at(f"data/{n}"), True)
        for n in self._names("manifest"):
            if n != f"{now.version}.json":
                self._fs.delete(self._at(f"manifest/{n}"), False)
        return len(gone)
