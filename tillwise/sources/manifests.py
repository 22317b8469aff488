"""Numbered versions of a small JSON document in a folder; a version appears whole or not at all."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import SparkSession


class Manifests:
    """Versions in a folder of whatever store Spark can reach. A reader of the newest one never sees a half-written state."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._paths = spark._jvm.org.apache.hadoop.fs
        self._folder = self._paths.Path(folder)
        self._store = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())
        self.folder = folder

    def _path(self, number: int):
        return self._paths.Path(f"{self.folder}/{number:09d}.json")

    def numbers(self) -> list[int]:
        if not self._store.exists(self._folder):
            return []
        names = [f.getPath().getName() for f in self._store.listStatus(self._folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))

    def read(self, number: int) -> dict:
        stream = self._store.open(self._path(number))
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def newest(self) -> tuple[int, dict] | None:
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else None

    def commit(self, number: int, content: dict) -> bool:
        """Write a version; False if that number is taken."""
        draft = self._paths.Path(f"{self.folder}/.{uuid.uuid4().hex}.draft")
        stream = self._store.create(draft)
        stream.write(bytearray(json.dumps(content).encode()))
        stream.close()
        done = not self._store.exists(self._path(number)) and self._store.rename(draft, self._path(number))
        if not done:
            self._store.delete(draft, False)
        return done

    def age(self, number: int) -> float:
        """Seconds since a version was committed."""
        return time.time() - self._store.getFileStatus(self._path(number)).getModificationTime() / 1000

    def forget(self, number: int) -> None:
        self._store.delete(self._path(number), False)

    def folders(self, parent: str) -> list[tuple[str, float]]:
        """The folders in a folder, and the seconds since each was changed."""
        top = self._paths.Path(parent)
        if not self._store.exists(top):
            return []
        found = [f for f in self._store.listStatus(top) if f.isDirectory()]
        return [(f"{parent}/{f.getPath().getName()}", time.time() - f.getModificationTime() / 1000) for f in found]

    def remove(self, path: str) -> None:
        self._store.delete(self._paths.Path(path), True)
