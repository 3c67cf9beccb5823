"""Small files that a driver keeps beside a table: created once, or replaced whole.

``create`` is the one thing that writers of a log agree on: of several that create the same file one succeeds, and
the file is complete when it is there.  On a store of Hadoop's that is a rename onto a name that must be free, on a local
or mounted folder a hard link.
"""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folder:
    """Files below ``root``, by relative name."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark._jvm, root.rstrip("/")
        self.conf = spark._jsc.hadoopConfiguration()
        self.store = self._at("").getFileSystem(self.conf)
        self.mounted = self.store.getScheme() == "file"

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _local(self, name: str) -> str:
        base = f"/{self.root[5:].lstrip('/')}" if self.root.startswith("file:") else self.root
        return f"{base}/{name}"

    def read(self, name: str) -> str | None:
        if self.mounted:
            try:
                with open(self._local(name), encoding="utf-8") as f:
                    return f.read()
            except FileNotFoundError:
                return None
        try:
            stream = self.store.open(self._at(name))
        except Py4JJavaError as e:
            if "FileNotFoundException" not in e.java_exception.getClass().getName():
                raise
            return None
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def exists(self, name: str) -> bool:
        return os.path.exists(self._local(name)) if self.mounted else self.store.exists(self._at(name))

    def written_at(self, name: str) -> int:
        """Milliseconds; 0 for a file that is not there."""
        if not self.exists(name):
            return 0
        return os.stat(self._local(name)).st_mtime_ns // 1_000_000 if self.mounted else self.store.getFileStatus(self._at(name)).getModificationTime()

    def names(self, name: str) -> list[str]:
        """Names of the files in one folder; none if it is not there."""
        if not self.exists(name):
            return []
        if self.mounted:
            return sorted(n for n in os.listdir(self._local(name)) if not n.startswith("."))
        return sorted(s.getPath().getName() for s in self.store.listStatus(self._at(name)) if not s.getPath().getName().startswith("."))

    def create(self, name: str, text: str, after: int = 0) -> bool:
        """Whether this call made the file.  It is dated later than ``after`` (milliseconds)."""
        if self.exists(name):
            return False
        part = f"{os.path.dirname(name)}/.{uuid.uuid4().hex}"
        self._write(part, text)
        if self.mounted:
            here, there = self._local(part), self._local(name)
            if os.stat(here).st_mtime_ns // 1_000_000 <= after:
                os.utime(here, ns=((after + 1) * 1_000_000,) * 2)
            try:
                os.link(here, there)
            except FileExistsError:
                return False
            finally:
                os.unlink(here)
            return True
        if self.store.getFileStatus(self._at(part)).getModificationTime() <= after:
            self.store.setTimes(self._at(part), after + 1, -1)
        try:
            made = self.store.rename(self._at(part), self._at(name))
        except Py4JJavaError as e:
            if "AlreadyExists" not in e.java_exception.getClass().getName():
                raise
            made = False
        if not made:
            self.store.delete(self._at(part), False)
        return made

    def replace(self, name: str, text: str) -> None:
        """One writer per file."""
        if not self.mounted:
            self._write(name, text)
            return
        part = f"{os.path.dirname(name)}/.{uuid.uuid4().hex}"
        self._write(part, text)
        os.replace(self._local(part), self._local(name))

    def remove(self, name: str) -> None:
        """A file or a whole folder."""
        self.store.delete(self._at(name), True)

    def _write(self, name: str, text: str) -> None:
        if self.mounted:
            os.makedirs(os.path.dirname(self._local(name)), exist_ok=True)
            with open(self._local(name), "w", encoding="utf-8") as f:
                f.write(text)
            return
        out = self.store.create(self._at(name), True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
