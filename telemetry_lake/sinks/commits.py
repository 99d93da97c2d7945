"""A log of commits: numbered entries, each of which appears whole or not at all.

An entry is a small JSON document, written under a name that readers ignore and then renamed to its
number. The rename fails where the number is taken, so of two writers that read the same log one
commits and the other learns that it must look again. The log needs a file system whose rename is atomic
and does not replace a file.

Data belongs to a commit by being named in its entry. Whatever lies in the lake without an entry is
debris of a run that ended early.
"""

from __future__ import annotations

import json
import re
import uuid
from typing import NamedTuple

from pyspark import SparkContext
from pyspark.sql import SparkSession


class Commit(NamedTuple):
    number: int
    entry: dict
    #: Whether all that follows from the entry was carried out.
    done: bool


class Files:
    """The folder operations a commit needs, on the file system of a path."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str = "") -> bool:
        return self.fs.exists(self.path(name))

    def names(self, name: str = "", folders: bool | None = None) -> list[str]:
        """Names in a folder, in order; none if it does not exist. ``folders`` picks folders or files."""
        if not self.exists(name):
            return []
        found = self.fs.listStatus(self.path(name))
        return sorted(x.getPath().getName() for x in found if folders is None or x.isDirectory() == folders)

    def size(self, name: str = "") -> int:
        """Bytes of all files below a folder."""
        return self.fs.getContentSummary(self.path(name)).getLength()

    def make(self, name: str = "") -> None:
        self.fs.mkdirs(self.path(name))

    def remove(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def write(self, name: str, text: str) -> None:
        out = self.fs.create(self.path(name), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, name: str) -> str:
        size = self.fs.getFileStatus(self.path(name)).getLen()
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readNBytes(size)).decode()
        finally:
            stream.close()

    def rename(self, old: str, new: str) -> bool:
        """Rename within the root; False where the new name is taken or the old one is gone."""
        fs = self.jvm.org.apache.hadoop.fs
        no_flags = SparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
        context = fs.FileContext.getFileContext(self.path("").toUri(), self.conf)
        try:
            context.rename(self.path(old), self.path(new), no_flags)
        except Exception as error:
            if re.search("FileAlreadyExists|FileNotFound|NotEmpty", str(error)):
                return False
            raise
        return True


class CommitLog:
    """Commits below a folder: ``<number>.json``, and ``<number>.done`` beside it once it was carried out."""

    def __init__(self, spark: SparkSession, path: str):
        self.files = Files(spark, path)

    def last(self) -> int:
        """Number of the newest commit, 0 if there is none."""
        return max((int(n[:-5]) for n in self.files.names() if re.fullmatch(r"\d+\.json", n)), default=0)

    def read(self, number: int) -> dict:
        return json.loads(self.files.read(f"{number:08d}.json"))

    def commits(self, since: int = 0) -> list[Commit]:
        """Commits with a number above ``since``, in order."""
        names = set(self.files.names())
        numbers = sorted(int(n[:-5]) for n in names if re.fullmatch(r"\d+\.json", n))
        return [Commit(k, json.loads(self.files.read(f"{k:08d}.json")), f"{k:08d}.done" in names) for k in numbers if k > since]

    def open(self) -> list[Commit]:
        """Commits that were not carried out yet; their entries only are read."""
        names = set(self.files.names())
        numbers = sorted(int(n[:-5]) for n in names if re.fullmatch(r"\d+\.json", n) and f"{n[:-5]}.done" not in names)
        return [Commit(k, json.loads(self.files.read(f"{k:08d}.json")), False) for k in numbers]

    def commit(self, number: int, entry: dict) -> bool:
        """Commit ``entry`` as ``number``; False if there is a commit of that number already."""
        self.files.make()
        draft = f"_{uuid.uuid4().hex}"
        self.files.write(draft, json.dumps(entry))
        if self.files.rename(draft, f"{number:08d}.json"):
            return True
        self.files.remove(draft)
        return False

    def finish(self, number: int) -> None:
        self.files.write(f"{number:08d}.done", "")
