"""Versions of a table below one folder: written aside, then committed by a small file.

``_commits/0000000007.json`` names the directories that make up version 7. It is put in place
by one rename after all data lie there, so a reader sees the version before or the one after,
and a run that fails leaves the version before. Data directories are never changed. The two
last versions stay, so that whoever reads the older one can finish; what only older ones or
failed runs hold is removed by the next commit. One writer at a time: of two that start from
the same version, the second to commit raises.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

KEPT = 2
COMMITS = "_commits"
PREFIX = "version-"


class ConcurrentCommit(RuntimeError):
    pass


@dataclass(frozen=True)
class Version:
    number: int
    #: What a commit says; ``parts`` are directories, relative to the root of the table.
    content: dict

    @property
    def parts(self) -> list[str]:
        parts = self.content["parts"]
        return list(parts.values() if isinstance(parts, dict) else parts)


class Versions:
    """The commits of the table below ``root``, on any file system that Spark knows."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.root = root.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._to_text = spark._jvm.org.apache.commons.io.IOUtils.toString
        place = self._hadoop.Path(self.root)
        self._files = place.getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, *names: str) -> JavaObject:
        return self._hadoop.Path("/".join([self.root, *names]))

    def children(self, *names: str) -> list[str]:
        """Names of the visible files and folders there; none if it does not exist."""
        place = self.path(*names)
        if not self._files.exists(place):
            return []
        found = (status.getPath().getName() for status in self._files.listStatus(place))
        return sorted(name for name in found if not name.startswith("."))

    def sizes(self) -> dict[str, int]:
        """The visible files directly below the root, with their lengths, by name."""
        place = self._hadoop.Path(self.root)
        found = {s.getPath().getName(): s for s in self._files.listStatus(place)}
        shown = (name for name in sorted(found) if not name.startswith("."))
        return {name: found[name].getLen() for name in shown if found[name].isFile()}

    def commits(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self.children(COMMITS) if n.endswith(".json"))

    def current(self) -> Version | None:
        commits = self.commits()
        return self._read(commits[-1]) if commits else None

    def fresh(self, number: int) -> str:
        """A new directory for the data of version ``number``, relative to the root."""
        return f"{PREFIX}{number:010d}-{uuid.uuid4().hex}"

    def commit(self, number: int, content: dict) -> Version:
        """Make ``content`` the version ``number``, then remove what no kept version needs."""
        aside, final = self.path(COMMITS, f".{uuid.uuid4().hex}"), self.path(COMMITS, f"{number:010d}.json")
        stream = self._files.create(aside, False)
        stream.write(bytearray(json.dumps(content).encode()))
        stream.close()
        if self._files.exists(final) or not self._files.rename(aside, final):
            self._files.delete(aside, False)
            raise ConcurrentCommit(f"version {number} of {self.root} has been committed by another run")
        self._clean()
        return Version(number, content)

    def _read(self, number: int) -> Version:
        stream = self._files.open(self.path(COMMITS, f"{number:010d}.json"))
        try:
            return Version(number, json.loads(self._to_text(stream, "UTF-8")))
        finally:
            stream.close()

    def _clean(self) -> None:
        commits = self.commits()
        needed = {part for number in commits[-KEPT:] for part in self._read(number).parts}
        for directory in self.children():
            if not directory.startswith(PREFIX) or directory in needed:
                continue
            # A run under way may still write the version after the last.
            if int(directory.removeprefix(PREFIX).split("-")[0]) > commits[-1]:
                continue
            inside = [part for part in needed if part.startswith(f"{directory}/")]
            if not inside:
                self._files.delete(self.path(directory), True)
                continue
            for child in self.children(directory):
                if f"{directory}/{child}" not in inside:
                    self._files.delete(self.path(directory, child), True)
        for number in commits[:-KEPT]:
            self._files.delete(self.path(COMMITS, f"{number:010d}.json"), False)
