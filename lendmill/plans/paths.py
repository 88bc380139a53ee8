"""Checks on job paths, made before any work starts."""

from __future__ import annotations

import os
import posixpath
from collections.abc import Collection
from urllib.parse import urlparse

from pyspark.sql import SparkSession


def check_path(label: str, path: str | None, schemes: Collection[str] | None = None) -> str:
    """The path without a trailing slash; ``ValueError`` if empty or of a foreign scheme."""
    if not path:
        raise ValueError(f"{label} is missing")
    if schemes is not None and urlparse(path).scheme not in schemes:
        raise ValueError(f"{label} must start with one of {sorted(schemes)}, got {path}")
    return path.rstrip("/") or path


def check_apart(spark: SparkSession, **paths: str | None) -> None:
    """``ValueError`` if two paths are equal or one lies below the other, however they are
    spelt: a job must not overwrite what it reads or what else it writes.

    Name every path that the job reads or writes; ``None`` stands for one it does without.
    """
    places = {label: _qualified(spark, path) for label, path in paths.items() if path is not None}
    labels = list(places)
    for i, one in enumerate(labels):
        for other in labels[i + 1 :]:
            a, b = f"{places[one]}/", f"{places[other]}/"
            if a.startswith(b) or b.startswith(a):
                raise ValueError(
                    f"{one} and {other} are the same path or nested: {paths[one]}, {paths[other]}"
                )


def _qualified(spark: SparkSession, path: str) -> str:
    """The path as its file system names it, with scheme and without dots; links on a
    local file system are followed."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    whole = urlparse(files.makeQualified(place).toString())
    name = posixpath.normpath(whole.path)
    if whole.scheme == "file":
        name = os.path.realpath(name)
    return f"{whole.scheme}://{whole.netloc}{name}".rstrip("/")
