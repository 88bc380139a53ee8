"""Shared scratch folders for tables that are written and read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path that every executor can reach.

    The cluster names the shared folder in ``spark.checkpoint.dir``. Only a local
    session without that setting, as in tests, falls back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="lendmill-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
