"""A place for intermediate files that every executor can reach."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, name: str, base: str | None = None) -> str:
    """A new folder name under ``base`` or else the cluster's shared ``spark.checkpoint.dir``.

    A session in one process that names none, as in tests, gets a temporary folder. On a cluster a
    machine's own folder would be out of reach for the other machines, so the setting is
    required there.
    """
    base = base or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        base = tempfile.mkdtemp(prefix="salesmill-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
