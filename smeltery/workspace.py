"""Where jobs that write keep their files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


#: Temporary folders of local sessions, by application.
_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can see, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine,
    one per application.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _local_roots:
        _local_roots[application] = tempfile.mkdtemp(prefix="smeltery-")
    return _local_roots[application]


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a fresh folder below the shared root; it is created by the first write."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
