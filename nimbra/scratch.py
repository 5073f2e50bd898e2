"""Working folders on storage that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A local-mode session without that setting gets a temporary folder of its
    own; on a cluster the setting is required, as a machine-local folder would
    be lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    root = tempfile.mkdtemp(prefix="nimbra-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
