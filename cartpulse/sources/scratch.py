"""Folders for checkpoints and intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors reach.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset (as in
    tests) the warehouse is taken, never a folder of one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder every executor can reach."""
    return f"{shared_folder(spark)}/cartpulse-{purpose}-{uuid.uuid4().hex}"
