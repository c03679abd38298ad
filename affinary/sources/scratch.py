"""Intermediate tables, written to the folder all executors share."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Stage = Callable[[DataFrame, str], DataFrame]

_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a session that runs in one process may go without the setting; it gets a folder of
    its own that is removed when the process ends.  On a cluster a folder of one machine
    would be lost with that machine, so there the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _own_folders:
        folder = tempfile.mkdtemp(prefix="affinary-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _own_folders[context.applicationId] = folder
    return _own_folders[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table that later steps read several times, and read it back.

    The copy survives lost executors, cuts the lineage, and gives the planner a
    true size to choose joins by.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
