"""Shared folders for intermediate tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def work_folder(spark: SparkSession, folder: str | None = None) -> str:
    """Folder for staged tables: the given one, or the session's shared one."""
    chosen = folder or spark.conf.get(CHECKPOINT_DIR, None)
    if not chosen:
        raise ValueError(f"give a shared work folder or set {CHECKPOINT_DIR}")
    return chosen.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """The table from a reliable checkpoint in the session's shared folder.

    Only a local session without such a folder gets one of its own.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get(CHECKPOINT_DIR, None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint()
