"""Reliable checkpoints in the folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use ``spark.checkpoint.dir``. Only a local session without it gets a folder of its
    own; on a cluster a missing setting is an error, as no local folder is shared."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="wattframe-checkpoint-")
    context.setCheckpointDir(shared)


def cut_lineage(rows: DataFrame) -> DataFrame:
    """``rows`` computed once and stored reliably; a lost executor does not recompute it."""
    ensure_checkpoint_dir(rows.sparkSession)
    return rows.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the checkpoint folder, for tables that live as long as a job."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/tables-{uuid.uuid4().hex}"
