"""Lineage cuts that survive executor loss.

``checkpoint()`` writes to the shared folder named by ``spark.checkpoint.dir``
(reliable, unlike ``localCheckpoint``). Without a prior ``persist`` the plan
would run twice (once for the action, once for the write), so the frame is
persisted for the duration of the checkpoint and released afterwards.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from leakscope.session import scratch_path


def materialize(df: DataFrame) -> DataFrame:
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()


def as_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back. Unlike a checkpoint,
    Spark knows the size of the files, so a join broadcasts a small table and
    shuffles a large one by Spark's own threshold."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
