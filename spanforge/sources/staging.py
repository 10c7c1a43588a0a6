"""Intermediate tables between steps of a flow.

A step that several later ones read is written once to the folder that driver
and executors share (spark.checkpoint.dir): it is not computed again, its plan
does not grow into theirs, and a lost executor costs nothing that was written.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def staged(df: DataFrame, name: str) -> DataFrame:
    sc = df.sparkSession.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spanforge-"))
        folder = sc.getCheckpointDir()
    path = f"{folder.rstrip('/')}/spanforge/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._spanforge_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete tables made by staged() that no result still reads."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._spanforge_path)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
