"""A folder of Markdown issues as a stream: each new file is labelled and appended.

Labelling works row by row.  Each micro-batch is written as a folder of its own.
Files are read whole, so no document is split between batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spanforge.operators.labels import label


def watch(spark: SparkSession, inbox: str, out: str, checkpoint: str, files_at_once: int = 1000) -> StreamingQuery:
    """Spans of the files in inbox (doc_id is the path), appended to Parquet in out; each batch has a folder of its own, so a batch that runs again replaces itself."""
    files = spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", files_at_once).load(inbox)
    docs = files.select(F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("text"))

    def write(batch: DataFrame, number: int) -> None:
        label(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
