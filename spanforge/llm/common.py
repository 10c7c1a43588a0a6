"""What the operators share: table reading, the shared folder, written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Only where that is unset, and all tasks run on this machine, is one made; on a
    cluster there is no other folder that all executors are sure to see.
    """
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spanforge-"))
        found = sc.getCheckpointDir()
    return found


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/spanforge/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: cuts the lineage and survives lost executors.

    The reader gets the schema, so that an empty table needs no inference.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._spanforge_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete tables made by written() that no lazy result still reads."""
    for df in tables:
        path = getattr(df, "_spanforge_path", None)
        if path:
            jvm_path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            jvm_path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(jvm_path, True)


def free_prefix(*tables: DataFrame) -> str:
    """Underscores with which no column of the tables begins."""
    prefix, taken = "_", [c for df in tables for c in df.columns]
    while any(c.startswith(prefix) for c in taken):
        prefix += "_"
    return prefix


def quoted(name: str) -> str:
    """A column's name for F.col(), whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def running_totals(counts: DataFrame, order: str, value: str, by: str | None = None, chunk: int = 4096) -> DataFrame:
    """counts with `ahead`, the sum of value over the rows of lower order (of the same `by`, null being one), and `of_all`, that over all of them.

    Sums are taken in two levels, within chunks of the order and over chunks, so
    no task sees more than chunk rows or one row for each chunk.  order is a
    whole number from 0, once for each `by`.
    """
    if by is None:
        counts, by = counts.withColumn("_by", F.lit(0)), "_by"
    counts = counts.withColumn("_chunk", F.floor(F.col(order) / chunk))
    totals = counts.groupBy(by, "_chunk").agg(F.sum(value).alias("_sum"))
    earlier = W.partitionBy(by).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(F.col(by).alias("_of"), F.col("_chunk").alias("_at"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"), F.sum("_sum").over(W.partitionBy(by)).alias("of_all"))
    within = W.partitionBy(by, "_chunk").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    rows = counts.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
    rows = rows.join(totals, (F.col("_chunk") == F.col("_at")) & F.col(by).eqNullSafe(F.col("_of")))
    return rows.withColumn("ahead", F.col("_before") + F.col("_within")).drop("_by", "_chunk", "_of", "_at", "_before", "_within")


def crc32(text: Column) -> Column:
    """Unsigned crc32 of the UTF-8 bytes."""
    return F.crc32(text.cast("binary"))


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of few rows and bytes, so that a Python worker holds little of its partition; smaller settings stay."""
    for name, most in (("maxRecordsPerBatch", 1000), ("maxBytesPerBatch", 8 << 20)):
        now = spark.conf.get(f"spark.sql.execution.arrow.{name}").rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(f"spark.sql.execution.arrow.{name}", str(most))


def slices(texts: list[str], max_chars: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about max_chars code points each, so that numpy work stays small; one text is never split."""
    begin, total = 0, 0
    for i, text in enumerate(texts):
        if total and total + len(text) > max_chars:
            yield begin, i
            begin, total = i, 0
        total += len(text)
    if begin < len(texts):
        yield begin, len(texts)
