"""Reading the text tables, samples of stated size and lineage cuts for the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.session import materialise, run_dir


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage: written once to the shared folder, readable after executors are lost."""
    return materialise(df)


def stored(df: DataFrame) -> DataFrame:
    """Cuts the lineage by a table in the shared folder. Many small parts are read back by few tasks."""
    path = run_dir(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the column as text, modulo `divisor`."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def labelled(labels: DataFrame, label: str, limit: int, train: Column, per_class: bool = False) -> DataFrame:
    """At most `limit` labelled ids `(doc_id, y)`, those first by hash of the id; `per_class`: so many of either class.

    Null ids and labels are left out and repeated rows count once (the larger label wins). The limit bounds
    the result, so it can be broadcast.
    """
    rows = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & train)
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("y"))
    )
    first = [F.xxhash64("doc_id"), F.col("doc_id")]
    if not per_class:
        return rows.orderBy(*first).limit(limit)
    ones, zeros = (rows.where(F.col("y") == y).orderBy(*first).limit(limit) for y in (1, 0))
    return ones.unionByName(zeros)


def training_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """`(doc_id, text, y)` of the sampled ids, dealt evenly over tasks (long texts may lie side by side)."""
    tasks = docs.sparkSession.sparkContext.defaultParallelism
    return docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").repartition(tasks)
