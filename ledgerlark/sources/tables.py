"""Scans and sinks: Parquet, CSV, JSON documents, JSON lines, feature matrices and snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def nan_to_null(df: DataFrame) -> DataFrame:
    """One kind of missing value: floating columns get NULL for NaN."""
    floating = {
        f.name: F.when(~F.isnan(f.name), F.col(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, (DoubleType, FloatType))
    }
    return df.withColumns(floating) if floating else df


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with header; an explicit schema saves the inference pass."""
    return nan_to_null(spark.read.schema(schema).option("header", True).csv(path))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_matrix(df: DataFrame, path: str, id_column: str, features: Sequence[str], label: str | None = None) -> None:
    """Feature matrix as `(id, features array<double>, label, names array<string>)`, names kept beside the values."""
    out = df.select(
        id_column,
        F.array(*[F.col(f).cast("double") for f in features]).alias("features"),
        *([F.col(label).alias("label")] if label else []),
        F.array(*[F.lit(f) for f in features]).alias("names"),
    )
    out.write.mode("overwrite").parquet(path)


def read_matrix(spark: SparkSession, path: str, features: Sequence[str]) -> DataFrame:
    """Named columns again, found by name rather than position."""
    stored = spark.read.parquet(path)
    by_name = F.map_from_arrays("names", "features")
    others = [c for c in stored.columns if c not in ("features", "names")]
    return stored.select(*others, *[F.try_element_at(by_name, F.lit(f)).alias(f) for f in features])


def append_snapshot(df: DataFrame, path: str, run_ts: str) -> None:
    """One partition per run; a rerun of the same stamp replaces its own partition only."""
    (
        df.withColumn("run_ts", F.lit(run_ts))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_ts")
        .parquet(path)
    )


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_json_documents(spark: SparkSession, glob: str, schema: StructType | str) -> DataFrame:
    """One document per file, with the file it came from."""
    read = spark.read.schema(schema).option("multiLine", True).json(glob)
    return read.withColumn("modified_at", F.col("_metadata.file_modification_time"))


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


PERF_LOG = "timestamp timestamp, component string, operation string, duration_seconds double, performance_type string"
METRIC_LOG = "timestamp timestamp, component string, metric_name string, metric_value double, metric_unit string"
AUDIT_LOG = (
    "timestamp timestamp, audit_type string, action string, operation string, table_name string, "
    "record_count bigint, model_name string, input_hash string, prediction string, confidence double"
)
