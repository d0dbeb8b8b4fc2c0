"""Roll-ups of operational tables: deployments, timings, metric logs, prediction audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Statuses counted as unhealthy.
UNHEALTHY = ["unhealthy", "failed"]


def deployment_rollup(deployments: DataFrame) -> DataFrame:
    """`(section, key, total, healthy, unhealthy)` per environment and per status, from one grouping."""
    keys = F.array(
        *[F.struct(F.lit(name).alias("section"), F.col(name).alias("key")) for name in ("environment", "status")]
    )
    status = F.col("status")
    return (
        deployments.select(F.explode(keys).alias("k"), status)
        .groupBy("k.section", "k.key")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.sum((status == "healthy").cast("int")).alias("healthy"),
            F.sum(status.isin(UNHEALTHY).cast("int")).alias("unhealthy"),
        )
    )


def timing_rollup(log: DataFrame, by: Sequence[str | Column] = ("operation",)) -> DataFrame:
    """Count, total, mean, minimum and maximum duration per operation."""
    d = F.col("duration_seconds")
    return log.groupBy(*by).agg(
        F.count(d).alias("count"), F.sum(d).alias("total_time"), F.avg(d).alias("avg_time"),
        F.min(d).alias("min_time"), F.max(d).alias("max_time"),
    )


def input_hash(columns: Sequence[str]) -> Column:
    """Hash of the named inputs in sorted order, equal in every run."""
    return F.sha2(F.to_json(F.struct(*sorted(columns))), 256)


def audit_rows(scored: DataFrame, inputs: Sequence[str], model: str, at: Column, keep: Sequence[str] = ()) -> DataFrame:
    """Audit record per scored row."""
    return scored.select(
        *keep,
        at.alias("timestamp"),
        F.lit("model_decision").alias("audit_type"),
        F.lit(model).alias("model_name"),
        input_hash(inputs).alias("input_hash"),
        F.col("prediction").cast("string").alias("prediction"),
        "confidence",
    )
