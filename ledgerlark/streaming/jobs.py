"""Structured Streaming forms of drift monitoring, A/B recording, scoring and timings.

Sources are file streams; state is bounded by watermarks. Update-mode results go to a Parquet table,
one folder per micro-batch that a retry overwrites, and the newest row per key is the current result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from ledgerlark.functions.clock import as_utc
from ledgerlark.operators.drift import PSI_FLOOR, PSI_LIMIT
from ledgerlark.operators.models import score
from ledgerlark.operators.oplog import audit_rows, timing_rollup
from ledgerlark.operators.ordered import small_side
from ledgerlark.operators.profile import bin_of, bin_ranges


def table_stream(spark: SparkSession, folder: str, name: str, ts: str | None = None) -> DataFrame:
    """The given table as a file stream; its zone-free event time `ts` becomes an instant."""
    file = f"{name}.parquet"
    schema = spark.read.parquet(f"{folder}/{file}").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", file).parquet(folder)
    return stream.withColumn(ts, as_utc(ts)) if ts else stream


def run_updates(stream: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Run an update-mode aggregation over all input that is new since the last run with this path; the newest row per key."""
    spark = stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/table/batch={batch_id}")

    started = (
        stream.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).start()
    )
    started.awaitTermination()
    stored = spark.read.schema(StructType([*stream.schema.fields, StructField("batch", LongType())])).parquet(f"{path}/table")
    rest = [c for c in stream.columns if c not in keys]
    newest = stored.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("r"))
    return newest.select(*keys, "r.*")


def run_append(stream: DataFrame, path: str) -> DataFrame:
    """Run an append-mode stream over all available input into the table `<path>/table`, each file exactly once."""
    started = (
        stream.writeStream.outputMode("append").format("parquet")
        .option("path", f"{path}/table").option("checkpointLocation", f"{path}/progress")
        .trigger(availableNow=True).start()
    )
    started.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/table")


def reference_bins(reference: DataFrame, keys: Sequence[str], value: str, bins: int = 10) -> DataFrame:
    """`(keys..., start, stop, width, bin, p_ref)` of a static reference, every bin present; ten rows per key."""
    ranges = small_side(bin_ranges(reference, keys, bins, value))
    binned = reference.join(ranges, list(keys)).groupBy(*keys, bin_of(value, bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    grid = ranges.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    filled = grid.join(binned, [*keys, "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    share = F.col("n") / F.sum("n").over(Window.partitionBy(*keys))
    return filled.select(*keys, "start", "stop", "width", "bin", share.alias("p_ref"))


def drift_bin_counts(
    stream: DataFrame, ranges: DataFrame, keys: Sequence[str], value: str, ts: str = "ts", every: str = "1 day",
    late: str = "2 days", bins: int = 10,
) -> DataFrame:
    """Counts per window, key and bin; values outside the reference range count in bin -1.

    `ranges` is `(keys..., start, stop, width)`, one row per key.
    """
    joined = stream.withWatermark(ts, late).join(small_side(ranges), list(keys))
    at = F.coalesce(bin_of(value, bins), F.lit(-1))
    return joined.groupBy(F.window(ts, every).alias("w"), *keys, at.alias("bin")).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("w.start").alias("window_start"), *keys, "bin", "n"
    )


def drift_verdicts(counts: DataFrame, reference: DataFrame, keys: Sequence[str]) -> DataFrame:
    """PSI per window and key from finished counts; works on a table of counts, batch or streamed."""
    by = ["window_start", *keys]
    sizes = counts.groupBy(*by).agg(F.sum("n").alias("size"))
    grid = sizes.join(reference.select(*keys, "bin", "p_ref"), list(keys))
    filled = grid.join(counts, [*by, "bin"], "left")
    p = F.when(F.col("p_ref") == 0, PSI_FLOOR).otherwise(F.col("p_ref"))
    share = F.coalesce(F.col("n"), F.lit(0)) / F.col("size")
    q = F.when(share == 0, PSI_FLOOR).otherwise(share)
    return filled.groupBy(*by, "size").agg(F.sum((q - p) * F.ln(q / p)).alias("psi")).withColumn(
        "drift_detected", F.col("psi") > PSI_LIMIT
    )


def matched_events(predictions: DataFrame, actuals: DataFrame, late: str = "2 days", within: str = "1 hour") -> DataFrame:
    """Predictions, once each, joined with the outcome that follows within the given time."""
    once = predictions.withWatermark("ts", late).dropDuplicatesWithinWatermark(["experiment_id", "unit_id"])
    outcome = actuals.withWatermark("actual_ts", late).withColumnRenamed("unit_id", "actual_unit")
    in_time = F.expr(f"actual_ts >= ts AND actual_ts <= ts + INTERVAL {within}")
    return once.join(outcome, (F.col("unit_id") == F.col("actual_unit")) & in_time).drop("actual_unit")


def variant_windows(pairs: DataFrame, every: str = "1 day", late: str = "2 days") -> DataFrame:
    """Events and hits per window, experiment and variant."""
    hit = (F.col("prediction") == F.col("actual")).cast("int")
    grouped = pairs.withWatermark("ts", late).groupBy(F.window("ts", every).alias("w"), "experiment_id", "variant")
    return grouped.agg(F.count(F.lit(1)).alias("n"), F.sum(hit).alias("correct")).select(
        F.col("w.start").alias("window_start"), "experiment_id", "variant", "n", "correct"
    )


def timing_windows(log: DataFrame, ts: str = "timestamp", length: str = "1 day", slide: str = "12 hours", late: str = "2 days") -> DataFrame:
    """Timings per operation over sliding windows."""
    rolled = timing_rollup(log.withWatermark(ts, late), [F.window(ts, length, slide).alias("w"), "operation"])
    return rolled.select(F.col("w.start").alias("window_start"), *[c for c in rolled.columns if c != "w"])


def scored_stream(stream: DataFrame, model: Model, inputs: Sequence[str], name: str, at: Column, keep: Sequence[str]) -> DataFrame:
    """Scores with audit fields; no state, so it runs at the rate of the source."""
    return audit_rows(score(model, stream, [*keep, *inputs]), inputs, name, at, keep)
