"""Running sums, row indexes and exact order statistics without a single-task window.

Every function here first reduces rows to distinct values where it can (map-side combine, so a hot
value costs one row per task), then range-partitions by (keys, order). A hot key is therefore spread
over as many range blocks as it needs. Per-block totals give each block its starting offset.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from ledgerlark.session import materialise

BLOCK = "__block"
BROADCAST_BYTES = 8 << 20
BRACKET_ACCURACY = 5_000  # of the sketches that bracket exact quantiles


def present(column: str | Column) -> Column:
    """Neither NULL nor NaN."""
    c = F.col(column) if isinstance(column, str) else column
    return c.isNotNull() & ~F.isnan(c)


def melt(
    df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), name: str = "feature", drop_missing: bool = True
) -> DataFrame:
    """Wide to long `(keep..., feature, value)`; missing values are dropped, or kept as NULL."""
    numeric = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    long = numeric.unpivot(list(keep), list(columns), name, "value")
    if drop_missing:
        return long.where(present("value"))
    return long.withColumn("value", F.when(~F.isnan("value"), F.col("value")))


def small_side(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Written once and measured: broadcast if its values, as text, are within the limit, else left for Spark to shuffle."""
    stored = materialise(df)
    size = stored.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(stored) if size <= limit else stored


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Join condition under which missing keys equal each other."""
    return reduce(Column.__and__, [left[k].eqNullSafe(right[k]) for k in keys])


def _running_sums(keys: Sequence[str], measures: Sequence[str]):
    """For `mapInArrow` over sorted partitions: sums over earlier rows of the same key in the partition.

    Works batch by batch and remembers the last key only, so memory does not grow with the partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, last = None, dict.fromkeys(measures, 0)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            starts = np.zeros(batch.num_rows, dtype=bool)
            starts[0] = True
            for key in keys:
                codes = batch.column(key).dictionary_encode(null_encoding="encode").indices.to_numpy()
                starts[1:] |= codes[1:] != codes[:-1]
            group = np.cumsum(starts) - 1
            first_key = tuple(batch.column(k)[0].as_py() for k in keys)
            added = []
            for m in measures:
                values = batch.column(m).to_numpy(zero_copy_only=False)
                before = np.cumsum(values) - values
                before = before - before[starts][group]
                if first_key == last_key:
                    before[group == 0] += last[m]
                last[m] = before[-1] + values[-1]
                added.append(pa.array(before))
            last_key = tuple(batch.column(k)[-1].as_py() for k in keys)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *added], names=[*batch.schema.names, *[f"__{m}_local" for m in measures]]
            )

    return run


def prefix_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Add `<m>_before` (sum over earlier rows of the key) and `<m>_total` for each integer measure `m`.

    `(keys, order)` must identify a row, otherwise the order of equal rows is undefined. The rows are
    shuffled and sorted once; the result is a scan of the written blocks joined with their offsets, so
    several consumers can read it without sorting again.
    """
    ready = df.withColumns({m: F.col(m).cast("long") for m in measures}).withColumn(BLOCK, F.lit(0))
    local = StructType(
        [*ready.schema.fields, *[StructField(f"__{m}_local", LongType()) for m in measures]]
    )
    blocks = materialise(
        ready.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn(BLOCK, F.spark_partition_id())
        .mapInArrow(_running_sums(keys, measures), local)
    )
    sums = blocks.groupBy(*keys, BLOCK).agg(*[F.sum(m).alias(f"__{m}") for m in measures])
    # a block holds a contiguous range of keys, so there are at most (keys + blocks) of these rows
    across = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    earlier = across.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *keys,
        BLOCK,
        *[F.coalesce(F.sum(f"__{m}").over(earlier), F.lit(0)).alias(f"__{m}_offset") for m in measures],
        *[F.sum(f"__{m}").over(across).alias(f"{m}_total") for m in measures],
    )
    offsets = small_side(offsets)
    return blocks.join(offsets, same_keys(blocks, offsets, [*keys, BLOCK])).select(
        *[blocks[c] for c in df.columns],
        *[(F.col(f"__{m}_offset") + F.col(f"__{m}_local")).alias(f"{m}_before") for m in measures],
        *[f"{m}_total" for m in measures],
    )


def row_index(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "row_index") -> DataFrame:
    """0-based position of each row in its key, and the key's row count as `<name>_total`."""
    indexed = prefix_sum(df.withColumn(name, F.lit(1).cast("long")), keys, order, [name])
    return indexed.drop(name).withColumnRenamed(f"{name}_before", name)


def value_counts(values: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Distinct values with their count `n`; the input of all order statistics."""
    return values.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def quantiles_of_ranked(ranked: DataFrame, keys: Sequence[str], probs: Sequence[float], n: str = "n") -> DataFrame:
    """Exact quantiles with linear interpolation, `(keys..., p, quantile)`, from counts with their running sums."""
    total = F.col(f"{n}_total") - 1
    first, last = F.col(f"{n}_before"), F.col(f"{n}_before") + F.col(n) - 1
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    spot = F.col("p") * total
    hits = ranked.where(F.col(n) > 0).withColumn(
        "p", F.explode(F.filter(wanted, lambda p: (F.ceil(p * total) >= first) & (F.floor(p * total) <= last)))
    )
    low = F.max(F.when((F.floor(spot) >= first) & (F.floor(spot) <= last), F.col("value")))
    high = F.max(F.when((F.ceil(spot) >= first) & (F.ceil(spot) <= last), F.col("value")))
    frac = F.max(spot - F.floor(spot))
    return (
        hits.groupBy(*keys, "p")
        .agg(low.alias("lo"), high.alias("hi"), frac.alias("frac"))
        .select(*keys, "p", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("frac")).alias("quantile"))
    )


def quantiles_of_counts(counts: DataFrame, keys: Sequence[str], probs: Sequence[float], n: str = "n") -> DataFrame:
    """Exact quantiles of value counts."""
    present_counts = counts.where((F.col(n) > 0) & F.col("value").isNotNull()).select(*keys, "value", n)
    return quantiles_of_ranked(prefix_sum(present_counts, keys, ["value"], [n]), keys, probs, n)


def bracketed_quantiles(long: DataFrame, keys: Sequence[str], probs: Sequence[float], accuracy: int = BRACKET_ACCURACY) -> DataFrame:
    """Exact quantiles without a shuffle of the values, `(keys..., p, quantile)`.

    Mergeable sketches bracket each wanted rank; their rank error is at most 1 / accuracy and the bracket is five
    times as wide on either side. A second pass counts what lies below a bracket, one number per task, and only
    values inside, about 10 / accuracy of them, are ranked; of up to `accuracy` values all are. A rank outside its
    bracket would be an error.
    """
    margin = 5 / accuracy
    edges = [max(p - margin, 0.0) for p in probs] + [min(p + margin, 1.0) for p in probs] + [0.0, 1.0]
    sketch = long.groupBy(*keys).agg(F.count("value").alias("__rows"), F.percentile_approx("value", edges, accuracy).alias("__edges"))
    edge = lambda at, end: F.when(F.col("__rows") > accuracy, F.col("__edges")[at]).otherwise(F.col("__edges")[2 * len(probs) + end])
    brackets = F.array(
        *[F.struct(F.lit(float(p)).alias("p"), edge(i, 0).alias("__low"), edge(len(probs) + i, 1).alias("__high")) for i, p in enumerate(probs)]
    )
    renamed = {k: f"__key_{i}" for i, k in enumerate(keys)}
    places = small_side(sketch.select(*[F.col(k).alias(n) for k, n in renamed.items()], "__rows", F.inline(brackets)))
    here = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(n)) for k, n in renamed.items()])
    side = F.when(F.col("value") < F.col("__low"), -1).when(F.col("value") > F.col("__high"), 1).otherwise(0)
    counted = materialise(
        long.join(places, here)
        .groupBy(*keys, "p", "__rows", side.alias("__side"), F.when(side == 0, F.col("value")).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    inside = prefix_sum(counted.where("__side = 0").select(*keys, "p", "__rows", "value", "n"), [*keys, "p"], ["value"], ["n"])
    lower = counted.where("__side = -1").groupBy(*keys, "p").agg(F.sum("n").alias("__below"))
    lower = lower.select(*[F.col(k).alias(n) for k, n in renamed.items()], F.col("p").alias("__p"), "__below")
    first = F.coalesce("__below", F.lit(0)) + F.col("n_before")
    last = first + F.col("n") - 1
    spot = F.col("p") * (F.col("__rows") - 1)
    low = F.max(F.when(F.floor(spot).between(first, last), F.col("value")))
    high = F.max(F.when(F.ceil(spot).between(first, last), F.col("value")))
    found = inside.join(lower, here & (F.col("p") == F.col("__p")), "left").groupBy(*keys, "p").agg(
        low.alias("lo"), high.alias("hi"), F.max(spot - F.floor(spot)).alias("frac")
    )
    missed = F.raise_error(F.lit("a rank lies outside its bracket; use quantiles_of_counts")).cast("double")
    value = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("frac")
    return found.select(*keys, "p", F.when(F.col("lo").isNull() | F.col("hi").isNull(), missed).otherwise(value).alias("quantile"))


def quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), accuracy: int | None = None
) -> DataFrame:
    """Quantiles of several columns at once, `(by..., feature, p, quantile)`.

    Exact by default. With `accuracy`, one pass of mergeable sketches instead.
    """
    long = melt(df, columns, by)
    keys = [*by, "feature"]
    if accuracy is None:
        return bracketed_quantiles(long, keys, probs)
    points = F.array(*[F.lit(float(p)) for p in probs])
    sketch = long.groupBy(*keys).agg(F.percentile_approx("value", [float(p) for p in probs], accuracy).alias("q"))
    return sketch.select(*keys, F.explode(F.arrays_zip(points.alias("p"), F.col("q").alias("quantile"))).alias("z")).select(
        *keys, "z.p", "z.quantile"
    )


def quantiles_wide(quantile_rows: DataFrame, keys: Sequence[str], names: dict[float, str]) -> DataFrame:
    """One column per probability."""
    return quantile_rows.groupBy(*keys).agg(
        *[F.max(F.when(F.col("p") == F.lit(float(p)), F.col("quantile"))).alias(name) for p, name in names.items()]
    )
