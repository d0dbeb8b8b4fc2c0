"""Streams over several micro-batches: late events, restarts, results equal to a batch run."""

import pytest
from pyspark.sql import functions as F

from ledgerlark.streaming import jobs

SCHEMA = "experiment_id string, unit_id long, variant string, ts timestamp, prediction int"


def at(day: int, hour: int = 0) -> str:
    return f"2024-01-{day:02d} {hour:02d}:00:00"


def put(spark, folder, number: int, rows: list[tuple], schema: str) -> None:
    """One file, hence one micro-batch, later than those before it."""
    frame = spark.createDataFrame(rows, schema.replace(" timestamp", " string"))
    times = {f.split()[0]: F.to_timestamp(f.split()[0]) for f in schema.split(", ") if f.endswith("timestamp")}
    frame.withColumns(times).coalesce(1).write.parquet(f"{folder}/{number:03d}")


def stream_of(spark, folder, schema: str):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(folder))


LOG = "timestamp timestamp, operation string, duration_seconds double"


def test_windows_over_batches_with_a_late_event_and_a_restart(spark, tmp_path):
    source, path = tmp_path / "log", str(tmp_path / "run")
    put(spark, source, 1, [(at(1, 1), "a", 1.0), (at(1, 2), "a", 3.0)], LOG)
    put(spark, source, 2, [(at(1, 3), "a", 5.0), (at(9, 1), "a", 7.0)], LOG)
    put(spark, source, 3, [(at(9, 2), "b", 1.0)], LOG)

    def run():
        windows = jobs.timing_windows(stream_of(spark, source, LOG), length="1 day", slide="1 day")
        found = jobs.run_updates(windows, path, ["window_start", "operation"])
        return sorted((str(r["window_start"])[:10], r["operation"], r["count"]) for r in found.collect())

    first = run()
    assert first == [("2024-01-01", "a", 3), ("2024-01-09", "a", 1), ("2024-01-09", "b", 1)]
    assert run() == first  # nothing new: a restart changes nothing
    put(spark, source, 4, [(at(1, 4), "a", 100.0), (at(9, 3), "b", 2.0)], LOG)  # the first lies days behind the watermark
    assert run() == [("2024-01-01", "a", 3), ("2024-01-09", "a", 1), ("2024-01-09", "b", 2)]


def test_matches_over_batches(spark, tmp_path):
    """Each prediction counts once, its outcome may come in a later batch, and one beyond an hour does not match."""
    left, right, path = tmp_path / "predictions", tmp_path / "outcomes", str(tmp_path / "matched")
    outcomes = "unit_id long, actual_ts timestamp, actual int"
    put(spark, left, 1, [("e", 1, "t", at(1, 1), 1), ("e", 2, "c", at(1, 1), 0)], SCHEMA)
    put(spark, left, 2, [("e", 1, "t", at(1, 1), 1), ("e", 3, "t", at(1, 2), 1)], SCHEMA)
    put(spark, right, 1, [(1, at(1, 1), 1), (3, at(1, 9), 1)], outcomes)
    put(spark, right, 2, [(2, at(1, 2), 1)], outcomes)

    def run():
        pairs = jobs.matched_events(stream_of(spark, left, SCHEMA), stream_of(spark, right, outcomes))
        return sorted((r["unit_id"], r["actual"]) for r in jobs.run_append(pairs, path).collect())

    assert run() == [(1, 1), (2, 1)]
    assert run() == [(1, 1), (2, 1)]
    put(spark, left, 3, [("e", 4, "t", at(20, 1), 1)], SCHEMA)
    put(spark, right, 3, [(4, at(20, 1), 0)], outcomes)
    assert run() == [(1, 1), (2, 1), (4, 0)]


@pytest.mark.parametrize("batches", [1, 3])
def test_drift_counts_do_not_depend_on_the_batches(spark, tmp_path, batches):
    source = tmp_path / f"values{batches}"
    schema = "ts timestamp, event_type string, value double"
    rows = [(at(1 + k % 2, k % 24), "x", float(k % 13)) for k in range(90)]
    for number in range(batches):
        put(spark, source, number, rows[number::batches], schema)
    ranges = spark.createDataFrame([("x", 0.0, 10.0, 1.0)], "event_type string, start double, stop double, width double")
    counts = jobs.drift_bin_counts(stream_of(spark, source, schema), ranges, ["event_type"], "value")
    found = jobs.run_updates(counts, str(tmp_path / f"run{batches}"), ["window_start", "event_type", "bin"])
    assert found.agg(F.sum("n")).first()[0] == 90
    assert found.where("bin = -1").agg(F.sum("n")).first()[0] == sum(v > 10 for _, _, v in rows)
