"""Searches by buckets, imputers and codes as steps, and boosted trees, against plain versions on small tables."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ledgerlark.operators import boosting, impute, models, neighbours
from ledgerlark.session import run_dir


def near(a, b, p):
    both = [(x, y) for x, y in zip(a, b) if x is not None and y is not None]
    return math.sqrt(p / len(both) * sum((x - y) ** 2 for x, y in both)) if both else None


def filled(rows, given, k):
    """Plain neighbour imputation of `rows` from the rows `given`."""
    p = len(given[0][1])
    clean = lambda v: [None if x is None or x != x else x for x in v]
    given = [(i, clean(v)) for i, v in given]
    out = []
    for i, v in rows:
        v = clean(v)
        done = list(v)
        for c in range(p):
            if v[c] is None:
                found = sorted((d, j, w[c]) for j, w in given if w[c] is not None and (d := near(v, w, p)) is not None)[:k]
                known = [w[c] for _, w in given if w[c] is not None]
                done[c] = sum(f[2] for f in found) / len(found) if found else sum(known) / len(known)
        out.append((i, [round(x, 9) for x in done]))
    return sorted(out)


@pytest.fixture(scope="module")
def gappy(spark):
    rng = random.Random(3)
    rows = [(i, [None if rng.random() < 0.2 else float(rng.randrange(12)) for _ in range(3)]) for i in range(90)]
    rows += [(100, [None, None, None]), (101, [1.0, None, float("nan")]), (102, [None, 2.0, None])]
    rows += [(200 + i, [3.0, None, 4.0]) for i in range(8)] + [(300 + i, [3.0, 5.0, 4.0]) for i in range(8)]  # copies
    table = spark.createDataFrame([(i, *v) for i, v in rows], "id long, a double, b double, c double")
    return rows, table.selectExpr("*", "'x' AS q", "1 AS fill", "2 AS giver").repartition(4)


@pytest.mark.parametrize("block", [impute.BLOCK_ROWS, 7])
def test_neighbour_imputer(spark, gappy, monkeypatch, block):
    monkeypatch.setattr(impute, "BLOCK_ROWS", block)
    rows, table = gappy
    model = impute.NeighbourImputer(inputCols=["a", "b", "c"], k=3).fit(table.where("id % 2 = 0"))
    path = run_dir(spark, "test-imputer")
    model.write().overwrite().save(path)
    for fitted in (model, impute.NeighbourImputerModel.load(path)):
        found = fitted.transform(table)
        assert found.columns == table.columns
        values = sorted((r.id, [round(r[c], 9) for c in "abc"]) for r in found.collect())
        assert values == filled(rows, [r for r in rows if r[0] % 2 == 0], 3)
    assert model.transform(table.where("false")).count() == 0


def test_regression_imputer(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 2))
    rows = [(i, float(a), float(b), None if i % 5 == 0 else float(2 * a - b + 1)) for i, (a, b) in enumerate(x)]
    rows.append((999, float("nan"), 1.0, None))
    table = spark.createDataFrame(rows, "id long, a double, b double, c double")
    model = impute.RegressionImputer(inputCols=["a", "b", "c"]).fit(table)
    path = run_dir(spark, "test-imputer")
    model.write().overwrite().save(path)
    first, second = (sorted(map(tuple, m.transform(table).collect())) for m in (model, impute.RegressionImputerModel.load(path)))
    assert first == second and not any(v is None or v != v for r in first for v in r)
    for i, a, b, c in first[:-1]:
        assert abs(c - (2 * a - b + 1)) < 0.05 if i % 5 == 0 else c == rows[i][3]


def test_ordinal_coder(spark):
    table = spark.createDataFrame([(1, "b", 5), (2, "a", None), (3, None, 7), (4, "b", 5)], "id int, w string, n int")
    model = impute.OrdinalCoder(inputCols=["w", "n"]).fit(table)
    path = run_dir(spark, "test-codes")
    model.write().overwrite().save(path)
    more = table.unionByName(spark.createDataFrame([(5, "z", 6)], "id int, w string, n int"))
    for m in (model, impute.OrdinalCoderModel.load(path)):
        assert sorted(map(tuple, m.transform(more).select("id", "w", "n").collect())) == [(1, 1, 0), (2, 0, -1), (3, -1, 1), (4, 1, 0), (5, -1, -1)]


@pytest.mark.parametrize("block", [neighbours.BLOCK_ROWS, 16])
def test_hashed_neighbours(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", block)
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.normal(size=(1500, 4)), np.zeros((60, 4)), rng.normal(size=(40, 4)) * 0.01 + 3])
    table = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, v array<double>").repartition(4)
    found = neighbours.neighbours_of(table, table, 4, "id", "v", same_table=True, how=neighbours.Hashing()).collect()
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    for r in found:
        assert abs(r.distance - d[r.id, r.neighbour_id]) < 1e-9 and r.id != r.neighbour_id
    np.fill_diagonal(d, np.inf)
    best = np.sort(d, axis=1)
    met = sum(r.distance <= best[r.id, r["rank"] - 1] + 1e-9 for r in found)
    assert met >= 0.9 * 4 * len(points)
    counts = neighbours.pairs_met(table, table, 5, "id", "v").first()
    assert counts.pairs < counts.all_pairs / 2
    assert neighbours.nearest_hashed(table, table.where("false"), 3, "id", "v").count() == 0


@pytest.fixture(scope="module")
def classes(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 3)).round(2)
    label = np.where(x[:, 0] * x[:, 1] > 0, 0, np.where(x[:, 2] > 0, 1, 2))  # no single feature tells
    rows = [(i, int(y), 1.0 + i % 2, v.tolist(), i % 3) for i, (v, y) in enumerate(zip(x, label))]
    table = spark.createDataFrame(rows, "id long, label int, weight double, x array<double>, fold int")
    return x, label, table.withColumn("features", array_to_vector(F.col("x"))).drop("x").repartition(3)


def test_boosted_trees(spark, classes):
    x, label, table = classes
    some = [boosting.Candidate("a", 12, 3, 0.3), boosting.Candidate("b", 6, 3, 0.3), boosting.Candidate("c", 12, 2, 0.2, 0.7, 0.7, 0.1, fold=1), boosting.Candidate("d", 12, 2, 0.2, fold=2, expanding=True)]
    fits, stages = boosting.with_stages(some)
    assert len(fits) == 3 and stages == [(0, 12), (0, 6), (1, 12), (2, 12)]
    together = boosting.train(table, fits, 3)
    assert (together[0].margins(x).argmax(axis=1) == label).mean() > 0.95
    short = boosting.train(table, some[1:2], 3)[0]
    assert np.allclose(together[0].margins(x, 6), short.margins(x), atol=1e-9)  # the first rounds are the shorter model
    alone = boosting.train(table, some[2:3], 3)[0]
    assert np.allclose(together[1].margins(x), alone.margins(x), atol=1e-9)  # others beside it change nothing
    other = table.withColumn("label", F.when(F.col("fold") == 2, 0).otherwise(F.col("label")))
    assert (boosting.train(other, some[3:], 3)[0].margins(x) == together[2].margins(x)).all()  # left-out labels play no part
    again = boosting.Trees.of_rows(together[1].rows(), 12, 3)
    assert (again.margins(x) == together[1].margins(x)).all()
    gap = np.array([[np.nan, 0.5, 0.5]])
    assert (together[0].margins(gap) == together[0].margins(np.array([[np.inf, 0.5, 0.5]]))).all()
    out = boosting.held_out(table, some[2:], together, stages[2:]).collect()
    assert {(r.model, r.fold) for r in out} == {("c", 1), ("d", 2)} and len(out) == sum(i % 3 in (1, 2) for i in range(400))
    for r in out[:50]:
        p = boosting.probabilities(together[1 if r.model == "c" else 2].margins(x[r.id : r.id + 1]))[0]
        assert np.allclose(r.probability, p) and r.label == label[r.id]


def test_one_row_and_one_value(spark):
    table = spark.createDataFrame([(1, 0, 1.0, [2.0])], "id long, label int, weight double, x array<double>").withColumn("features", array_to_vector(F.col("x")))
    trees = boosting.train(table, [boosting.Candidate(rounds=2, depth=2)], 2)[0]
    assert (trees.feature == -1).all() and trees.margins(np.array([[5.0]]))[0].argmax() == 0
    with pytest.raises(ValueError, match="no rows"):
        boosting.train(table.where("false"), [boosting.Candidate()], 2)


def test_boosted_model_is_saved(spark, classes):
    _, label, table = classes
    model = models.BoostedPerClass(3, maxIter=5, maxDepth=3).fit(table)
    path = run_dir(spark, "test-boosted")
    model.write().overwrite().save(path)
    first, second = (sorted(map(tuple, models.score(m, table).collect())) for m in (model, models.BoostedPerClassModel.load(path)))
    assert first == second and abs(sum(first[0][3]) - 1) < 1e-12
    assert sorted(map(tuple, models.score(model.stage(5), table).collect())) == first


def test_search_equals_fits_one_by_one(spark, classes):
    _, _, table = classes
    rows = table.select("id", "label", "weight", "features", "fold")
    points = [{"maxIter": n, "maxDepth": d} for n in (3, 6) for d in (2, 3)]
    found = models.search(rows, lambda train, **p: models.BoostedPerClass(3, **p), points, range(3)).collect()
    for r, p in zip(sorted(found, key=lambda r: r.params), points):
        assert all(f"{k}={v}" in r.params for k, v in p.items())
        scores = []
        for fold in range(3):
            trees = boosting.train(rows, [models.BoostedPerClass(3, **p).candidate("m", fold)], 3)
            held = boosting.held_out(rows, [models.BoostedPerClass(3, **p).candidate("m", fold)], trees, [(0, p["maxIter"])])
            scores.append(models.fold_metrics(held.withColumn("prediction", F.array_position("probability", F.array_max("probability")).cast("int") - 1)).first().f1_weighted)
        assert abs(np.mean(scores) - r["mean"]) < 1e-9


def test_boosting_packs_rows_and_scores_once(spark, classes, monkeypatch):
    x, _, table = classes
    edges = boosting.bin_edges(table, 3)
    rows = table.select("label", "weight", "fold", F.xxhash64("id").alias("h"), boosting.vector_to_array("features").alias("x")).coalesce(1)
    assert rows.mapInArrow(boosting._binned(edges), boosting.STATE).count() == 1  # one packed row, not 400
    whole = boosting.train(table, [boosting.Candidate(rounds=4, depth=3, fold=1)], 3)[0].margins(x)
    monkeypatch.setattr(boosting, "BLOCK", 32)
    monkeypatch.setattr(boosting, "WRITE_ROUNDS", 2)
    assert np.allclose(boosting.train(table, [boosting.Candidate(rounds=4, depth=3, fold=1)], 3)[0].margins(x), whole, atol=1e-9)


def test_closest_equals_differences():
    rng = np.random.default_rng(8)
    points = np.concatenate([rng.normal(size=(700, 5)), rng.integers(0, 3, size=(500, 5)), np.full((30, 5), 1e6)])
    some = np.concatenate([rng.normal(size=(40, 5)), points[690:720], np.full((3, 5), 1e6)])
    d = np.sqrt(((some[:, None] - points[None]) ** 2).sum(axis=2))
    row, at, distance = neighbours._closest(some, points, 6)
    best = neighbours._first_of(row, distance, at, 6)
    assert len(row) < d.size / 4  # most are left out by products
    assert at[best].reshape(-1, 6).tolist() == np.argsort(d, axis=1, kind="stable")[:, :6].tolist()
    assert (distance == d[row, at]).all()
    row, at, distance = neighbours._closest(np.array([[np.nan] * 5]), points, 6)  # out of range: none is left out
    assert len(row) == len(points) and np.isnan(distance).all()


def test_queries_meet_a_tile_once(spark):
    rng = np.random.default_rng(9)
    table = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(rng.normal(size=(2000, 4)))], "id long, v array<double>")
    places = neighbours._places(table, "v")
    asks, _ = neighbours._buckets(places, table, 2000, neighbours.Hashing())
    met = asks.agg(F.count("*").alias("rows"), F.countDistinct("qn", "tile").alias("once"), F.sum(F.size("cells")).alias("cells")).first()
    assert met.rows == met.once == 4 * 2000 and met.cells == 4 * 6 * 2000  # a row for each table, not for each bucket


def test_side_by_side_tiles_hold_a_bounded_number():
    rng = np.random.default_rng(10)
    points, rows = rng.normal(size=(300, 2)), rng.integers(1, 50, size=300)
    tile = neighbours._side_by_side(points, rows, 400)
    assert tile.max() + 1 == len(np.unique(tile)) and np.bincount(tile, rows).max() <= 400


@pytest.mark.parametrize("spaces", [32, 4])
def test_neighbour_imputer_searches_shared_columns(spark, gappy, monkeypatch, spaces):
    monkeypatch.setattr(impute, "SMALL_PAIRS", 0)
    monkeypatch.setattr(impute, "MAX_SPACES", spaces)
    rows, table = gappy
    model = impute.NeighbourImputer(inputCols=["a", "b", "c"], k=3).fit(table.where("id % 2 = 0"))
    compared = []
    plain = impute.NeighbourImputerModel._compared
    monkeypatch.setattr(impute.NeighbourImputerModel, "_compared", lambda self, asked, k: compared.append(asked.count()) or plain(self, asked, k))
    values = sorted((r.id, [round(r[c], 9) for c in "abc"]) for r in model.transform(table).collect())
    assert values == filled(rows, [r for r in rows if r[0] % 2 == 0], 3)
    assert (compared == [1]) == (spaces == 32)  # the row without any value; beyond the limit other patterns too


def test_forest_is_fitted_in_few_tasks(spark, classes, monkeypatch):
    table = classes[2].repartition(40)
    parts = []
    fit = models.RandomForestClassifier._fit
    monkeypatch.setattr(models.RandomForestClassifier, "_fit", lambda self, df: parts.append(df.rdd.getNumPartitions()) or fit(self, df))
    model = models.random_forest(numTrees=3, maxDepth=2).fit(table)
    assert model.getNumTrees == 3
    monkeypatch.setattr(models, "TASK_ROWS", 20)
    models.random_forest(numTrees=3, maxDepth=2).fit(table)
    assert parts == [max(8, spark.sparkContext.defaultParallelism), 20]


def test_boosting_passes_need_no_query_plans(spark, classes, monkeypatch):
    _, _, table = classes
    planned, whole = [], type(table).mapInArrow
    monkeypatch.setattr(type(table), "mapInArrow", lambda self, *args, **options: planned.append(1) or whole(self, *args, **options))
    some = [boosting.Candidate(rounds=3, depth=4)]
    trees = boosting.train(table, some, 3)[0]
    assert len(planned) == 1  # of packing the rows; every level of every round was one before
    monkeypatch.setattr(boosting, "DRIVER_BYTES", 0)
    again = boosting.train(table, some, 3)[0]
    assert (again.feature == trees.feature).all() and (again.value == trees.value).all()  # searched after a shuffle or without


def test_validation_grows_all_boosted_models_at_once(spark, classes, monkeypatch):
    _, _, table = classes
    rows = table.drop("fold")
    train, test = rows.where("id % 5 > 0"), rows.where("id % 5 = 0")
    calls, grow = [], boosting.train
    monkeypatch.setattr(boosting, "train", lambda *args: calls.append(len(args[1])) or grow(*args))
    build = lambda part, **p: models.BoostedPerClass(3, maxIter=4, maxDepth=3)
    found = models.predictions_of({"b": build, "l": lambda part: models.logistic(part.count(), maxIter=5)}, train, test, 2).collect()
    assert calls == [3]  # two folds and all rows, in the passes of one fit
    assert sorted(r.id for r in found if r.model == "b") == list(range(400)) == sorted(r.id for r in found if r.model == "l")
    alone = {r.id: r for r in models.score(build(train).fit(train), test).collect()}
    held = [r for r in found if r.model == "b" and r.fold == models.TEST]
    assert {r.id for r in held} == set(alone)
    for r in held:
        assert np.allclose(r.probability, alone[r.id].probability, atol=1e-9) and (r.label, r.prediction) == (alone[r.id].label, alone[r.id].prediction)


def test_fits_start_few_tasks(spark, classes):
    rows = classes[2].selectExpr("id", "'c' || label AS name", "CAST(id AS DOUBLE) AS x")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 70)
    try:
        frame = models.training_frame(rows, ["x"], "name", "id")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert frame.rdd.getNumPartitions() <= max(spark.sparkContext.defaultParallelism, models.LEAST_TASKS) and frame.count() == 400


@pytest.mark.parametrize("block", [neighbours.BLOCK_ROWS, 16])
def test_spaces_are_searched_apart(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", block)
    rng = np.random.default_rng(11)
    some = [(n, i, rng.integers(0, 9, size=1 + n % 2).astype(float).tolist()) for n in (0, 1, 3) for i in range(120)]
    donors = spark.createDataFrame(some, "part int, id long, v array<double>").repartition(3)
    asks = spark.createDataFrame([(n, [4.0] * (1 + n % 2)) for n in range(3)], "part int, v array<double>")  # nothing to find in part 2
    found = {r.space: [(s.distance, s.neighbour_id) for s in r.near] for r in neighbours.nearest_lists(asks, donors, 4, "id", "v", "part").collect()}
    assert found == {n: sorted((math.dist(v, [4.0] * len(v)), i) for m, i, v in some if m == n)[:4] for n in (0, 1)}


def test_imputer_searches_all_columns_in_few_jobs(spark, gappy, monkeypatch):
    monkeypatch.setattr(impute, "SMALL_PAIRS", 0)
    _, table = gappy
    model = impute.NeighbourImputer(inputCols=["a", "b", "c"], k=3).fit(table)
    calls, search = [], impute.nearest_lists
    monkeypatch.setattr(impute, "nearest_lists", lambda *args: calls.append(args[0].select("space").distinct().count()) or search(*args))
    spark.sparkContext.setJobGroup("imputing", "")
    try:
        model.transform(table).count()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert calls == [15]  # sets of shared columns, each of which took its own jobs before
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("imputing")) < 150


def test_boosted_models_of_few_rows_need_no_passes(spark, classes, monkeypatch):
    """Grown by one task each, bit for bit as by passes over blocks of several parts."""
    x, _, table = classes
    dealt = table.repartition(3, "id")
    some = [boosting.Candidate(rounds=5, depth=4, row_share=0.7, feature_share=0.7, alpha=0.1), boosting.Candidate(rounds=3, depth=2, fold=1), boosting.Candidate(rounds=4, depth=3, fold=2, expanding=True), boosting.Candidate(rounds=2, depth=2, fold=-9, expanding=True)]
    monkeypatch.setattr(boosting, "BLOCK", 64)
    monkeypatch.setattr(boosting, "TASK_CELLS", 500)
    calls, passes = [], boosting._in_passes
    monkeypatch.setattr(boosting, "_in_passes", lambda *args: calls.append(args) or passes(*args))
    apart = boosting.train(dealt, some, 3)
    assert not calls
    monkeypatch.setattr(boosting, "WHOLE_BYTES", 0)
    for one, other in zip(apart, boosting.train(dealt, some, 3)):
        assert one.rows() == other.rows() and (one.margins(x) == other.margins(x)).all()
    assert len(calls) == 1


def test_regression_of_few_rows_passes_in_one_stage(spark, classes, monkeypatch):
    table = classes[2].repartition(40)
    parts = []
    fit = models.LogisticRegression._fit
    monkeypatch.setattr(models.LogisticRegression, "_fit", lambda self, df: parts.append(df.rdd.getNumPartitions()) or fit(self, df))
    few = models.logistic(400, maxIter=50).fit(table)
    monkeypatch.setattr(models, "PASS_ROWS", 20)
    assert np.allclose(few.coefficientMatrix.toArray(), models.logistic(400, maxIter=50).fit(table).coefficientMatrix.toArray(), atol=1e-6)
    assert parts == [1, max(8, spark.sparkContext.defaultParallelism)]


def test_exact_search_sends_a_query_to_few_cells(spark, monkeypatch):
    """What lies beyond the plane to the next pivot, or the k-th donor of the own cell, is not asked for."""
    rng = np.random.default_rng(11)
    points = rng.normal(size=(3000, 6))
    table = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, v array<double>")
    asked, asks = [], neighbours._asks
    monkeypatch.setattr(neighbours, "_asks", lambda *args: asked.append(asks(*args)) or asked[-1])
    found = neighbours.neighbours_of(table, table, 4, "id", "v", same_table=True).collect()
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    best = np.sort(d, axis=1)
    assert len(found) == 4 * len(points)
    assert all(abs(r.distance - best[r.id, r["rank"] - 1]) < 1e-12 for r in found)
    cells = sum(a.select(F.sum(F.size("cells"))).first()[0] for a in asked)
    assert cells < 8 * len(points)  # 13 of 13 cells a query before
