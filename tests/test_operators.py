"""Operators against brute force on small fixtures, with hot keys, copies, ties and edge values."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from ledgerlark.functions import special
from ledgerlark.operators import drift, experiments, explain, explore, features, metrics, neighbours, ordered, profile
from ledgerlark.operators import models as ml


def skewed(n=3000, seed=1):
    """A third of all rows share one key and one value."""
    rng = np.random.default_rng(seed)
    keys = np.where(rng.random(n) < 0.34, "hot", rng.integers(0, 40, n).astype(str))
    values = np.where(keys == "hot", np.where(rng.random(n) < 0.5, 7.0, rng.normal(size=n).round(2)), rng.normal(size=n).round(1))
    return pd.DataFrame({"id": np.arange(n), "key": keys, "value": values})


@pytest.mark.parametrize("partitions", [1, 7])
def test_prefix_sum_over_several_blocks(spark, partitions):
    pdf = skewed()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = ordered.row_index(spark.createDataFrame(pdf), ["key"], ["value", "id"]).toPandas().set_index("id")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    expected = pdf.sort_values(["key", "value", "id"]).assign(row_index=lambda d: d.groupby("key").cumcount()).set_index("id")
    assert (got["row_index"].sort_index() == expected["row_index"].sort_index()).all()
    assert (got["row_index_total"].sort_index() == pdf.set_index("id")["key"].map(pdf["key"].value_counts())).all()


@pytest.mark.parametrize("p", [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0])
def test_quantiles_are_exact(spark, p):
    pdf = skewed()
    pdf.loc[::50, "value"] = np.nan
    got = {r["key"]: r["quantile"] for r in ordered.quantiles(spark.createDataFrame(pdf), ["value"], [p], by=["key"]).collect()}
    for key, group in pdf.groupby("key"):
        assert got[key] == pytest.approx(np.nanpercentile(group["value"], 100 * p), abs=1e-12)


def test_quantiles_are_exact_beyond_the_sketch(spark):
    """More values than the sketch holds, with a hot value, a missing key and ties at the edges."""
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=4000), np.zeros(2000), rng.integers(0, 5, 1000)])
    df = spark.createDataFrame([(None if i % 7 == 0 else i % 2, float(v)) for i, v in enumerate(values)], "key long, value double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = ordered.bracketed_quantiles(ordered.melt(df, ["value"], ["key"]), ["key", "feature"], probs, accuracy=100).collect()
    assert len(found) == 3 * len(probs)
    for key in (None, 0, 1):
        own = [v for i, v in enumerate(values) if (None if i % 7 == 0 else i % 2) == key]
        for r in found:
            if r["key"] == key:
                assert r["quantile"] == pytest.approx(np.quantile(own, r["p"]), abs=1e-12)


def test_copies_are_numbered_in_runs(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 7), ("d", 6)], "id string, copies int")
    found = sorted(tuple(r) for r in neighbours.numbered_copies(df, ["id"], run=3).collect())
    assert found == [("b", 1), *[("c", k) for k in range(1, 8)], *[("d", k) for k in range(1, 7)]]


def test_missing_keys_are_groups(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", None), ("b", 2.0)], "key string, value double")
    found = {r["key"]: (r["count"], r["median"]) for r in profile.describe_by_group(df, ["value"], "key").collect()}
    assert found == {None: (2, 2.0), "a": (0, None), "b": (1, 2.0)}
    boxes = {r["key"]: (r["median"], r["n_outside"]) for r in profile.boxplot_stats(df, "value", "key").collect()}
    assert boxes == {None: (2.0, 0), "a": (None, 0), "b": (2.0, 0)}
    rows = spark.createDataFrame([(i, None if i % 4 == 0 else i % 2) for i in range(100)], "id long, label long")
    assert features.stratified_split(rows, "label", "id").count() == features.stratified_folds(rows, "label", "id").count() == 100


def test_products_of_all_columns(spark):
    names = [f"c{i}" for i in range(12)]
    df = spark.createDataFrame([tuple(float(i) for i in range(12))], names)
    assert len(features.Interactions(inputCols=names).transform(df).columns) == 12 + 66
    assert len(features.Interactions(inputCols=names, maxColumns=4).transform(df).columns) == 12 + 6


def test_quantiles_by_sketch_are_close(spark):
    df = spark.range(10001).select(F.col("id").cast("double").alias("v"))
    got = ordered.quantiles(df, ["v"], [0.5], accuracy=10000).first()["quantile"]
    assert got == pytest.approx(5000, abs=2)


def test_column_profile_counts_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "a"), (1.0, "b")], "x double, s string")
    rows = {r["column"]: r for r in profile.column_profile(df).collect()}
    assert (rows["x"]["missing_count"], rows["x"]["unique_values"]) == (2, 1)
    assert (rows["s"]["missing_count"], rows["s"]["unique_values"], rows["s"]["missing_pct"]) == (1, 2, 25.0)


def test_quality_score_floor_and_empty_outliers(spark):
    df = spark.createDataFrame([(None,)] * 20, "s string")
    score = profile.quality_score(profile.column_profile(df), profile.duplicate_profile(df), profile.iqr_outliers(spark.createDataFrame([], "x double"), ["x"]))
    assert score.first()["quality_score"] == pytest.approx(100 - 30 - 20)


def test_constant_columns_do_not_fail(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 5.0)], "a double, b double")
    assert explore.correlation_pairs(df, ["a", "b"]).first()["r"] is None
    for method, expected in (("standard", 0.0), ("robust", 0.0), ("minmax", 0.0)):
        out = features.ColumnScaler(inputCols=["a"], method=method).fit(df).transform(df)
        assert {r["a"] for r in out.collect()} == {expected}
    bins = profile.histogram(df, ["a"]).where("n > 0").collect()
    assert [(r["bin"], r["n"]) for r in bins] == [(5, 3)]


def test_unknown_strategy_is_refused(spark):
    df = spark.createDataFrame([(1.0,)], "a double")
    for step in (
        features.ColumnImputer(inputCols=["a"], method="simple"),
        features.ColumnScaler(inputCols=["a"], method="none"),
        features.OutlierCapper(inputCols=["a"], method="other"),
    ):
        with pytest.raises(ValueError, match="unknown"):
            step.fit(df)


def test_too_many_categories_are_refused_not_cut(spark):
    df = spark.range(20).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError, match="too many categories"):
        features.OneHot(inputCols=["c"], most=10).fit(df)
    coded = features.ordinal_encode(df, features.ordinal_codes(df, "c"), "c", "code")
    assert sorted(r["code"] for r in coded.collect()) == list(map(float, range(20)))


def test_steps_save_and_load(spark, tmp_path):
    pdf = pd.DataFrame(np.random.default_rng(3).normal(size=(50, 5)), columns=list("abcde"))
    pdf["c1"] = ["x", "y"] * 25
    df = spark.createDataFrame(pdf)
    steps = Pipeline(stages=[
        features.OutlierCapper(inputCols=list("abcde"), threshold=1.0),
        features.ColumnScaler(inputCols=list("abcde"), method="robust"),
        features.OneHot(inputCols=["c1"]),
        features.DomainFeatures(inputCols=list("abcde")),
        features.Interactions(inputCols=list("abc")),
        features.BestFeatures(inputCols=list("abcde"), labelCol="c1_y", k=3),
    ]).fit(df)
    steps.write().overwrite().save(str(tmp_path / "steps"))
    again = PipelineModel.load(str(tmp_path / "steps"))
    left, right = steps.transform(df).toPandas(), again.transform(df).toPandas()
    pd.testing.assert_frame_equal(left.sort_values(list(left)).reset_index(drop=True), right.sort_values(list(right)).reset_index(drop=True))


def test_thresholds_stay_fitted(spark):
    fit_on = spark.createDataFrame([(float(i),) * 5 for i in range(9)], "a double, b double, c double, d double, e double")
    model = features.DomainFeatures(inputCols=list("abcde")).fit(fit_on)
    later = spark.createDataFrame([(100.0,) * 5], fit_on.schema)
    row = model.transform(later).first()
    assert (row["high_risk_0"], row["low_risk_0"]) == (1, 0)


def test_row_statistics_skip_missing(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (2.0, None, None)], "a double, b double, c double")
    rows = df.select(*[c.alias(n) for n, c in features.statistics_of(["a", "b", "c"]).items()]).collect()
    assert rows[0]["feature_mean"] == 2.0 and rows[0]["feature_std"] == pytest.approx(math.sqrt(2))
    assert rows[1]["feature_std"] == 0.0 and rows[1]["feature_max"] == 2.0


def test_stratified_split_is_exact_per_class(spark):
    df = spark.createDataFrame(skewed()).withColumn("label", F.when(F.col("key") == "hot", 1).otherwise(0))
    counts = {(r["label"], r["part"]): r["count"] for r in features.stratified_split(df, "label", "id").groupBy("label", "part").count().collect()}
    for label in (0, 1):
        total = counts[label, "test"] + counts[label, "train"]
        assert counts[label, "test"] == math.floor(total * 0.2 + 0.5)


def test_folds_are_disjoint_and_cover(spark):
    df = spark.range(1000).withColumn("label", (F.col("id") % 3 == 0).cast("int"))
    rows = features.stratified_folds(df, "label", "id", 5).groupBy("label", "fold").count().collect()
    assert sum(r["count"] for r in rows) == 1000 and len(rows) == 10
    for label in (0, 1):
        sizes = [r["count"] for r in rows if r["label"] == label]
        assert max(sizes) - min(sizes) <= 1


def brute_ks_mw(a, b):
    grid = np.unique(np.concatenate([a, b]))
    d = max(abs((a <= v).mean() - (b <= v).mean()) for v in grid)
    u = sum((a[:, None] > b[None, :]).sum(axis=1)) + 0.5 * (a[:, None] == b[None, :]).sum()
    return d, u


def test_drift_statistics_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=400).round(1), rng.normal(0.3, 1.2, size=300).round(1)
    frames = [spark.createDataFrame(pd.DataFrame({"x": v})) for v in (a, b)]
    ranked = drift.ranked_counts(drift.side_counts(*frames, ["x"]))
    d, u = brute_ks_mw(a, b)
    assert drift.ks_test(drift.rank_sums(ranked)).first()["statistic"] == pytest.approx(d)
    assert drift.mann_whitney(drift.rank_sums(ranked)).first()["statistic"] == pytest.approx(u)
    edges = np.histogram_bin_edges(a, bins=10)
    p, q = np.histogram(a, edges)[0] / len(a), np.histogram(b, edges)[0] / len(b)
    p, q = np.where(p == 0, 1e-4, p), np.where(q == 0, 1e-4, q)
    assert drift.psi(ranked).first()["statistic"] == pytest.approx(np.sum((q - p) * np.log(q / p)))
    stats = drift.side_stats(ranked).where("side = 'reference'").first()
    assert stats["mean"] == pytest.approx(a.mean()) and stats["std_samp"] == pytest.approx(a.std(ddof=1))
    assert stats["median"] == pytest.approx(np.median(a))
    z = (a - a.mean()) / a.std()
    assert stats["skewness"] == pytest.approx((z**3).mean()) and stats["kurtosis"] == pytest.approx((z**4).mean() - 3)


def test_psi_of_constant_reference(spark):
    ref = spark.createDataFrame([(1.0,)] * 10, "x double")
    new = spark.createDataFrame([(1.0,)] * 5 + [(9.0,)] * 5, "x double")
    ranked = drift.ranked_counts(drift.side_counts(ref, new, ["x"]))
    assert drift.psi(ranked).first()["statistic"] == pytest.approx((0.5 - 1.0) * math.log(0.5))


def test_unseen_category_is_certain_drift(spark):
    ref = spark.createDataFrame([("a",)] * 10 + [("b",)] * 10, "c string")
    new = spark.createDataFrame([("a",)] * 10 + [("z",)] * 10, "c string")
    row = drift.target_chi2(drift.aligned_categories(ref, new, "c")).first()
    assert math.isinf(row["statistic"]) and row["p_value"] == 0.0 and row["drift_detected"]


@pytest.mark.parametrize("x, df, p", [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (18.307038053275146, 10, 0.05), (0.0, 3, 1.0)])
def test_chi2_tail(x, df, p):
    assert special.chi2_tail_value(x, df) == pytest.approx(p, abs=1e-12)


@pytest.mark.parametrize("df, q", [(1, 12.706204736432095), (5, 2.570581835636314), (30, 2.0422724563012373), (1000, 1.9623390808264078)])
def test_t_quantile(df, q):
    assert special.t_quantile(0.975, df) == pytest.approx(q, rel=1e-9)
    assert special.t_two_sided(q, df) == pytest.approx(0.05, rel=1e-9)


def test_kolmogorov_tail(spark):
    row = spark.range(1).select(
        special.kolmogorov_tail(F.lit(1.3580986393225505)).alias("p"), special.kolmogorov_tail(F.lit(0.0)).alias("one")
    ).first()
    assert row["p"] == pytest.approx(0.05, abs=1e-9) and row["one"] == 1.0


def test_t_test_against_formula(spark):
    rng = np.random.default_rng(2)
    c, t = rng.normal(0, 1, 200), rng.normal(0.4, 1.3, 150)
    rows = [("e", "control", float(v)) for v in c] + [("e", "treatment", float(v)) for v in t]
    df = spark.createDataFrame(rows, "experiment_id string, variant string, v double")
    r = experiments.t_test(experiments.variant_moments(df, F.col("v"))).first()
    pooled = ((len(t) - 1) * t.var(ddof=1) + (len(c) - 1) * c.var(ddof=1)) / (len(t) + len(c) - 2)
    assert r["test_statistic"] == pytest.approx((t.mean() - c.mean()) / math.sqrt(pooled * (1 / len(t) + 1 / len(c))))
    assert r["ci_lower"] < r["difference"] < r["ci_upper"] and r["winner"] == "treatment"


def test_small_sample_is_not_significant(spark):
    df = spark.createDataFrame([("e", v, float(v == "treatment")) for v in ["control", "treatment"] * 20], "experiment_id string, variant string, v double")
    r = experiments.t_test(experiments.variant_moments(df, F.col("v"))).first()
    assert not r["significant"] and r["winner"] == "inconclusive" and "100" in r["reason"]


def test_auc_with_ties_equals_pair_counting(spark):
    rng = np.random.default_rng(8)
    label, score = rng.integers(0, 2, 300), rng.integers(0, 12, 300) / 12
    df = spark.createDataFrame(
        [("m", int(y), 0, [float(1 - s), float(s)]) for y, s in zip(label, score)], "model string, label int, prediction int, probability array<double>"
    )
    got = {r["class"]: r["roc_auc"] for r in metrics.roc_auc_by_class(df).collect()}
    pos, neg = score[label == 1], score[label == 0]
    expected = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert got[1] == pytest.approx(expected) and got[0] == pytest.approx(expected)


def test_calibration_bin_edges(spark):
    df = spark.createDataFrame([("m", 1, 1, [1 - s, s]) for s in (0.0, 0.1, 0.10001, 0.5, 1.0)], "model string, label int, prediction int, probability array<double>")
    bins = {(r["class"], r["bin"]): r["n"] for r in metrics.calibration(df).collect()}
    assert bins[1, 0] == 2 and bins[1, 1] == 1 and bins[1, 4] == 1 and bins[1, 9] == 1


def brute_neighbours(points, ids, k):
    d = np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2))
    out = {}
    for i, me in enumerate(ids):
        others = [j for j in np.lexsort((ids, d[i])) if ids[j] != me]
        out[me] = [(ids[j], d[i, j]) for j in others[:k]]
    return out


@pytest.mark.parametrize("copies", [0, 120])
def test_neighbours_equal_brute_force(spark, copies, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 37)
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.normal(size=(260, 3)), np.repeat([[0.1, 0.2, 0.3]], copies, axis=0)])
    ids = rng.permutation(len(points))
    df = spark.createDataFrame([(int(i), [float(x) for x in p]) for i, p in zip(ids, points)], "id long, v array<double>")
    found = neighbours.neighbours_of(df, df, 4, "id", "v", same_table=True).orderBy("id", "rank").collect()
    expected = brute_neighbours(points, ids, 4)
    got = {}
    for r in found:
        got.setdefault(r["id"], []).append((r["neighbour_id"], r["distance"]))
    assert set(got) == set(expected)
    for i, near in expected.items():
        assert [n for n, _ in got[i]] == [n for n, _ in near]
        assert [d for _, d in got[i]] == pytest.approx([d for _, d in near])


def test_smote_balances_inside_the_class(spark):
    rng = np.random.default_rng(6)
    rows = [(i, "big", *map(float, rng.normal(size=2))) for i in range(60)] + [(100 + i, "small", *map(float, rng.normal(9, 1, size=2))) for i in range(14)]
    df = spark.createDataFrame(rows, "id int, label string, a double, b double")
    out = neighbours.smote(df, "label", "id", ["a", "b"]).toPandas()
    assert out.groupby("label").size().to_dict() == {"big": 60, "small": 60}
    small, made = out[(out.label == "small") & ~out.synthetic], out[out.synthetic]
    for c in "ab":
        assert made[c].between(small[c].min(), small[c].max()).all()
    assert out["id"].is_unique


def test_smote_single_member_is_copied(spark):
    df = spark.createDataFrame([(1, "a", 0.0), (2, "a", 1.0), (3, "b", 5.0)], "id int, label string, x double")
    out = neighbours.smote(df, "label", "id", ["x"]).toPandas()
    assert out[out.label == "b"]["x"].tolist() == [5.0, 5.0]


def test_iterative_impute_recovers_a_linear_column(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=300)
    pdf = pd.DataFrame({"x": x, "y": 3 * x + 1, "z": rng.normal(size=300)})
    truth = pdf["y"].copy()
    pdf.loc[::6, "y"] = np.nan
    out = ml.iterative_impute(spark.createDataFrame(pdf), ["x", "y", "z"]).toPandas().sort_values("x")
    assert np.allclose(out["y"], truth[np.argsort(x)], atol=0.05)


def test_linear_attribution_adds_up(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, 7.0), (3, 5.0, 0.0)], "id int, a double, b double")
    means = explain.column_means(df, ["a", "b"])
    shap = explain.linear_attribution(df, "id", {"c": {"a": 2.0, "b": -1.0}}, means)
    totals = {r["row_id"]: r["s"] for r in shap.groupBy("row_id").agg(F.sum("shap_value").alias("s")).collect()}
    assert totals[2] == pytest.approx(2 * (3 - 3) - (7 - 3))


def test_sampled_attribution_adds_up_to_the_change(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    rng = np.random.default_rng(11)
    x = rng.normal(size=(80, 3))
    y = (x[:, 0] - x[:, 1] > 0).astype(float)
    df = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))], "id int, a double, b double, c double, label double")
    names = ["a", "b", "c"]
    model = Pipeline(stages=[VectorAssembler(inputCols=names, outputCol="features"), LogisticRegression(regParam=0.1)]).fit(df)
    means = explain.column_means(df, names)
    values = explain.sampled_shapley(df, "id", names, model, means, permutations=3, class_index=1)
    sums = {r["row_id"]: r["s"] for r in values.groupBy("row_id").agg(F.sum("shap_value").alias("s")).collect()}
    p = {str(r["id"]): r["p"] for r in model.transform(df).select("id", vector_to_array("probability")[1].alias("p")).collect()}
    base = model.transform(spark.createDataFrame([tuple(means[n] for n in names)], "a double, b double, c double")).select(vector_to_array("probability")[1]).first()[0]
    for i, total in sums.items():
        assert total == pytest.approx(p[i] - base, abs=1e-9)


def test_boosted_probabilities_sum_to_one(spark):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(150, 2))
    y = np.digitize(x[:, 0], [-0.5, 0.5])
    df = spark.createDataFrame([(i, str(t), *map(float, r)) for i, (r, t) in enumerate(zip(x, y))], "id int, target string, a double, b double")
    frame = ml.training_frame(df, ["a", "b"], "target", "id")
    scored = ml.score(ml.BoostedPerClass(3, maxIter=3, maxDepth=2).fit(frame), frame).toPandas()
    assert np.allclose([sum(p) for p in scored["probability"]], 1.0)
    assert (scored["prediction"] == scored["label"]).mean() > 0.8
    assert (scored["confidence"] == [max(p) for p in scored["probability"]]).all()


def test_search_ranks_and_grid_draws(spark):
    points = ml.draw_points(ml.GRIDS["logistic"], 8)
    assert len(points) == 6 and all(p in ml.grid_points(ml.GRIDS["logistic"]) for p in points)
    df = spark.range(120).select("id", (F.col("id") % 2).cast("string").alias("target"), (F.col("id") % 2 + F.rand(1)).alias("a"), F.rand(2).alias("b"))
    frame = features.stratified_folds(ml.training_frame(df, ["a", "b"], "target", "id"), "label", "id", 3)
    found = ml.search(frame, lambda train, **p: ml.logistic(train.count(), maxIter=20, **p), [{"C": 0.001}, {"C": 10.0}], range(3)).toPandas()
    assert sorted(found["rank"]) == [1, 2] and found.sort_values("rank")["mean"].is_monotonic_decreasing
