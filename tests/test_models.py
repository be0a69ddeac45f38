import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidedock import schemas
from tidedock.operators import boosting, crew, features, metrics, models, split
from tidedock.plans.training import train_and_compare
from tidedock.sources import tables
from tidedock.staging import stage


@pytest.fixture(scope="module")
def splits(spark):
    from times import START
    import datetime as dt

    rng = np.random.default_rng(11)
    rows = []
    for sid in "abcd":
        level = 10.0
        for i in range(260):
            level = float(np.clip(level + rng.normal(0, 1), 0, 20))
            rows.append((sid, START + dt.timedelta(minutes=15 * i), level, 20 - level, 20, -23.5 - ord(sid) / 1e3, -46.6))
    df = spark.createDataFrame(rows, "station_id string, timestamp timestamp_ntz, num_bikes_available double,"
                                     " num_docks_available double, capacity int, lat double, lon double")
    return split.time_based_split(stage(features.feature_frame(features.build_features(df)), "t"))


def _part(splits, name):
    return splits.where(F.col("split") == name)


def _mae(df):
    return metrics.regression_metrics(df, "y", "prediction").first().mae


def test_naive_is_lag_one(splits):
    out = models.score(models.NaiveBaseline().fit(splits), splits)
    assert out.where("prediction != bikes_lag_1").count() == 0


def test_linear_beats_naive(splits):
    test = _part(splits, "test")
    model = models.fit_linear(_part(splits, "train"))
    assert _mae(models.score(model, test)) < _mae(models.score(models.NaiveBaseline(), test))
    ranking = models.linear_attribution(model, test).collect()
    assert len(ranking) == 15 and ranking[0].mean_abs_contribution > 0


def test_boosted_models_and_importance(splits, tmp_path):
    train, val, test = (_part(splits, s) for s in ("train", "val", "test"))
    model = models.fit_boosted(train, val, "lgbm", maxIter=5, stepSize=0.3)
    scored = models.score(model, test)
    assert scored.agg(F.count_distinct("prediction")).first()[0] > 1
    gain = models.feature_importance(model).collect()
    assert len(gain) == 15 and gain == sorted(gain, key=lambda r: (-r.importance, r.feature))
    counts = models.split_counts(model).collect()
    assert len(counts) == 15 and counts[0].importance >= 1
    models.score_saved  # loading is covered below
    from tidedock.sources.writers import save_model

    save_model(model, str(tmp_path / "m"))
    again = models.score_saved(test.sparkSession, str(tmp_path / "m"), test)
    assert _mae(again) == pytest.approx(_mae(scored))


def test_boosting_has_the_rounds_of_the_source_and_ends_by_patience(splits):
    assert all(p["maxIter"] == 1000 and p["stepSize"] == 0.05 for p in models.PRESETS.values()) and models.PATIENCE == 50
    train, val = _part(splits, "train"), _part(splits, "val")
    model = models.fit_boosted(train, val, maxIter=60, maxDepth=2, patience=6, stepSize=0.5)
    best = boosting.best_round(model.errors, 6)
    assert len(model.trees) == best and len(model.errors) < 60
    assert model.errors[best - 1] == pytest.approx(_mae(models.score(model, val)))
    assert min(model.errors[:best]) == model.errors[best - 1] < model.errors[0]


def test_a_continued_fit_has_the_trees_of_one_fit(spark, splits, tmp_path, monkeypatch):
    train, val = _part(splits, "train"), _part(splits, "val")
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 200)
    options = {"maxDepth": 3, "stepSize": 0.3, "subsamplingRate": 0.7, "columnShare": 0.6, "regLambda": 1.0, "regAlpha": 0.1}
    whole = models.fit_boosted(train, val, patience=50, maxIter=11, **options)
    monkeypatch.setattr(boosting, "SAVE_EVERY", 4)
    path = str(tmp_path / "state")
    grown = []
    grow = boosting.grow

    def stops(blocks, trees, *rest):
        if len(trees) == 6 and not grown.count("stopped"):
            grown.append("stopped")
            raise RuntimeError("lost")
        grown.append(len(trees))
        return grow(blocks, trees, *rest)

    monkeypatch.setattr(boosting, "grow", stops)
    with pytest.raises(RuntimeError):
        models.fit_boosted(train, val, patience=50, maxIter=11, path=path, **options)
    monkeypatch.setattr(boosting, "_kept", type(boosting._kept)())
    again = models.fit_boosted(train, val, patience=50, maxIter=11, path=path, **options)
    assert grown == [0, 1, 2, 3, 4, 5, "stopped", 4, 5, 6, 7, 8, 9, 10]
    assert len(again.trees) == len(whole.trees)
    for x, y in zip(again.trees, whole.trees):
        assert x.feature.tolist() == y.feature.tolist() and x.bin.tolist() == y.bin.tolist() and x.n.tolist() == y.n.tolist()
        assert np.allclose(x.value, y.value)
    assert _mae(models.score(again, val)) == pytest.approx(_mae(models.score(whole, val)))


def test_one_round_splits_where_brute_force_does(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 9, (300, 15)).astype(float)
    y = np.where(x[:, 4] > 5, 7.0, 1.0) + np.where(x[:, 2] > 3, 2.0, 0.0) + rng.normal(0, 0.1, 300)
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], [*schemas.FEATURE_COLS, "y"])
    model = models.fit_boosted(df, None, maxIter=1, maxDepth=1, stepSize=1.0, minInstancesPerNode=1)
    best = min(
        ((np.var(y[x[:, f] <= c]) * (x[:, f] <= c).sum() + np.var(y[x[:, f] > c]) * (x[:, f] > c).sum(), f, c) for f in range(15) for c in range(8)),
    )
    tree = model.trees[0]
    assert (tree.feature[0], tree.cut[0]) == best[1:]
    assert model.base + tree.value[1] == pytest.approx(y[x[:, best[1]] <= best[2]].mean())
    assert tree.gain[0] == pytest.approx(np.var(y) * 300 - best[0])


def test_path_contributions_add_up_to_the_prediction(splits):
    model = models.fit_boosted(_part(splits, "train"), None, maxIter=8, maxDepth=3, stepSize=0.3)
    rows = model.contributions(model.transform(_part(splits, "test"))).collect()
    assert rows and all(r.base + sum(r.contributions) == pytest.approx(r.prediction) for r in rows)
    ranking = models.tree_attribution(model, _part(splits, "test")).collect()
    assert len(ranking) == 15 and ranking[0].mean_abs_contribution > 0
    gain = {r.feature: r.importance for r in models.feature_importance(model).collect()}
    nodes = model.nodes(splits.sparkSession).where("feature >= 0").groupBy("feature").agg(F.sum("gain").alias("g")).collect()
    assert {model.features[r.feature]: pytest.approx(r.g) for r in nodes} == {k: v for k, v in gain.items() if v}


def test_a_pass_adds_up_the_smaller_siblings_in_at_most_one_task_a_core(spark, splits, monkeypatch):
    train = _part(splits, "train").repartition(9)
    passes, total = [], boosting.Blocks.total

    def watched(blocks, work, trees):
        passes.append((blocks.rdd.getNumPartitions(), total(blocks, work, trees)))
        return passes[-1][1]

    monkeypatch.setattr(boosting.Blocks, "total", watched)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 50)
    model = models.fit_boosted(train, None, maxIter=1, maxDepth=4, minInstancesPerNode=5)
    counted = [int(sums[0, :, 0].sum()) for _, sums in passes]
    rows = train.select(*schemas.FEATURE_COLS, "y").toPandas().astype(float)
    assert counted[0] == len(rows) and len(counted) == 4 and all(n <= len(rows) / 2 for n in counted[1:])
    assert all(tasks <= spark.sparkContext.defaultParallelism for tasks, _ in passes)
    tree, x = model.trees[0], rows[schemas.FEATURE_COLS].to_numpy().T
    at = tree.of_values(np.ascontiguousarray(x))
    for leaf in np.flatnonzero(tree.feature < 0):
        assert (at == leaf).sum() == tree.n[leaf]
        assert tree.value[leaf] == pytest.approx(0.05 * (rows["y"][at == leaf] - model.base).mean())


def test_rounds_cost_jobs_per_written_state_and_not_per_level(spark, splits):
    train = _part(splits, "train")
    spark.sparkContext.setJobGroup("rounds", "rounds")
    model = models.fit_boosted(train, None, "xgb", maxIter=40)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("rounds")
    spark.sparkContext.setJobGroup("", "")
    assert len(model.trees) == 40 and 0 < len(jobs) < 40


def test_rounds_of_one_task_are_those_of_passes(splits, monkeypatch):
    train, val, test = (_part(splits, s) for s in ("train", "val", "test"))
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 200)
    monkeypatch.setattr(boosting, "SAVE_EVERY", 4)
    options = {"maxIter": 7, "maxDepth": 3, "stepSize": 0.3, "subsamplingRate": 0.7, "columnShare": 0.6, "regLambda": 1.0}
    ahead = models.fit_boosted(train, val, **options)
    monkeypatch.setattr(boosting, "HELD_ROWS", 0)
    passes = models.fit_boosted(train, val, **options)
    assert len(ahead.trees) == len(passes.trees) and np.allclose(ahead.errors, passes.errors)
    for x, y in zip(ahead.trees, passes.trees):
        assert x.feature.tolist() == y.feature.tolist() and x.bin.tolist() == y.bin.tolist() and x.n.tolist() == y.n.tolist()
        assert np.allclose(x.value, y.value)
    assert _mae(models.score(ahead, test)) == pytest.approx(_mae(models.score(passes, test)))


def test_one_task_goes_on_from_what_passes_have_written(splits, tmp_path, monkeypatch):
    train, val = _part(splits, "train"), _part(splits, "val")
    monkeypatch.setattr(boosting, "SAVE_EVERY", 3)
    path, options = str(tmp_path / "state"), {"maxDepth": 2, "stepSize": 0.3}
    whole = models.fit_boosted(train, val, maxIter=8, **options)
    monkeypatch.setattr(boosting, "HELD_ROWS", 0)
    models.fit_boosted(train, val, maxIter=4, path=path, **options)
    monkeypatch.undo()
    again = models.fit_boosted(train, val, maxIter=8, path=path, **options)
    assert np.allclose(again.errors, whole.errors) and len(again.errors) == 8
    assert [t.feature.tolist() for t in again.trees] == [t.feature.tolist() for t in whole.trees]


@pytest.mark.parametrize("row_share", [1.0, 0.6])
def test_processes_of_a_crew_add_up_what_brute_force_does(row_share):
    rng, widths = np.random.default_rng(5), [3, 60, 1, 200, 9]
    sizes = [9_000, 1, 30_000, 12_345]
    blocks = [
        (i, np.array([rng.integers(0, w, n) for w in widths], np.uint8), rng.normal(size=n), rng.normal(size=n))
        for i, n in enumerate(sizes)
    ]
    chosen = [np.random.default_rng([42, 7, i]).random(n) < row_share for i, n in enumerate(sizes)]
    team = crew.Crew(blocks, blocks[:1], widths, 200, 4, 3, row_share, 42)
    children = list(team.children)
    assert team.size == 3 and len(children) == 2
    splits = [(0, 1, 20, 1, 2), (2, 3, 77, 3, 4)]

    def node(bins):
        return np.where(bins[1] <= 20, 1, np.where(bins[3] <= 77, 3, 4))

    def expected(asked):
        out = np.zeros((2, len(asked), 5, 200))
        for (_, bins, y, f), taken in zip(blocks, chosen):
            for k, at in enumerate(asked):
                here = (taken if at == 0 else taken & (node(bins) == at))
                for feature, column in enumerate(bins):
                    np.add.at(out[0, k, feature], column[here], 1)
                    np.add.at(out[1, k, feature], column[here], (y - f)[here])
        return out

    assert np.allclose(team.level(7, [], [0]), expected([0]))
    assert np.allclose(team.level(7, splits, [3, 1]), expected([3, 1]))
    value = np.array([0, 0.5, 0, -1.0, 2.0])
    error = team.finish([], splits, {1: 0.5, 3: -1.0, 4: 2.0})
    assert error == pytest.approx(np.abs(blocks[0][2] - blocks[0][3] - value[node(blocks[0][1])]).sum())
    after = {(held, b[0]): f.copy() for held, b, f in team.predictions()}
    assert len(after) == 5 and all(np.allclose(after[False, b[0]], b[3] + value[node(b[1])]) for b in blocks)
    team.close()
    for child in children:
        with pytest.raises(ProcessLookupError):
            os.kill(child, 0)


def test_packs_hold_every_feature_once_within_their_cells():
    widths = [32, 33, 32, 32, 57, 36, 25, 8, 3, 2, 11, 256]
    found = crew.packs(widths, 1_000)
    assert sorted(sum(found, [])) == list(range(12)) and len(found) < 12
    assert all(np.prod([widths[f] for f in members]) <= 1_000 for members in found)


def test_missing_values_go_right_when_scored(spark):
    rows = [(float(i % 10), float(i % 10 > 4)) for i in range(100)]
    df = spark.createDataFrame(rows, "x double, y double").select(*[F.col("x").alias(c) for c in schemas.FEATURE_COLS], "y")
    model = models.fit_boosted(df, None, maxIter=3, maxDepth=2, minInstancesPerNode=1)
    gone = df.limit(1).select(*[F.lit(None).cast("double").alias(c) for c in schemas.FEATURE_COLS], "y")
    high = df.where("bikes_lag_1 = 9").limit(1)
    assert models.score(model, gone).first().prediction == pytest.approx(models.score(model, high).first().prediction)


def test_boosting_without_rows(splits):
    none = _part(splits, "train").limit(0)
    model = models.fit_boosted(none, none, maxIter=2)
    assert {r.prediction for r in models.score(model, _part(splits, "val")).collect()} == {0.0}


def test_permutation_importance_ranks_current_value_first(splits):
    model = models.fit_linear(_part(splits, "train"))
    rows = models.permutation_importance(model, _part(splits, "test"), block_rows=50).collect()
    assert len(rows) == 15 and rows[0].feature in ("num_bikes_available", "num_docks_available")
    assert {r.feature: r.mae_increase for r in rows}["month"] == pytest.approx(0.0, abs=1e-9)


def test_search_is_seeded_and_sorted(splits):
    a, b = models.sample_params(random.Random(1)), models.sample_params(random.Random(1))
    assert a == b and 3 <= models.boosting_params(a)["maxDepth"] <= 12 and len(a) == 8
    trials = models.tune_boosted(_part(splits, "train"), _part(splits, "val"), n_trials=2, max_iter=2).collect()
    assert [t.mae for t in trials] == sorted(t.mae for t in trials) and len(trials) == 2


def test_train_and_compare_writes_artefacts(spark, splits, tmp_path):
    out = train_and_compare(splits, str(tmp_path / "run"), max_iter=2)
    rows = {r.model: r for r in metrics.model_improvement(out).collect()}
    assert set(rows) == {"naive", "linear_regression", "lgbm", "xgb"}
    assert rows["naive"].improvement_pct == 0.0 and rows["linear_regression"].improvement_pct > 0
    assert tables.read_metrics(spark, str(tmp_path / "run/metrics")).count() == 4
    assert tables.read_feature_importance(spark, str(tmp_path / "run/importance")).count() == 15


def test_predict_latest_marks_unknown(spark, splits):
    asked = spark.createDataFrame([("a",), ("a",), ("nope",)], "station_id string")
    as_of = F.lit("2026-03-05 00:00:00").cast("timestamp_ntz")
    rows = {r.station_id: r for r in models.predict_latest(models.NaiveBaseline(), splits, asked, as_of, "naive").collect()}
    assert rows["nope"].known is False and rows["a"].known is True and len(rows) == 2
    last = splits.where("station_id = 'a'").orderBy(F.col("timestamp").desc()).first()
    assert rows["a"].predicted_bikes == pytest.approx(round(last.bikes_lag_1, 2))
    assert str(rows["a"].target_time) == "2026-03-05 00:15:00"


def test_extreme_stations(splits):
    per = metrics.metrics_by_station(models.score(models.NaiveBaseline(), splits))
    hard = metrics.extreme_stations(per, 2).collect()
    easy = metrics.extreme_stations(per, 2, hardest=False).collect()
    assert hard[0].mae >= hard[1].mae >= easy[1].mae >= easy[0].mae
    assert schemas.TARGET_COL == "y"
