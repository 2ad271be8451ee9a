"""Folds, scores and models against plain numpy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from airpanel.models import evaluate, explain, linear, trees
from airpanel.plans import training
from airpanel.schemas import HOUR, HOURLY_FEATURES, SERIES

NAMES = ["x0", "x1", "x2"]


def counted(spark, n):
    return spark.range(n).select(
        F.lit("a").alias(SERIES), F.lit(1).alias("horizon"), F.col("id").alias(HOUR))


def design(spark, n=400, seed=0, noise=0.5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1, 5, 0.2] + [0, 100, -3]
    x[:, 2] = 0.1 * x[:, 0] + 0.05 * x[:, 2]
    y = x @ [2.0, -0.3, 1.0] + noise * rng.normal(size=n)
    rows = [("a", 1, i, *map(float, x[i]), float(y[i]), 50.0, 50.0 + float(y[i])) for i in range(n)]
    df = spark.createDataFrame(
        rows, f"{SERIES} STRING, horizon INT, {HOUR} BIGINT, x0 DOUBLE, x1 DOUBLE, x2 DOUBLE, "
              "delta DOUBLE, aqi DOUBLE, target DOUBLE")
    return df, x, y


def splits(n, k):
    """Expanding splits: (training size, test size) of each fold."""
    step = n // (k + 1)
    return [(n - (k - f) * step, step) for f in range(k)]


@pytest.mark.parametrize(("n", "k", "first", "step"), [(283, 5, 48, 47), (8637, 4, 1729, 1727)])
def test_fold_sizes(spark, n, k, first, step):
    folded = evaluate.expanding_folds(counted(spark, n), k, 60)
    sizes = {r.block: r["count"] for r in folded.groupBy("block").count().collect()}
    assert sizes == {0: first, **{b: step for b in range(1, k + 1)}}
    scored = {r.block for r in folded.filter("is_scored").select("block").distinct().collect()}
    assert scored == {b for b in range(1, k + 1) if first + (b - 1) * step >= 60}


def test_too_short_series_are_not_scored(spark):
    assert evaluate.expanding_folds(counted(spark, 119), 5, 60).filter("is_scored").count() == 0


@pytest.mark.parametrize(("x", "y", "k"), [([1.0, 2.0], [2.0, 4.0], 2.0), ([0.0, 0.0], [2.0, 4.0], 0.0)])
def test_reversion_k(spark, x, y, k):
    rows = [("a", 1, 0, -a, b) for a, b in zip(x, y, strict=True)]
    df = spark.createDataFrame(rows, f"{SERIES} STRING, horizon INT, block INT, dev DOUBLE, delta DOUBLE")
    assert evaluate.fit_reversion_k(df, "dev").filter("fold = 0").first().k == k


@pytest.mark.parametrize("purge", [False, True])
def test_window_k_equals_grouped_k(spark, purge):
    df, _, _ = design(spark, 200)
    folded = evaluate.expanding_folds(df, 4, 20, purge=purge)
    grouped = {r.fold: r.k for r in evaluate.fit_reversion_k(folded, "x0").collect() if r.fold}
    attached = {r.block: r.k for r in evaluate.with_reversion_k(folded, "x0")
                .filter("block > 0").select("block", "k").distinct().collect()}
    assert attached == pytest.approx(grouped)


def closed_ridge(x, y, alpha):
    mean, scale = x.mean(0), x.std(0)
    z = (x - mean) / scale
    w = np.linalg.solve(z.T @ z + alpha * np.eye(z.shape[1]), z.T @ (y - y.mean()))
    return w / scale, y.mean() - (w / scale) @ mean


def searched_alpha(x, y, n_splits):
    mean, scale = x.mean(0), x.std(0)
    z = (x - mean) / scale
    scores = []
    for n_train, n_test in splits(len(y), n_splits):
        zt, yt = z[:n_train], y[:n_train]
        zv, yv = z[n_train:n_train + n_test], y[n_train:n_train + n_test]
        own = []
        for alpha in linear.RIDGE_ALPHAS:
            c = zt - zt.mean(0)
            w = np.linalg.solve(c.T @ c + alpha * np.eye(3), c.T @ (yt - yt.mean()))
            p = yt.mean() + (zv - zt.mean(0)) @ w
            own.append(1 - ((yv - p) ** 2).sum() / ((yv - yv.mean()) ** 2).sum())
        scores.append(own)
    return linear.RIDGE_ALPHAS[int(np.argmax(np.mean(scores, axis=0)))]


@pytest.mark.parametrize("k", [4, 8, 12])
def test_ridge_equals_the_closed_form_in_every_fold(spark, k):
    df, x, y = design(spark, 400 if k == 4 else 900)
    fits = {r.fold: r for r in linear.fit_linear(
        df, k, 50, NAMES, ("ridge",), rows_per_split=40).collect()}
    sizes = {0: len(y), **{f + 1: n for f, (n, _) in enumerate(splits(len(y), k))}}
    assert set(fits) == set(sizes)
    for fold, n in sizes.items():
        alpha = searched_alpha(x[:n], y[:n], max(3, min(5, n // 40)))
        weights, intercept = closed_ridge(x[:n], y[:n], alpha)
        assert fits[fold].alpha == pytest.approx(alpha) and fits[fold].n_train == n
        assert fits[fold].weights == pytest.approx(weights, rel=1e-6)
        assert fits[fold].intercept == pytest.approx(intercept, rel=1e-6)


def test_elastic_net_meets_its_optimality_conditions(spark):
    df, x, y = design(spark, noise=2.0)
    fit = linear.fit_linear(df, 4, 50, NAMES, ("elastic_net",)).filter("fold = 0").first()
    z = (x - x.mean(0)) / x.std(0)
    w = np.array(fit.standardised)
    gradient = z.T @ (z @ w - (y - y.mean())) / len(y) + fit.alpha * (1 - fit.l1_ratio) * w
    limit = fit.alpha * fit.l1_ratio
    slack = 0.02 * max(limit, np.abs(z.T @ (y - y.mean())).max() / len(y) * 0.1)
    for g, b in zip(gradient, w, strict=True):
        assert abs(g + np.sign(b) * limit) <= slack if b else abs(g) <= limit + slack


def test_linear_scores_equal_numpy(spark):
    df, x, y = design(spark)
    fits = linear.fit_linear(df, 4, 50, NAMES, ("ridge",))
    got = {r.fold: r for r in training.linear_scores(
        df, fits, 4, 50, NAMES, ("ridge",), HOUR, ["ridge"]).collect()}
    own = {r.fold: r for r in fits.collect()}
    for f, (n, test) in enumerate(splits(len(y), 4), 1):
        p = x[n:n + test] @ np.array(own[f].weights) + own[f].intercept
        t = y[n:n + test]
        assert got[f].rmse == pytest.approx(np.sqrt(((t - p) ** 2).mean()))
        assert got[f].mae == pytest.approx(np.abs(t - p).mean())
        assert got[f].delta_r2 == pytest.approx(1 - ((t - p) ** 2).sum() / ((t - t.mean()) ** 2).sum())


def test_shuffled_targets_carry_no_signal(spark):
    df, _, y = design(spark, 1500)
    mixed = evaluate.shuffled_targets(df)
    assert sorted(r.delta for r in mixed.select("delta").collect()) == pytest.approx(sorted(y))
    fits = linear.fit_linear(mixed, 4, 50, NAMES, ("ridge",))
    r2 = evaluate.fold_summary(training.linear_scores(
        mixed, fits, 4, 50, NAMES, ("ridge",), HOUR, ["ridge"])).first().delta_r2
    assert abs(r2) < 0.05


def test_winner_ties_go_to_the_earlier_candidate(spark):
    df = spark.createDataFrame(
        [("a", 1, "x", 2, 1.0), ("a", 1, "persistence", 0, 2.0), ("a", 1, "y", 1, 1.0)],
        f"{SERIES} STRING, horizon INT, model STRING, model_order INT, rmse DOUBLE")
    assert evaluate.pick_winner(df).first().model == "y"
    skill = evaluate.skill_table(df).first()
    assert (skill.model, skill.baseline_rmse, skill.gain) == ("y", 2.0, 50.0)
    marked = evaluate.select_models(df, mark=True)
    assert {r.model for r in marked.collect()} == {"x", "y", "persistence", "WINNER:y"}


def test_linear_attribution_sums_to_the_prediction(spark):
    df, x, y = design(spark, 100)
    fit = linear.fit_linear(df, 4, 10, NAMES, ("ridge",)).filter("fold = 0")
    attributions = explain.linear_attribution(df, fit, NAMES)
    total = attributions.agg(F.sum("attribution")).first()[0]
    assert total == pytest.approx(0.0, abs=1e-6)
    linearity = {r.feature: r.r2 for r in explain.response_linearity(attributions).collect()}
    assert all(v == pytest.approx(1.0) for v in linearity.values())


def numpy_tree(x, y, depth, min_leaf, l2):
    """Exhaustive greedy tree: predictions on x, by recursion."""
    if depth == 0 or len(y) < 2 * min_leaf:
        return np.full(len(y), y.sum() / (len(y) + l2))
    best, cut = 1e-12, None
    for j in range(x.shape[1]):
        for t in np.unique(x[:, j])[:-1]:
            left = x[:, j] <= t
            n, s = left.sum(), y[left].sum()
            if n < min_leaf or len(y) - n < min_leaf:
                continue
            gain = s**2 / (n + l2) + (y.sum() - s)**2 / (len(y) - n + l2) - y.sum()**2 / (len(y) + l2)
            if gain > best + 1e-9:
                best, cut = gain, left
    if cut is None:
        return np.full(len(y), y.sum() / (len(y) + l2))
    out = np.empty(len(y))
    for side in (cut, ~cut):
        out[side] = numpy_tree(x[side], y[side], depth - 1, min_leaf, l2)
    return out


def boosted(df, spec, folds=(0,), k=4, **options):
    folded = evaluate.expanding_folds(df, k, 50)
    return folded, trees.fit_trees(folded, NAMES, {"b": spec}, folds, 50, **options)


def test_boosting_equals_recursive_trees(spark):
    df, x, y = design(spark, 200, noise=1.0)
    spec = trees.Boosting(rounds=5, step=0.3, depth=3, min_leaf=7, held=0.0, leaves=100)
    _, models = boosted(df, spec)
    row = models.first()
    assert (row.rounds, len(row.roots), row.n_train) == (5, 5, 200)
    wanted = np.full(len(y), y.mean())
    for _ in range(5):
        wanted += 0.3 * numpy_tree(x, y - wanted, 3, 7, 1.0)
    got = trees.predict_trees(df.withColumn("fold", F.lit(0)), models, NAMES, ["b", "absent"], keep=[HOUR])
    rows = {r[HOUR]: r for r in got.collect()}
    assert [rows[i].b for i in range(200)] == pytest.approx(wanted.tolist(), abs=1e-9)
    assert all(r.absent is None for r in rows.values())


def test_both_split_searches_agree():
    rng = np.random.default_rng(3)
    for _ in range(60):
        n = int(rng.integers(30, 300))
        x, y = np.round(rng.normal(size=(n, 5)), int(rng.integers(0, 3))), rng.normal(size=n)
        weight = rng.integers(0, 3, n).astype(float)
        node = np.where(weight > 0, rng.integers(0, 3, n), -1)
        given = (trees._Binned(x, np.ones(n, bool)), node, weight, weight * y, 3, 4, 1.0, rng.random((3, 5)) < 0.8)
        a, b = trees._best_by_bins(*given), trees._best_by_rows(*given)
        assert a[0] == pytest.approx(b[0]) and a[5] == pytest.approx(b[5]) and a[6] == pytest.approx(b[6])


def test_boosting_stops_by_itself_and_is_cut_at_the_best_round(spark):
    df, x, y = design(spark, 600, noise=3.0)
    spec = trees.Boosting(rounds=500, patience=10)
    _, models = boosted(df, spec)
    row = models.first()
    assert row.rounds < 500 and len(row.roots) == row.rounds - 10
    n_held = int(0.15 * 600)
    walker = trees._Walker(row.asDict())
    errors = []
    for n in range(1, len(row.roots) + 1):
        walker.roots = np.array(row.roots[:n], np.int64)
        errors.append(((walker.predict(x[-n_held:]) - y[-n_held:]) ** 2).mean())
    assert int(np.argmin(errors)) == len(row.roots) - 1
    assert ((walker.predict(x) - y) ** 2).mean() < 0.6 * y.var()


@pytest.mark.parametrize("spread", [False, True])
def test_each_fold_is_fitted_on_the_blocks_before_it(spark, spread):
    df, x, y = design(spark, 400)
    _, models = boosted(df, trees.Boosting(rounds=3, held=0.0), range(5), spread=spread)
    got = {r.fold: r for r in models.collect()}
    sizes = {0: 400, **{f + 1: n for f, (n, _) in enumerate(splits(400, 4))}}
    assert {f: r.n_train for f, r in got.items()} == sizes
    for fold, n in sizes.items():
        assert got[fold].base == pytest.approx(y[:n].mean())


def test_residual_boosting_starts_from_the_linear_fit(spark):
    df, x, y = design(spark, 400)
    fits = linear.fit_linear(df, 4, 50, NAMES, ("ridge",))
    own = fits.filter("fold = 0").first()
    spec = trees.Boosting(rounds=4, held=0.0, on="ridge")
    _, models = boosted(df, spec, linear=fits)
    left = y - (x @ np.array(own.weights) + own.intercept)
    assert models.first().base == pytest.approx(left.mean(), abs=1e-9)
    with pytest.raises(ValueError):
        boosted(df, spec)


def test_forest_repeats_itself_and_fits(spark):
    df, x, y = design(spark, 300, noise=0.2)
    folded = evaluate.expanding_folds(df, 4, 50)
    spec = {"f": trees.Forest(trees=30)}
    one, two = (trees.fit_trees(folded, NAMES, spec, [0], 50).first() for _ in range(2))
    assert one == two and len(one.roots) == 30
    assert ((trees._Walker(one.asDict()).predict(x) - y) ** 2).mean() < 0.2 * y.var()


def test_tree_contributions_add_up_and_follow_the_features(spark):
    df, x, y = design(spark, 500, noise=0.2)
    _, models = boosted(df, trees.Boosting(rounds=60))
    rows = df.withColumn("fold", F.lit(0))
    parts = {r[HOUR]: r for r in trees.tree_contributions(rows, models, NAMES).collect()}
    whole = trees._Walker(models.first().asDict()).predict(x)
    assert [parts[i].base + sum(parts[i].contributions) for i in range(500)] == pytest.approx(whole.tolist(), abs=1e-9)
    long = explain.tree_attribution(rows, models, NAMES)
    size = {r.feature: r.mean_abs for r in explain.mean_abs_attribution(long).collect()}
    assert long.count() == 1500 and size["x0"] + size["x2"] > size["x1"] > 0
    importance = {r.feature: r.increase for r in explain.permutation_importance(models, rows, NAMES, "b").collect()}
    assert min(importance.values()) > 0 and importance["x0"] + importance["x2"] > importance["x1"]
    nodes = trees.nodes(models)
    assert nodes.filter("feature >= 0").count() * 2 + len(models.first().roots) == nodes.count()


def test_long_cells_are_predicted_in_chunks(spark, monkeypatch):
    df, x, _ = design(spark, 300)
    _, models = boosted(df, trees.Boosting(rounds=10))
    rows = df.withColumn("fold", F.lit(0))
    whole = {r[HOUR]: r.b for r in trees.predict_trees(rows, models, NAMES, ["b"], keep=[HOUR]).collect()}
    monkeypatch.setattr(trees, "ROWS_AT_ONCE", 7)
    assert whole == {r[HOUR]: r.b for r in trees.predict_trees(rows, models, NAMES, ["b"], keep=[HOUR]).collect()}


def test_certificates_hold_for_optima_only(spark):
    df, _, _ = design(spark, noise=2.0)
    folded = evaluate.expanding_folds(df, 4, 50)
    fits = linear.fit_folds(folded, 4, 50, NAMES)
    assert {r.holds for r in linear.certificate(folded, fits, NAMES).collect()} == {True}
    moved = fits.withColumn("weights", F.transform("weights", lambda w: w * 1.01))
    assert {r.holds for r in linear.certificate(folded, moved, NAMES).collect()} == {False}


def test_skipped_cells_are_named(spark):
    rows = spark.createDataFrame([("a", 1, i) for i in range(120)] + [("b", 1, i) for i in range(119)],
                                 f"{SERIES} STRING, horizon INT, {HOUR} BIGINT")
    features = spark.createDataFrame([("a",), ("b",), ("c",)], f"{SERIES} STRING")
    got = {(r[SERIES], r.horizon, r.reason) for r in evaluate.skipped_cells(features, rows, [1, 2], 5, 60).collect()}
    few = lambda n: f"only {n} usable rows"
    assert got == {("a", 2, few(0)), ("b", 1, few(119)), ("b", 2, few(0)), ("c", 1, few(0)), ("c", 2, few(0))}
    assert {r.reason for r in evaluate.skipped_cells(features, rows, [1], 200, 60).collect()} >= {"no fold has enough training rows"}


def panel_design(spark):
    """Three series of one horizon pair; a step function that only trees can learn in one of them."""
    rng = np.random.default_rng(5)
    rows = []
    for series in ("line", "step"):
        for horizon in (1, 3):
            for i in range(400):
                f = {c: float(rng.normal()) for c in HOURLY_FEATURES}
                f["aqi"] = 50.0
                signal = 10 * f["o3"] if series == "line" else 20.0 * ((f["o3"] > 0) ^ (f["no2"] > 0))
                delta = signal + float(rng.normal())
                rows.append((series, horizon, i, *f.values(), delta, 50.0 + delta))
    names = ", ".join(f"{c} DOUBLE" for c in HOURLY_FEATURES)
    return spark.createDataFrame(rows, f"{SERIES} STRING, horizon INT, {HOUR} BIGINT, {names}, delta DOUBLE, target DOUBLE")


def test_trees_compete_win_and_are_served_from_the_registry(spark, tmp_path):
    from airpanel.plans import serving
    from airpanel.sources import store

    data = panel_design(spark)
    config = training.HourlyConfig(min_train=50)
    panel = training.evaluate_panel(data, 4, 50, config.linear_models, config.tree_models)
    summary = evaluate.fold_summary(panel.scores)
    counts = {(r[SERIES], r.horizon): r["count"] for r in summary.groupBy(SERIES, "horizon").count().collect()}
    assert counts == {(s, h): 8 for s in ("line", "step") for h in (1, 3)}
    winners = {r[SERIES]: r.model for r in evaluate.pick_winner(summary).collect()}
    assert winners["line"] in ("ridge", "elastic_net", "boosted_residual") and winners["step"] in ("hist_gbr", "boosted_residual")
    models = training.final_models(panel, 50, config.tree_models)
    version = store.register_models(models, evaluate.registry_metrics(summary), str(tmp_path))
    registered = store.read_registry(spark, str(tmp_path), version)
    latest = (data.filter("horizon = 1").groupBy(SERIES).agg(F.max_by(F.struct(HOUR, *HOURLY_FEATURES), HOUR).alias("r"))
              .select(SERIES, "r.*").withColumn("ts", F.timestamp_seconds(F.lit(0))))
    points = {(r[SERIES], r.horizon): r.aqi for r in serving.forecast(latest, registered, evaluate.skill_table(summary)).collect()}
    assert set(points) == set(counts)
    # By hand: what the stored parameters say about the newest rows.
    now = {r[SERIES]: np.array([float(r[c]) for c in HOURLY_FEATURES]) for r in latest.collect()}
    for r in registered.collect():
        value = trees._Walker(r.trees.asDict()).predict(now[r[SERIES]][None])[0] if r.trees else 0.0
        line = now[r[SERIES]] @ np.array(r.weights) + r.intercept if r.weights else 0.0
        wanted = {"ensemble": (value + line) / 2}.get(r.model, value + line)
        assert points[r[SERIES], r.horizon] == pytest.approx(min(500.0, max(0.0, 50.0 + wanted)))


def test_every_kind_of_winner_is_served(spark):
    from airpanel.plans import serving

    _, fits = boosted(design(spark, 200)[0], trees.Boosting(rounds=3))
    packed = fits.select(F.struct(*trees.PACKED_FIELDS).alias("trees"))
    now = {"aqi": 50.0, "aqi_lag24": 40.0, "aqi_minus_roll24": 5.0, **{c: 1.0 for c in NAMES}}
    names = [*NAMES, "aqi_lag24", "aqi_minus_roll24"]
    kinds = ["persistence", "diurnal_naive", "damped_reversion", "ridge", "elastic_net", "hist_gbr", "boosted_residual", "ensemble"]
    models = spark.createDataFrame([("a", h, m) for h, m in enumerate(kinds)], f"{SERIES} STRING, horizon INT, model STRING")
    own = F.col("model").isin("hist_gbr", "boosted_residual", "ensemble")
    models = models.crossJoin(packed).select(
        "*", F.lit(0.5).alias("k"), F.lit(2.0).alias("intercept"), F.array(*[F.lit(1.0)] * 5).alias("weights")).withColumn(
        "trees", F.when(own, F.col("trees")))
    latest = spark.createDataFrame([("a",)], f"{SERIES} STRING").select(
        SERIES, F.timestamp_seconds(F.lit(0)).alias("ts"), *[F.lit(v).alias(c) for c, v in now.items()])
    skill = models.select(SERIES, "horizon", F.lit(1.0).alias("rmse"), F.lit(1.0).alias("gain"), "model")
    got = {r.model: r.aqi - 50 for r in serving.forecast(latest, models, skill, names).collect()}
    # Models that were never stored, and models without any tree.
    bare = serving.forecast(latest, models.drop("trees").filter("model IN ('ridge', 'persistence')"), skill, names)
    assert {r.model for r in bare.collect()} == {"ridge", "persistence"}
    tree = trees._Walker(fits.first().asDict()).predict(np.array([[1.0, 1.0, 1.0, 40.0, 5.0]]))[0]
    line = 2.0 + 3.0 + 45.0
    assert got == pytest.approx({
        "persistence": 0.0, "diurnal_naive": -10.0, "damped_reversion": -2.5, "ridge": line, "elastic_net": line,
        "hist_gbr": tree, "boosted_residual": line + tree, "ensemble": (line + tree) / 2})
