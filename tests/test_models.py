import tracemalloc
from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercata.ml import anomalies, attributions, boosting, clusters, kmeans, models, success
from mercata.plans import analysis as A


def brute_force_shapley(x, nodes):
    """Shapley values by their definition, averaging unknown features over the training shares."""
    used = sorted({n[1] for n in nodes if n[0] == "split"})

    def expect(at, known):
        n = nodes[at]
        if n[0] == "leaf":
            return n[1]
        _, f, cut, left, right, share = n
        if f in known:
            return expect(left if x[f] <= cut else right, known)
        return share * expect(left, known) + (1 - share) * expect(right, known)

    phi = np.zeros(len(x))
    for f in used:
        others = [u for u in used if u != f]
        for k in range(len(others) + 1):
            w = factorial(k) * factorial(len(used) - k - 1) / factorial(len(used))
            for s in combinations(others, k):
                phi[f] += w * (expect(0, {*s, f}) - expect(0, set(s)))
    return phi


def test_attributions_equal_the_definition(monkeypatch):
    # feature 0 splits twice on one path; shares are the part going left
    nodes = [
        ("split", 0, 0.5, 1, 2, 0.6), ("split", 1, 0.3, 3, 4, 0.25), ("split", 2, 0.7, 5, 6, 0.5),
        ("leaf", 1.0), ("split", 0, 0.2, 7, 8, 0.4), ("leaf", -2.0), ("leaf", 0.5), ("leaf", 3.0), ("leaf", -1.0),
    ]
    leaves = []

    def walk(at, path):
        n = nodes[at]
        if n[0] == "leaf":
            leaves.append((n[1], path))
            return
        _, f, cut, left, right, share = n
        s, lo, hi = path.get(f, (1.0, -np.inf, np.inf))
        walk(left, {**path, f: (s * share, lo, min(hi, cut))})
        walk(right, {**path, f: (s * (1 - share), max(lo, cut), hi)})

    walk(0, {})
    rng = np.random.default_rng(0)
    x = rng.random((20, 3))
    monkeypatch.setattr(attributions, "ROWS_AT_ONCE", 7)
    phi, margin = attributions.shapley_batch(x, attributions.leaf_groups([*leaves, (0.25, {})]))
    margin = margin - 0.25
    for row, got, m in zip(x, phi, margin):
        np.testing.assert_allclose(got, brute_force_shapley(row, nodes), atol=1e-12)
        reached = [v for v, p in leaves if all(lo < row[f] <= hi for f, (_, lo, hi) in p.items())]
        assert reached == [pytest.approx(m)]


@pytest.fixture(scope="module")
def products(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(600):
        price, sold = int(rng.integers(100, 20000)), int(rng.integers(0, 500))
        rows.append((
            f"p{i}", "hot" if i % 3 == 0 else f"s{i % 4}", price, int(rng.integers(10, 51)),
            int(rng.integers(0, 200)), sold, price * sold, int(rng.integers(5, 200)), bool(i % 11 == 0),
            *(int(v) for v in rng.integers(0, 2, 4)), None if i % 2 else int(rng.integers(0, 600)), int(i % 5 == 0),
        ))
    return spark.createDataFrame(
        rows,
        "asin string, subcategory string, price_cents long, rating_tenths long, review_count long, "
        "bought_last_month long, revenue_cents long, title_length long, is_best_seller boolean, has_brand int, "
        "has_features int, has_description int, has_store int, discount_tenths long, is_matched int",
    )


@pytest.fixture(scope="module")
def trained(products):
    split = clusters.checkpointed(success.stratified_split(success.success_features(products)))
    return split, success.train_success(split, max_iter=30, max_depth=3, patience=3)


def test_split_is_stratified_and_repeats(trained, products):
    split, _ = trained
    shares = split.groupBy("is_success").agg(F.avg((F.col("fold") == "test").cast("int")).alias("t")).collect()
    assert all(abs(r.t - 0.2) < 0.06 for r in shares)  # drawn row by row
    again = success.stratified_split(success.success_features(products.repartition(5)))
    assert split.select("asin", "fold").exceptAll(again.select("asin", "fold")).count() == 0


def test_model_explanations_add_up(trained):
    split, model = trained
    test = split.where("fold = 'test'")
    explained = attributions.explain(model, test)
    total = sum(F.col(f"shap_{f}") for f in success.FEATURES) + F.col("base_value")
    worst = explained.select(F.max(F.abs(total - F.col("margin"))).alias("e")).first().e
    assert worst < 1e-9
    scored = success.predict(model, test).select("asin", "score")
    gap = explained.join(scored, "asin").agg(F.max(F.abs(F.col("score") - F.col("probability"))).alias("g")).first().g
    assert gap < 1e-9
    summary = {r.feature: r for r in attributions.shap_summary(explained).collect()}
    assert set(summary) == set(success.FEATURES) and all(r.mean_abs_shap >= 0 for r in summary.values())
    assert attributions.waterfall(explained).count() == len(success.FEATURES)


def test_rounds_are_kept_up_to_the_best():
    falling = [1 / (i + 1) for i in range(30)]
    assert success.rounds_to_keep(falling, 5) is None
    assert success.rounds_to_keep([*falling, *[1.0] * 4], 5) is None
    assert success.rounds_to_keep([*falling, *[1.0] * 5], 5) == 30
    assert success.rounds_to_keep([0.3, 0.5, 0.2, 0.4, 0.4, 0.4, 0.1], 3) == 3
    assert success.rounds_to_keep([], 3) is None


def made_split(spark, n, noise, seed=5):
    """Listings whose success follows from a sum of features (or from nothing)."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        x = rng.random(len(success.FEATURES))
        y = rng.random() < (0.5 if noise else 0.97 if x[:4].sum() > 2 else 0.03)
        rows.append((f"p{i}", "s", int(y), *(float(v) for v in x)))
    cols = ", ".join(f"{f} double" for f in success.FEATURES)
    return success.stratified_split(spark.createDataFrame(rows, f"asin string, subcategory string, is_success int, {cols}"), 0.2, 0.2)


def test_boosting_goes_on_while_the_loss_falls_and_not_longer(spark):
    settings = {"max_iter": 24, "max_depth": 2, "step": 0.2, "patience": 4}
    learnt = success.train_success(made_split(spark, 1500, False), **settings)
    nothing = success.train_success(made_split(spark, 1500, True), **settings)
    assert learnt.stages[-1].getNumTrees > 8 and nothing.stages[-1].getNumTrees < 8


def test_trees_split_where_the_gain_is(spark):
    """A step in one feature is found, leaf values are second-order steps, covers and losses are those of all rows."""
    rng = np.random.default_rng(2)
    x = rng.random((4_000, 3))
    label = (x[:, 1] > 0.4).astype(float)
    rows = [(f"p{i}", *map(float, r), float(y), 1.0, i % 4 > 0) for i, (r, y) in enumerate(zip(x, label))]
    df = spark.createDataFrame(rows, "key string, a double, b double, c double, label double, weight double, train boolean")
    model = boosting.fit(df, ["a", "b", "c"], "key", 3, 1, 1.0, 1, 9, success.rounds_to_keep)
    tree = next(t for t in model.kept() if t.feature[0] == 1)
    assert tree.cut[0] == pytest.approx(0.4, abs=0.02) and tree.cover[0] == 3_000
    first, train = model.kept()[0], np.arange(4_000) % 4 > 0
    leaf = first.leaves(x, first.cut)
    for node in set(leaf.tolist()):
        mine = train & (leaf == node)
        g, h = (0.5 - label[mine]).sum(), 0.25 * mine.sum()
        assert first.value[node] == pytest.approx(-0.5 * g / (h + 1), abs=1e-5) and first.cover[node] == mine.sum()
    judged, margin = np.arange(4_000) % 4 == 0, np.zeros(4_000)
    for t, loss in zip(model.kept(), model.getOrDefault(model.lossCurve)):
        margin = margin + t.value[t.leaves(x, t.cut)]
        assert loss == pytest.approx(boosting.losses(margin, label, np.ones(4_000))[judged].mean(), abs=1e-5)


@pytest.mark.parametrize("ranges", ["true", "false"])
def test_bins_end_at_quantiles_of_all_rows(spark, ranges):
    rng = np.random.default_rng(7)
    columns = [rng.random(3_000), np.round(rng.normal(size=3_000) * 20), (rng.random(3_000) < 0.01) * 1.0, np.full(3_000, 2.0), -np.exp(rng.normal(size=3_000) * 9)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", ranges)  # else every range of values is a task
    try:
        for n in (3_000, 129, 128, 2, 1, 0):
            df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*(c[:n] for c in columns))], "a double, b double, c double, d double, e double")
            for found, c in zip(boosting.cuts_of(df, df.columns), columns):
                every = np.unique(np.quantile(c[:n], np.arange(1, boosting.BINS) / boosting.BINS, method="lower")) if n else np.array([])
                assert found.tolist() == [x for x in every.tolist() if x < c[:n].max()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_trees_take_their_shape_from_all_rows(spark, monkeypatch):
    """Every split is the best one over all training rows, and every bin ends at one of their quantiles, few rows or many."""
    monkeypatch.setattr(boosting, "SHAPE_ROWS", 40, raising=False)
    monkeypatch.setattr(boosting, "DRAWN", 1.0)
    rng = np.random.default_rng(3)
    x = np.round(rng.random((1_200, 3)), 3)
    label, weight, train = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=1_200) / 9 > 0.8) * 1.0, 1.0 + (x[:, 2] > 0.5), np.arange(1_200) % 5 > 0
    rows = [(f"p{i}", *map(float, r), float(y), float(w), bool(t)) for i, (r, y, w, t) in enumerate(zip(x, label, weight, train))]
    df = spark.createDataFrame(rows, "key string, a double, b double, c double, label double, weight double, train boolean")
    models = []
    for held, few, stored in ((100_000, 64, 10), (0, 64, 2), (0, 0, 3)):
        for name, value in (("HELD_ROWS", held), ("FEW_PARTS", few), ("STORED_EVERY", stored)):
            monkeypatch.setattr(boosting, name, value)
        models.append(boosting.fit(df.repartition(4), ["a", "b", "c"], "key", 5, 3, 0.3, 1, 9, success.rounds_to_keep))
    assert all(m.getOrDefault("trees") == models[0].getOrDefault("trees") for m in models)
    assert all(m.getOrDefault("lossCurve") == models[0].getOrDefault("lossCurve") for m in models)
    cuts = [np.unique(np.quantile(c, np.arange(1, boosting.BINS) / boosting.BINS, method="lower")) for c in x[train].T]
    margin = np.zeros(1_200)
    for tree in models[0].kept():
        g, h = boosting.slopes(margin, label, weight)
        at = np.zeros(1_200, int)
        for node in range(len(tree.feature)):  # parents come first
            mine = train & (at == node)
            assert tree.cover[node] == mine.sum()
            gain = lambda side: g[side].sum() ** 2 / (h[side].sum() + boosting.SHRINK)
            best = max(
                (gain(left) + gain(right) - gain(mine) for f in range(3) for c in cuts[f]
                 for left, right in [(mine & (x[:, f] <= c), mine & (x[:, f] > c))] if min(h[left].sum(), h[right].sum()) >= boosting.LEAST_CURVATURE),
                default=0.0)
            f = tree.feature[node]
            if f >= 0:
                assert tree.gain[node] == pytest.approx(best, abs=1e-3) and tree.cut[node] in cuts[f]
                at = np.where(at == node, np.where(x[:, f] <= tree.cut[node], tree.left[node], tree.right[node]), at)
        margin = margin + tree.value[tree.leaves(x, tree.cut)]


def test_constant_features_and_one_label_do_no_harm(spark):
    rows = [(f"p{i}", 1.0, 2.0, 0.0, 1.0, i % 5 > 0) for i in range(50)]
    df = spark.createDataFrame(rows, "key string, a double, b double, label double, weight double, train boolean")
    model = boosting.fit(df, ["a", "b"], "key", 4, 3, 0.1, 1, 2, success.rounds_to_keep)
    assert model.getNumTrees >= 1 and all(len(t.feature) == 1 for t in model.kept())
    assert model.featureImportances.tolist() == [0.0, 0.0]
    assert model.transform(df).agg(F.max("probability")).first()[0] < 0.5


def test_predictions_do_not_depend_on_partitions(spark):
    split = made_split(spark, 400, False)
    found = []
    for parts in (1, 3, 7):
        model = success.train_success(split.repartition(parts), max_iter=6, max_depth=3, patience=2)
        found.append({r.asin: r.score for r in success.predict(model, split).select("asin", "score").collect()})
    assert found[0] == found[1] == found[2]


def test_success_scores(trained):
    split, model = trained
    predicted = success.predict(model, split.where("fold = 'test'"))
    scores = {r.metric: r.value for r in success.evaluate_success(predicted).collect()}
    assert scores["auc"] > 0.6 and 0 <= scores["f1"] <= 1
    assert sum(r.n for r in success.confusion_matrix(predicted).collect()) == predicted.count()
    rates = A.success_by_quintile(split.withColumn("review_count", F.col("review_count").cast("long")), "review_count")
    assert rates.agg(F.sum("products")).first()[0] == split.count()


def test_curve_and_area_use_every_threshold(spark):
    """More distinct scores than any binning would keep, many within one cell."""
    rng = np.random.default_rng(8)
    rows = [(float(s), float(s), int(rng.random() < s)) for s in np.concatenate([rng.random(3000), 0.5 + np.arange(300) * 1e-12, [0.0, 1.0]])]
    df = spark.createDataFrame(rows, "score double, rawPrediction double, is_success int").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    got = {r.threshold: (r.fpr, r.tpr) for r in success.roc_curve(df).collect()}
    score, label = np.array([r[0] for r in rows]), np.array([r[2] for r in rows])
    assert set(got) == set(score.tolist())
    for t in sorted(got)[::97]:
        at = score >= t
        assert got[t] == (at[label == 0].mean(), at[label == 1].mean())
    fpr, tpr = np.array(sorted([(0.0, 0.0), *got.values()])).T
    area = {r.metric: r.value for r in success.evaluate_success(df).collect()}["auc"]
    assert area == pytest.approx(np.trapezoid(tpr, fpr), abs=1e-9)


def test_summary_compares_with_exact_medians(spark):
    """Values closer together than a thousandth fall on the right side of the median."""
    rows = [(*([i * 1e-6] * len(success.FEATURES)), *([1.0 if i > 50 else -1.0] * len(success.FEATURES))) for i in range(101)]
    cols = ", ".join(f"{f} double" for f in success.FEATURES) + ", " + ", ".join(f"shap_{f} double" for f in success.FEATURES)
    for r in attributions.shap_summary(spark.createDataFrame(rows, cols)).collect():
        assert (r.avg_shap_high, r.avg_shap_low, r.direction) == (1.0, -1.0, 2.0)


def test_inertia_of_all_rows_and_silhouette_of_a_sample(spark):
    """Beyond the sample inertia and silhouette still describe one model."""
    rows = spark.range(12_000).select(F.col("id").cast("string").alias("asin"), *[
        (F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 1000.0 + F.when(F.col("id") < 100, 60.0).otherwise(0.0)).alias(f)
        for i, f in enumerate(clusters.FEATURES)
    ])
    r = clusters.choose_k(rows, range(2, 3), sample=3_000).first()
    assert r.silhouette > 0.9  # the hundred far rows form a cluster of their own
    values = np.array([[r[f] for f in clusters.FEATURES] for r in rows.collect()])
    values = (values - values.mean(axis=0)) / values.std(axis=0, ddof=1)
    far = values[:, 0] > 5
    cost = sum(((part - part.mean(axis=0)) ** 2).sum() for part in (values[far], values[~far]))
    assert far.sum() == 100 and r.inertia == pytest.approx(cost, rel=1e-4)


def test_silhouette_by_euclidean_distance(spark):
    rng = np.random.default_rng(8)
    rows = np.rint(rng.normal(size=(2_000, 3)) * kmeans.UNIT).astype(int)
    rows[:3] = 9 * kmeans.UNIT  # equal rows, in a cluster of their own
    centres = [np.array([[0, 0, 0], [kmeans.UNIT, 0, 0], [9 * kmeans.UNIT] * 3, [-99 * kmeans.UNIT] * 3], float), np.zeros((1, 3))]
    points = spark.createDataFrame([(str(i), r.tolist()) for i, r in enumerate(rows)], "key string, z array<long>")
    label = ((rows[:, None] - centres[0][None]) ** 2.0).sum(axis=2).argmin(axis=1)
    apart = np.sqrt(((rows[:, None] - rows[None]) ** 2.0).sum(axis=2))
    scores = []
    for i, own in enumerate(label):
        mine = apart[i][label == own]
        a = mine.sum() / max(len(mine) - 1, 1)
        b = min(apart[i][label == c].mean() for c in set(label) if c != own)
        scores.append((b - a) / max(a, b) if len(mine) > 1 else 0.0)
    got = kmeans.silhouettes(points, centres, seed=1)
    assert got[0] == pytest.approx(np.mean(scores), abs=1e-9) and got[1] is None


def test_centres_do_not_depend_on_order_or_partitions(spark):
    rows = spark.range(3_000).select(F.col("id").cast("string").alias("asin"), *[
        (F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 1000.0 + F.pmod("id", F.lit(i + 2))).alias(f)
        for i, f in enumerate(clusters.FEATURES)
    ])
    fits = [
        [c.tolist() for c in clusters.fit_archetypes(x).stages[0].clusterCenters()]
        for x in (rows, rows, rows.repartition(3), rows.repartition(7, "rating"), rows.orderBy(F.desc("sales_rank")).coalesce(1))
    ]
    assert all(f == fits[0] for f in fits)


def test_fewer_different_rows_than_centres(spark):
    rows = spark.createDataFrame([(str(i), 1.0, 1.0, 1.0, 4.0, 0, float(i % 3)) for i in range(20)], "asin string, " + ", ".join(
        f"{f} double" if f != "is_best_seller" else f"{f} int" for f in clusters.FEATURES))
    model = clusters.fit_archetypes(rows)
    assert len(model.stages[0].clusterCenters()) == 3  # features that don't vary are 0
    assigned = clusters.assign_archetypes(rows, model=model)
    assert assigned.select("cluster").distinct().count() == 3
    assert tuple(clusters.placement_check(assigned, clusters.centre_table(model)).first()) == (20, 20)
    with pytest.raises(ValueError, match="no rows"):
        clusters.fit_archetypes(rows.limit(0))


def test_archetypes(spark, products, tmp_path):
    features = clusters.cluster_features(products)
    model = clusters.fit_archetypes(features)
    one = clusters.assign_archetypes(features, model=model)
    assert {r.cluster_name for r in one.select("cluster_name").distinct().collect()} == {n for n, _ in clusters.ARCHETYPES}
    again = clusters.assign_archetypes(features, model=clusters.fit_archetypes(features))
    assert one.select("asin", "cluster_name").exceptAll(again.select("asin", "cluster_name")).count() == 0
    elite = one.groupBy("cluster_name").agg(F.avg("is_best_seller").alias("b")).orderBy(F.desc("b")).first()
    assert elite.cluster_name == "Best Seller Elite"
    models.save(model, str(tmp_path / "m"), {"k": 5})
    loaded, info = models.load(spark, str(tmp_path / "m"))
    assert info == {"k": 5}
    same = clusters.assign_archetypes(features, model=loaded)
    assert one.select("asin", "cluster").exceptAll(same.select("asin", "cluster")).count() == 0
    radar = clusters.cluster_radar(one).agg(*[F.max(f).alias(f) for f in clusters.FEATURES]).first()
    assert all(v == pytest.approx(1.0) for v in radar)
    choice = clusters.choose_k(features, range(2, 4), 3).collect()
    assert [r.k for r in choice] == [2, 3] and choice[0].inertia > choice[1].inertia


def test_cluster_names_beyond_the_known():
    centers = [[0, 0, 0, i, 0, 0] for i in range(6)]
    names = clusters.name_clusters(centers)
    assert len(set(names.values())) == 6 and "Archetype 6" in names.values()


@pytest.fixture(scope="module")
def signals(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(800):
        odd = i % 40 == 0
        rows.append((f"p{i}", "c", 10, *(float(v) for v in rng.normal(8 if odd else 0, 1, len(A.TRUST_FEATURES)))))
    cols = ", ".join(f"{f} double" for f in A.TRUST_FEATURES)
    return spark.createDataFrame(rows, f"parent_asin string, source_category string, review_count long, {cols}")


def test_forest_finds_the_odd_rows(signals):
    scored = anomalies.score_trust(signals, trees=50, contamination=0.025)
    rows = scored.collect()
    assert min(r.trust_score for r in rows) == 0.0 and max(r.trust_score for r in rows) == 100.0
    flagged = {r.parent_asin for r in rows if r.is_suspicious}
    assert flagged == {f"p{i}" for i in range(0, 800, 40)}
    again = anomalies.score_trust(signals.repartition(3), trees=50, contamination=0.025)
    assert {r.parent_asin: r.raw_score for r in again.collect()} == {r.parent_asin: r.raw_score for r in rows}
    assert anomalies.trust_cutoff(scored).first()[0] < 100


def test_tree_samples_are_bounded_and_distinct(signals):
    drawn = anomalies.tree_samples(signals, trees=20, size=64, seed=1)
    per = drawn.groupBy("tree").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("reviews_per_day").alias("d")).collect()
    assert len(per) == 20 and all(r.n == r.d <= 64 for r in per) and min(r.n for r in per) > 48


def test_trees_draw_from_all_rows_independently(spark):
    """Far more rows than trees times size: no pool, so trees hardly share rows."""
    cols = [F.col("id").cast("double").alias(f) for f in A.TRUST_FEATURES]
    df = spark.range(40_000).select(F.concat(F.lit("p"), "id").alias("parent_asin"), F.lit("c").alias("source_category"), *cols)
    drawn = [r.reviews_per_day for r in anomalies.tree_samples(df, trees=10, size=32, seed=1).collect()]
    assert len(drawn) == 320 and len(set(drawn)) > 310
    assert 15_000 < np.mean(drawn) < 25_000


def test_neighbouring_numbers_are_split():
    """A cut between two numbers without another between them falls on the lower, so that no side is empty."""
    class Highest:
        choice = staticmethod(lambda columns: columns[0])
        uniform = staticmethod(lambda low, high: high)

    nodes = anomalies.grow_tree(np.array([[0.3], [0.1 + 0.2], [0.3]]), Highest, 8)
    assert [n[0] for n in nodes] == [0, -1, -1] and [n[-1] for n in nodes] == [3, 2, 1]


def test_expected_path():
    assert list(anomalies.expected_path([0, 1, 2])) == [0.0, 0.0, 1.0]
    assert anomalies.expected_path(256) == pytest.approx(10.2448, abs=1e-3)


def test_gaps_become_zero(frame):
    df = frame([(None,), (float("inf"),), (float("nan"),), (2.0,)], "x double")
    assert [r.x for r in df.select(anomalies.finite("x").alias("x")).collect()] == [0.0, 0.0, 0.0, 2.0]


def test_projection(signals):
    out = clusters.project(signals, A.TRUST_FEATURES)
    spread = out.agg(F.var_samp("pc1").alias("a"), F.var_samp("pc2").alias("b"), F.corr("pc1", "pc2").alias("c")).first()
    assert spread.a >= spread.b and abs(spread.c) < 1e-6
    assert clusters.loadings(signals, A.TRUST_FEATURES).count() == 2 * len(A.TRUST_FEATURES)


def test_blocks_of_silhouettes_need_little_memory():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(20_000, 3))
    label = (rows[:, 0] > 0).astype(int)
    size = np.bincount(label)
    tracemalloc.start()
    scores = kmeans.block_scores(7, rows, [label], [size], [np.eye(2)[label]])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50e6  # a block's distances at once are 160 MB
    at = slice(7 * kmeans.BLOCK, 8 * kmeans.BLOCK)
    sums = np.sqrt(((rows[at, None] - rows[None]) ** 2).sum(axis=2)) @ np.eye(2)[label]
    own = label[at]
    a, b = sums[np.arange(1000), own] / (size[own] - 1), sums[np.arange(1000), 1 - own] / size[1 - own]
    assert scores == [pytest.approx(((b - a) / np.maximum(a, b)).sum())]
    assert kmeans.silhouettes(None, [], 1) == []  # no model, no pass


def test_tabled_attributions_equal_those_of_each_row():
    rng = np.random.default_rng(4)
    leaves = [(0.5, {})]
    for m in (1, 2, 5, 6, 7):
        for _ in range(9):
            used = rng.choice(8, m, replace=False)
            bounds = np.sort(rng.random((m, 2)), axis=1) * [0.5, 2.0]
            leaves.append((float(rng.normal()), {int(f): (float(rng.random()), *map(float, b)) for f, b in zip(used, bounds)}))
    groups = attributions.leaf_groups(leaves)
    ready = attributions.tabled(groups, 10_000)
    assert {len(g[0]) for g in ready if g[5] is not None} == {1, 2, 5, 6}
    assert all(g[5] is None for g in attributions.tabled(groups, 1))
    x = rng.random((700, 8))
    for got, plain in zip(attributions.shapley_batch(x, ready), attributions.shapley_batch(x, groups)):
        np.testing.assert_allclose(got, plain, atol=1e-12)


def test_rows_join_the_leaves_they_fall_into(spark):
    inf = float("inf")
    leaves = [(0, 1.0, 0, -inf, 0.5), (0, 1.0, 1, 2.0, inf), (1, -1.0, 0, 0.5, inf), (2, 0.25, -1, -inf, inf)]
    table = spark.createDataFrame(leaves, "leaf int, value double, feature int, above double, up_to double")
    rows = spark.createDataFrame([("a", 0.5, 3.0), ("b", 0.5, 2.0), ("c", 0.6, 9.0), ("d", inf, -inf)], "asin string, p double, q double")
    met = attributions.join_leaves(rows, table, ["p", "q"])
    assert sorted((r.asin, r.leaf, r.value) for r in met.collect()) == [
        ("a", 0, 1.0), ("a", 2, 0.25), ("b", 2, 0.25), ("c", 1, -1.0), ("c", 2, 0.25), ("d", 1, -1.0), ("d", 2, 0.25)]


def test_curve_is_written_once_and_its_ends_are_found_cell_by_cell(spark):
    cell = 1 / success.ROC_CELLS
    steps = [(0.9, 0.1, 0.2), (0.5 + cell / 2, 0.3, 0.4), (0.5 + cell / 4, 0.3, 0.6), (0.1, 1.0, 1.0)]
    schema = "threshold double, fpr double, tpr double"
    assert success.curve_ends(spark.createDataFrame(steps, schema)).first()[:] == (True, 1.0, 1.0)
    for at, fpr in ((0, 0.4), (2, 0.2), (3, 0.2)):  # a fall into a cell, inside one, out of one
        bent = [(t, fpr if i == at else f, p) for i, (t, f, p) in enumerate(steps)]
        assert success.curve_ends(spark.createDataFrame(bent, schema)).first()[0] is False
    assert success.curve_ends(spark.createDataFrame([], schema)).first()[:] == (True, None, None)
    scored = spark.range(50).select((F.col("id") % 2).cast("int").alias("is_success"), F.udf(lambda i: i / 50, "double")("id").alias("score"))
    curve = success.roc_curve(scored)
    assert curve.count() == 50 and "EvalPython" not in curve._jdf.queryExecution().executedPlan().toString()
