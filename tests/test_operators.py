"""Brute-force and property checks for operators without an SQL oracle and for
the scalable code paths (forced with tiny bin / bracket sizes)."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quench.functions.constants import FEATURES, LABEL, ROW_ID
from quench.operators import clean, metrics
from quench.operators.features import create_derived_features
from quench.operators.ordered import prefix_sums
from quench.operators.quantiles import exact_quantiles
from quench.operators.scale import fit_scaler
from quench.operators.split import split_data
from quench.sources.fixtures import measurements_clean

from conftest import SF_SMALL


def test_exact_quantiles_bracket_path_matches_numpy(spark):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(size=3000), np.full(1500, 0.25), rng.exponential(size=500)])
    rows = [(float(v) if i % 37 else None,) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = exact_quantiles(df, ["x"], probs, accuracy=100, max_bracket=50)["x"]
    clean_vals = np.array([r[0] for r in rows if r[0] is not None])
    for p in probs:
        assert got[p] == pytest.approx(float(np.quantile(clean_vals, p)), abs=1e-12)


def test_prefix_sums_binned_equals_single_bin(spark):
    df = spark.range(0, 5000).select(F.col("id"), (F.col("id") * 7919 % 1000).alias("k"),
                                     (F.col("id") % 3).alias("g"), F.lit(1).alias("one"))
    a = prefix_sums(df, "id", {"one": "one"}, ["g"], rows_per_bin=10_000_000, n_rows=5000)
    b = prefix_sums(df, "id", {"one": "one"}, ["g"], rows_per_bin=97, n_rows=5000)
    ja = {r["id"]: r["one_before"] for r in a.collect()}
    jb = {r["id"]: r["one_before"] for r in b.collect()}
    assert ja == jb
    assert ja[5] == 1 and ja[0] == 0


def test_split_is_disjoint_complete_and_partition_stable(spark):
    m = measurements_clean(spark, SF_SMALL)
    s1 = {r[ROW_ID]: r["split"] for r in split_data(m, 0.2, 42, True).collect()}
    s2 = {r[ROW_ID]: r["split"] for r in split_data(m.repartition(13), 0.2, 42, True).collect()}
    assert s1 == s2
    n = m.count()
    n_test = sum(1 for v in s1.values() if v == "test")
    assert len(s1) == n and abs(n_test - 0.2 * n) <= 2


def _nan_euclid_knn_impute(x, k):
    """scikit-learn-style brute force: donors = rows with the feature present."""
    out = x.copy()
    d = x.shape[1]
    for j in range(d):
        miss = np.flatnonzero(np.isnan(x[:, j]))
        donors = np.flatnonzero(~np.isnan(x[:, j]))
        for i in miss:
            diff = x[donors] - x[i]
            present = ~np.isnan(diff)
            sq = np.where(present, diff, 0.0) ** 2
            n = present.sum(axis=1)
            dist = np.where(n > 0, d / np.maximum(n, 1) * sq.sum(axis=1), np.inf)
            order = np.lexsort((donors, dist))[:k]
            out[i, j] = x[donors[order], j].mean()
    return out


def test_knn_imputation_matches_brute_force(spark):
    m = measurements_clean(spark, SF_SMALL).orderBy(ROW_ID).limit(800).checkpoint(eager=True)
    pdf = m.toPandas().sort_values(ROW_ID).reset_index(drop=True)
    want = _nan_euclid_knn_impute(pdf[FEATURES].to_numpy(dtype=float), 5)
    got = clean.handle_missing_values(m, "knn", 5, FEATURES).toPandas().sort_values(ROW_ID).reset_index(drop=True)
    np.testing.assert_allclose(got[FEATURES].to_numpy(dtype=float), want, rtol=1e-9, atol=1e-9)


def _plain_knn(x, k):
    """As above, but only comparable donors, equal distances by the first of equal rows, else the column mean."""
    out, d, first = x.copy(), x.shape[1], {}
    copy_of = np.array([first.setdefault(r.tobytes(), i) for i, r in enumerate(np.where(np.isnan(x), -1e9, x))])
    for j in range(d):
        donors = np.flatnonzero(~np.isnan(x[:, j]))
        for i in np.flatnonzero(np.isnan(x[:, j])):
            diff = x[donors] - x[i]
            present = ~np.isnan(diff)
            n = present.sum(axis=1)
            dist = np.where(n > 0, d / np.maximum(n, 1) * (np.where(present, diff, 0.0) ** 2).sum(axis=1), np.inf)
            order = np.lexsort((copy_of[donors], dist))[:k]
            order = order[np.isfinite(dist[order])]
            out[i, j] = x[donors[order], j].mean() if len(order) else np.nanmean(x[:, j])
    return out


@pytest.mark.parametrize("n, d, share, places", [(300, 3, 0.3, 2), (400, 4, 0.6, 1), (600, 2, 0.2, 1)])
def test_knn_imputation_without_a_complete_column(spark, monkeypatch, n, d, share, places):
    """Gaps in every column, ties, copies and rows without any value; small leaves so that searches cross many."""
    from quench.operators import kdtree, knn

    rng = np.random.default_rng(n)
    x = np.round(rng.normal(size=(n, d)), places)
    x[rng.random((n, d)) < share] = np.nan
    cols = [f"c{i}" for i in range(d)]
    frame = pd.DataFrame(x, columns=cols).astype(object)
    frame = frame.where(frame.notna(), None)
    frame[ROW_ID] = [f"{i:05d}" for i in range(n)]
    df = spark.createDataFrame(frame, ", ".join(f"{c} double" for c in cols) + f", {ROW_ID} string").repartition(3)
    search = knn.knn_search
    monkeypatch.setattr(knn, "knn_search", lambda a, b, dims, k: search(a, b, dims, k, leaf_rows=16))
    got = clean.handle_missing_values(df, "knn", 5, cols).toPandas().sort_values(ROW_ID)
    np.testing.assert_allclose(got[cols].to_numpy(dtype=float), _plain_knn(x, 5), rtol=1e-9, atol=1e-9)
    assert kdtree.LEAF_ROWS == 1024


def test_tree_leaves_are_bounded_on_clustered_rows(spark):
    """Nine in ten rows in a thousandth of the span, grown from a sample of a tenth: no leaf holds more than twice its bound."""
    from quench.operators import kdtree

    rng = np.random.default_rng(8)
    x = rng.random((6000, 3))
    x[:5400] *= 0.001
    x[rng.random((6000, 3)) < 0.1] = np.nan
    rows = spark.createDataFrame([([None if np.isnan(v) else float(v) for v in r],) for r in x], "x array<double>").repartition(4)
    tree, placed = kdtree.build(rows, 3, lambda df: df.checkpoint(eager=True), leaf_rows=50, sample=600)
    sizes = {r["leaf"]: r["count"] for r in placed.groupBy("leaf").count().collect()}
    assert sum(sizes.values()) == 6000 and max(sizes.values()) <= 100
    assert (tree.leaf_of(x) == [r["leaf"] for r in kdtree.with_leaf(spark.createDataFrame(
        [([None if np.isnan(v) else float(v) for v in r],) for r in x], "x array<double>").coalesce(1), tree).collect()]).all()
    near = np.sqrt(np.nansum((np.nan_to_num(x) - np.nan_to_num(x[7])) ** 2, axis=1))
    row, leaf = tree.within(x[7:8], np.array([0]), np.array([0.01]))
    inside = np.flatnonzero((near <= 0.1) & ~np.isnan(x).any(1))
    assert set(tree.leaf_of(x[inside])) <= set(leaf.tolist()) and (row == 0).all()


def test_knn_imputation_edges(spark):
    empty = spark.createDataFrame([], f"a double, b double, {ROW_ID} string")
    assert clean.handle_missing_values(empty, "knn", 5, ["a", "b"]).collect() == []
    alone = spark.createDataFrame([(None, 1.0, "x"), (None, None, "y"), (None, 2.0, "z")], f"a double, b double, {ROW_ID} string")
    got = clean.handle_missing_values(alone, "knn", 5, ["a", "b"]).orderBy(ROW_ID).collect()
    assert [(r["a"], r["b"]) for r in got] == [(None, 1.0), (None, 1.5), (None, 2.0)]


def test_knn_classifier_matches_brute_force(spark):
    from quench.operators.knn import KNNClassifier

    m = clean.handle_missing_values(measurements_clean(spark, SF_SMALL), "median", features=FEATURES)
    feats = ["ph", "Turbidity", "Chloramines"]
    sp = split_data(m, 0.2, 42, True).checkpoint(eager=True)
    train, test = sp.where("split = 'train'"), sp.where("split = 'test'").limit(150)
    got = KNNClassifier(5).fit(train, feats).predict(test).select(ROW_ID, "probability").toPandas()
    tr = train.toPandas()
    tr = tr.sort_values(ROW_ID)
    te = test.toPandas().set_index(ROW_ID)
    xt = tr[feats].to_numpy(float)
    for _, row in got.iterrows():
        q = te.loc[row[ROW_ID], feats].to_numpy(float)
        dist = ((xt - q) ** 2).sum(axis=1)
        kth = np.sort(dist)[4]
        # exact up to ties at the k-th distance: compare against both tie resolutions
        strict = tr[LABEL].to_numpy()[dist < kth]
        tied = tr[LABEL].to_numpy()[dist == kth]
        need = 5 - len(strict)
        lo = (strict.sum() + np.sort(tied)[:need].sum()) / 5
        hi = (strict.sum() + np.sort(tied)[::-1][:need].sum()) / 5
        assert lo - 1e-12 <= row["probability"] <= hi + 1e-12


def test_isolation_forest_scores_planted_outliers_highest_and_is_stable(spark):
    from quench.operators.iforest import fit_isolation_forest

    rng = np.random.default_rng(0)
    inl = rng.normal(size=(2000, 3))
    out = rng.normal(loc=8.0, size=(10, 3))
    rows = [(f"r{i}", *map(float, v), 1) for i, v in enumerate(np.vstack([inl, out]))]
    df = spark.createDataFrame(rows, f"{ROW_ID} string, a double, b double, c double, {LABEL} int")
    model = fit_isolation_forest(df, ["a", "b", "c"], n_trees=50, psi=128, contamination=0.01)
    s1 = {r[ROW_ID]: r["anomaly_score"] for r in model.score(df).collect()}
    top = sorted(s1, key=lambda k: -s1[k])[:10]
    assert set(top) == {f"r{i}" for i in range(2000, 2010)}
    model2 = fit_isolation_forest(df.repartition(7), ["a", "b", "c"], n_trees=50, psi=128, contamination=0.01)
    s2 = {r[ROW_ID]: r["anomaly_score"] for r in model2.score(df).collect()}
    assert all(abs(s1[k] - s2[k]) < 1e-12 for k in s1)


def test_logistic_regression_learns_planted_rule(spark):
    from quench.operators.models import evaluate_predictions, make_model

    m = measurements_clean(spark, SF_SMALL).select(ROW_ID, *[F.coalesce(F.col(c), F.lit(0.0)).alias(c)
                                                             for c in FEATURES])
    m = m.withColumn(LABEL, (F.col("ph") > 6.0).cast("int"))
    sp = split_data(fit_scaler(m, FEATURES).transform(m), 0.2, 42, True)
    train, test = sp.where("split = 'train'"), sp.where("split = 'test'")
    model = make_model("Logistic Regression", train.count()).fit(train, FEATURES)
    acc = evaluate_predictions(model.predict(test))["accuracy"]
    majority = test.agg(F.avg(F.col(LABEL).cast("double"))).first()[0]
    assert acc > max(majority, 1 - majority) + 0.05


def test_edge_cases(spark):
    df = spark.createDataFrame([(1.0, None, 5.0, 1), (2.0, None, 5.0, 0), (-1e-5, None, 5.0, 1)],
                               "ph double, Sulfate double, Hardness double, Potability int")
    # all-NULL column: median is None, nothing filled, no error
    out = clean.handle_missing_values(df, "median", features=["ph", "Sulfate", "Hardness"])
    assert out.where("Sulfate IS NULL").count() == 3
    # constant column scales to 0 (std 0 -> divide by 1); min-max constant -> 0
    sc = fit_scaler(df, ["Hardness"], "standard").transform(df)
    assert {r.Hardness for r in sc.collect()} == {0.0}
    assert {r.Hardness for r in fit_scaler(df, ["Hardness"], "minmax").transform(df).collect()} == {0.0}
    # divisor exactly -1e-5 -> NULL ratio instead of an error
    d = create_derived_features(df.withColumn("Solids", F.lit(1.0)).withColumn("Conductivity", F.lit(1.0))
                                .withColumn("Chloramines", F.lit(1.0)).withColumn("Organic_carbon", F.lit(1.0))
                                .withColumn("Trihalomethanes", F.lit(1.0)).withColumn("Turbidity", F.lit(1.0)))
    assert d.where("ph = -1e-5").first()["Hardness_to_pH"] is None
    # unknown strategy raises
    with pytest.raises(ValueError):
        clean.handle_missing_values(df, "bogus", features=["ph"])
    # drop strategy skipped entirely when no feature is missing (label NULL kept)
    lab = spark.createDataFrame([(1.0, None), (2.0, 1)], "ph double, Potability int")
    assert clean.handle_missing_values(lab, "drop", features=["ph"]).count() == 2
    # AUC of a constant score is 0.5; single class gives NULL
    s = spark.createDataFrame([(1, 0.3), (0, 0.3), (1, 0.3)], "label int, score double")
    assert metrics.roc_auc(s).first()[0] == 0.5
    one = spark.createDataFrame([(1, 0.3), (1, 0.4)], "label int, score double")
    assert metrics.roc_auc(one).first()[0] is None
    # one row and zero rows
    assert metrics.confusion_counts(spark.createDataFrame([], "label int, prediction int")).first()["tp"] == 0


def test_p_value_matches_known_values():
    from quench.operators.stats import correlation_p_value

    # t = r sqrt(dof / (1 - r^2)); r = 0.5, n = 12 -> t = 1.8257, two-sided p = 0.0978 (dof 10)
    assert correlation_p_value(0.5, 12) == pytest.approx(0.09785, abs=2e-4)
    assert correlation_p_value(0.0, 50) == pytest.approx(1.0)


def test_prefix_sums_keep_null_partitions_and_keys(spark):
    rows = [(i, None if i % 4 == 0 else i % 3, None if i == 17 else i) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, g long, k long").withColumn("one", F.lit(1))
    got = {r["id"]: r["one_before"] for r in prefix_sums(df, "k", {"one": "one"}, ["g"], rows_per_bin=20).collect()}
    want = {}
    for g in {r[1] for r in rows}:
        for n, (i, _, _) in enumerate(sorted((r for r in rows if r[1] == g), key=lambda r: (r[2] is not None, r[2] or 0))):
            want[i] = n
    assert got == want


@pytest.mark.parametrize("few", [100_000, 10])
def test_split_and_folds_with_null_labels(spark, monkeypatch, few):
    from quench.operators import split as S

    monkeypatch.setattr(S, "_FEW", few)
    rows = [(f"k{i}", None if i % 4 == 0 else i % 2) for i in range(4000)]
    df = spark.createDataFrame(rows, "row_id string, Potability int").repartition(7)
    got = S.split_data(df, 0.2, 42, True).groupBy("Potability", "split").count().collect()
    assert {(r["Potability"], r["split"]): r["count"] for r in got} == {
        (None, "test"): 200, (None, "train"): 800, (0, "test"): 200, (0, "train"): 800, (1, "test"): 400, (1, "train"): 1600}
    folds = S.assign_folds(df, 5, rows_per_bin=50).groupBy("Potability", "fold").count().collect()
    assert len(folds) == 15 and {r["count"] for r in folds} == {200, 400}
    import hashlib

    by = sorted((int(hashlib.md5(f"42:{k}".encode()).hexdigest()[:13], 16), k) for k, l in rows if l == 0)
    chosen = {r["row_id"] for r in S.split_data(df, 0.2, 42, True).where("Potability = 0 AND split = 'test'").collect()}
    assert chosen == {k for _, k in by[:200]}


def test_auc_of_huge_counts_and_null_scores(spark):
    from quench.operators import metrics as M

    counts = spark.createDataFrame([(0.1, 10**9, 9 * 10**9), (0.5, 5 * 10**9, 5 * 10**9), (0.9, 8 * 10**9, 2 * 10**9)],
                                   "score double, _pos bigint, _neg bigint")
    got = M._auc(counts, "score", 2_000_000).first()[0]
    pos, neg = [1, 5, 8], [9, 5, 2]
    want = sum(p * (sum(neg[:i]) + neg[i] / 2) for i, p in enumerate(pos)) / (sum(pos) * sum(neg))
    assert got == pytest.approx(want, abs=1e-12)
    rows = [(i % 2, None if i % 5 == 0 else (i * 37 % 101) / 101.0) for i in range(3000)]
    df = spark.createDataFrame(rows, "label int, score double")
    assert M.roc_auc(df, rows_per_bin=10).first()[0] == pytest.approx(M.roc_auc(df.where("score IS NOT NULL")).first()[0], abs=1e-12)


def test_evaluate_model_equals_its_parts(spark):
    from quench.operators import metrics as M

    rows = [(i % 2, (i * 7 % 11) % 2, (i * 37 % 101) / 101.0) for i in range(500)]
    df = spark.createDataFrame(rows, "label int, prediction int, score double")
    got = M.evaluate_model(df).first().asDict()
    want = {**M.classification_metrics(df).first().asDict(), **M.roc_auc(df).first().asDict(), **M.confusion_counts(df).first().asDict()}
    assert got == pytest.approx(want)


def test_isolation_forest_scores_alike_at_every_size(spark):
    from quench.operators.iforest import fit_isolation_forest

    means = {}
    for n in (60, 2000, 50_000):
        rng = np.random.default_rng(n)
        pdf = __import__("pandas").DataFrame(rng.normal(size=(n, 3)), columns=["a", "b", "c"])
        pdf["row_id"] = [f"r{i}" for i in range(n)]
        df = spark.createDataFrame(pdf)
        model = fit_isolation_forest(df, ["a", "b", "c"], n_trees=50, psi=256, contamination=0.1)
        assert model.psi == min(256, n)
        means[n] = model.score(df).agg(F.avg("anomaly_score")).first()[0]
    assert max(means.values()) - min(means.values()) < 0.05


def test_duplicates_keep_the_least_row_id(spark):
    from quench.operators.clean import remove_duplicates

    rows = [(f"r{i:03d}", float(i % 7), None if i % 3 else 1.0) for i in range(200)]
    df = spark.createDataFrame(rows, "row_id string, a double, b double")
    kept = [sorted(map(tuple, remove_duplicates(df.repartition(n)).collect())) for n in (1, 3, 8, 13)]
    first = {}
    for r in rows:
        first.setdefault(r[1:], r)
    assert kept[0] == kept[1] == kept[2] == kept[3] == sorted(first.values())
    assert remove_duplicates(df).columns == df.columns


def test_block_knn_votes_match_brute_force(spark):
    from quench.operators.knn import KNNClassifier

    rng = np.random.default_rng(5)
    x, q = rng.integers(0, 4, (300, 3)).astype(float), rng.integers(0, 4, (80, 3)).astype(float)  # many ties
    y = rng.integers(0, 2, 300)
    train = spark.createDataFrame([(f"t{i:03d}", *map(float, r), int(c)) for i, (r, c) in enumerate(zip(x, y))],
                                  "row_id string, a double, b double, c double, Potability int").repartition(5)
    test = spark.createDataFrame([(f"q{i}", *map(float, r)) for i, r in enumerate(q)], "row_id string, a double, b double, c double")
    got = {r["row_id"]: r["probability"] for r in KNNClassifier(block=17).fit(train, ["a", "b", "c"]).predict(test).collect()}
    for i, r in enumerate(q):
        d = ((x - r) ** 2).sum(axis=1)
        assert got[f"q{i}"] == pytest.approx(y[np.lexsort((np.arange(300), d))[:5]].mean())


def test_spearman_with_ties(spark):
    from quench.operators.stats import spearman

    rng = np.random.default_rng(9)
    x, y = rng.integers(0, 20, 500), rng.integers(0, 2, 500)

    def ranks(v):
        return np.array([(v < a).sum() + ((v == a).sum() + 1) / 2 for a in v])

    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(x, y)] + [(None, 1)], "x int, y int")
    got = spearman(df, "x", "y").first()
    assert got["n"] == 500 and got["spearman_correlation"] == pytest.approx(np.corrcoef(ranks(x), ranks(y))[0, 1], abs=1e-12)
