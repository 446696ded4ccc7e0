"""K4: the forest grown in blocks against Spark's own and a plain tree."""

import os

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from fieldlens.plans import forest as R
from fieldlens.plans import model as M
from fieldlens.session import shared_path

NUM, CAT = ["x", "z"], ["c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    out = []
    for i in range(900):
        x, z = float(rng.integers(0, 30)), None if i % 17 == 0 else float(rng.integers(0, 7))
        c, d = None if i % 23 == 0 else "abcde"[rng.integers(0, 5)], "uv"[rng.integers(0, 2)]
        out.append((x, z, c, d, 3 * x + (20.0 if c == "b" else 0.0) * (z or 1.0) + float(rng.normal()) * 5, i % 5))
    return spark.createDataFrame(out, "x double, z double, c string, d string, y double, fold int").coalesce(2)


def predictions(model, df):
    return [r[0] for r in model.transform(M.prepare(df, NUM, "y")).orderBy("y").select(M.PRED).collect()]


def test_one_tree_is_the_tree_of_the_library(rows):
    stages = M.build_pipeline(NUM, CAT, num_trees=1, max_depth=5).getStages()
    stages[-1].shown["bootstrap"] = False
    ours = Pipeline(stages=stages).fit(M.prepare(rows, NUM, "y"))
    theirs = Pipeline(stages=[*stages[:-1], RandomForestRegressor(
        featuresCol="features", labelCol=M.LABEL, predictionCol=M.PRED, numTrees=1, maxDepth=5, seed=42,
        featureSubsetStrategy="all", maxBins=64, bootstrap=False)]).fit(M.prepare(rows, NUM, "y"))
    assert predictions(ours, rows) == pytest.approx(predictions(theirs, rows), rel=1e-9)
    a, b = ours.stages[-1], theirs.stages[-1]
    assert a.totalNumNodes == b.totalNumNodes > 20 and a.numFeatures == b.numFeatures == 9
    assert a.featureImportances.toArray() == pytest.approx(b.featureImportances.toArray(), rel=1e-9)


def test_jobs_and_shuffle_do_not_follow_the_depth(spark, rows):
    """Before, each level of the trees was a job or more, that sent a histogram
    of all its nodes from every partition."""
    sc, jobs = spark.sparkContext, []
    for depth in (2, 8):
        sc.setJobGroup(f"forest-{depth}", "fit")
        M.fit(rows, NUM, CAT, "y", num_trees=3, max_depth=depth)
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"forest-{depth}")))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]


def test_blocks_and_tasks_do_not_change_the_bootstrap(spark, rows, monkeypatch):
    """Trees differ by their draws, rows are drawn once on average, and the
    forest is the same however many tasks grow it."""
    want = None
    for groups in (None, 1):
        if groups:
            monkeypatch.setattr(R, "_keys", lambda s, n, real=R._keys: real(s, n)[:1] * 1)
            monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", property(lambda _: groups))
            monkeypatch.setattr(M, "layout_partitions", lambda _: 8)
        m = M.fit(rows, NUM, CAT, "y", num_trees=6, max_depth=4)
        drawn = [t._call_java("rootNode").impurityStats().count() for t in m.stages[-1].trees]
        assert len(set(drawn)) > 1 and np.mean(drawn) == pytest.approx(900, rel=0.1)
        got = predictions(m, rows)
        assert want is None or got == want
        want = got


def plain(x, onehot, y, w, thresholds, depth):
    """The leaf means of a tree grown by trying every split of every feature."""
    out = np.zeros(len(y))

    def node(rows, left):
        def sse(r):
            return float((w[r] * (y[r] - np.average(y[r], weights=w[r])) ** 2).sum())

        best = (1e-6, None)
        for f in range(x.shape[1]):
            for t in thresholds[f]:
                best = max(best, (sse(rows) - cost(rows, x[rows, f] <= t, sse), (x[:, f] <= t)), key=lambda b: b[0])
        for f in range(onehot.shape[1]):
            best = max(best, (sse(rows) - cost(rows, onehot[rows, f] == 1, sse), onehot[:, f] == 1), key=lambda b: b[0])
        if not left or best[1] is None:
            out[rows] = np.average(y[rows], weights=w[rows])
            return
        node(rows[best[1][rows]], left - 1)
        node(rows[~best[1][rows]], left - 1)

    def cost(rows, go, sse):
        return np.inf if go.all() or not go.any() else sse(rows[go]) + sse(rows[~go])

    node(np.flatnonzero(w), depth)
    return out


@pytest.mark.parametrize("categories", [4, 300])  # 300: more than a byte holds
@pytest.mark.parametrize("bootstrap", [True, False])
def test_tree_over_blocks_equals_plain_tree(monkeypatch, categories, bootstrap):
    monkeypatch.setattr(R, "HELD", 100)  # the rows' nodes in a file
    rng = np.random.default_rng(categories)
    n, depth = 400, 4
    x = np.stack([rng.integers(0, 9, n).astype(float), rng.normal(size=n)], 1)
    c = rng.integers(0, categories + 1, n)  # the last number is a value unseen
    y = 5 * x[:, 1] + 4 * (c % 3) + rng.normal(size=n) + 1000
    thr = [R.split_candidates(*np.unique(x[:, j], return_counts=True), 15) for j in range(2)]
    cols = R.Columns([*[len(t) + 1 for t in thr], categories + 1], 2)
    blob, index, w = b"", [], np.ones(n)
    for lo in (250, 0, 100):  # blocks come in any order
        hi = {0: 100, 100: 250, 250: n}[lo]
        bins = [np.searchsorted(t, x[lo:hi, j], "left") for j, t in enumerate(thr)] + [c[lo:hi]]
        index.append((lo, hi - lo, len(blob)))
        blob += y[lo:hi].tobytes() + b"".join(R._padded(s.tobytes()) for s in cols.store(bins))
        if bootstrap:
            w[lo:hi] = R._draws(np.random.default_rng([7, 0, lo]), hi - lo)
    t = R.grow(R.Rows(cols, blob, index, y.mean()), 0, depth, 7, bootstrap)
    first = 2
    got = {r["id"]: r for r in R._node_rows(0, t, cols, thr, [first], y.mean()).column(1).to_pylist()}
    want = plain(x, np.eye(categories + 1)[c][:, :categories], y, w, thr, depth)
    features = np.concatenate([x, np.eye(categories + 1)[c][:, :categories]], axis=1)
    for i in np.flatnonzero(w):
        at = got[0]
        while at["leftChild"] >= 0:
            s = at["split"]
            v, of = features[i, s["featureIndex"]], s["leftCategoriesOrThreshold"]
            at = got[at["leftChild"] if (v in of if s["numCategories"] == 2 else v <= of[0]) else at["rightChild"]]
        assert at["prediction"] == pytest.approx(want[i], rel=1e-9)
    assert got[0]["rawCount"] == w.sum()


def test_draws_follow_poisson():
    w = R._draws(np.random.default_rng(1), 200_000)
    share = np.bincount(w, minlength=8) / len(w)
    for k, p in enumerate([0.36788, 0.36788, 0.18394, 0.06131, 0.01533]):
        assert share[k] == pytest.approx(p, abs=0.005)


def test_split_candidates_cut_all_rows_in_equal_shares():
    rng = np.random.default_rng(2)
    v = rng.exponential(size=300_000)
    parts = [R._summary(p) for p in np.split(v, 3)]
    t = R.split_candidates(*[np.concatenate(p) for p in zip(*parts)], 63)
    assert len(t) == 63
    share = np.diff(np.searchsorted(np.sort(v), t), prepend=0) / len(v)
    assert np.abs(share - 1 / 64).max() < 0.004
    assert R.split_candidates(np.array([3.0, 1.0, 1.0]), np.array([2.0, 1.0, 5.0]), 63).tolist() == [2.0]


def test_a_saved_forest_is_the_same_forest(spark, rows):
    """Nodes, gains and parameters outlive saving and loading, and the folder
    they were first written to is gone."""
    model = M.fit(rows, NUM, CAT, "y", num_trees=4, max_depth=6)
    path = shared_path(spark, "test_forest")
    again = M.load_model(M.save_model(model, path))
    a, b = model.stages[-1], again.stages[-1]
    assert a.toDebugString == b.toDebugString and a.totalNumNodes == b.totalNumNodes > 40
    assert a.featureImportances == b.featureImportances and b.getNumTrees == 4
    assert predictions(model, rows) == predictions(again, rows)
    assert not [p for p in os.listdir(os.path.dirname(path.removeprefix("file:"))) if p.startswith(("forest-", "fit-"))]


def test_null_labels_are_refused(spark, rows):
    with pytest.raises(Exception, match="must not be null"):
        M.fit(rows.withColumn("y", F.when(F.col("x") > 2, F.col("y"))), NUM, CAT, "y", num_trees=2, max_depth=2)
