"""K1-K12 on a small slice: invariants of the forest pipeline."""

import pytest
from pyspark.sql import functions as F

from fieldlens.plans import evaluate as EV
from fieldlens.plans import model as M
from fieldlens.plans.registry import CATEGORICAL, NUMERIC, Run
from fieldlens.session import shared_path

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def parts(spark):
    s = Run(spark, SF_SMALL).split
    s = s.persist()
    return s.where("split = 'train'"), s.where("split = 'test'")


def test_forest_invariants(spark, parts):
    tr, te = parts
    params = {"num_trees": 5, "max_depth": 4, "seed": 42}
    m1 = M.fit(tr, NUMERIC, CATEGORICAL, EV.TARGET, **params)
    # same rows in another partitioning and order: same model
    shuffled = tr.repartition(3).orderBy(F.rand(seed=5))
    m2 = M.fit(shuffled, NUMERIC, CATEGORICAL, EV.TARGET, **params)
    p1 = M.predict(m1, te, NUMERIC, EV.TARGET, keep=["County", "Crop", "Year", "Yield_Per_Acre"])
    p2 = M.predict(m2, te, NUMERIC, EV.TARGET, keep=["County", "Crop", "Year", "Yield_Per_Acre"])
    a = sorted(r[EV.PRED] for r in p1.collect())
    b = sorted(r[EV.PRED] for r in p2.collect())
    assert a == b and len(a) == te.count()  # same seed, same model; no row dropped
    imp = M.feature_importance(spark, m1, NUMERIC, CATEGORICAL).collect()
    assert sum(r["Importance"] for r in imp) == pytest.approx(1.0)
    assert [r["Importance"] for r in imp] == sorted((r["Importance"] for r in imp), reverse=True)
    lo, hi = EV.residual_bands(p1)
    assert lo <= hi
    banded = EV.add_bands(p1, (lo, hi))
    assert banded.where(F.col("Lower_Bound") > F.col("Upper_Bound")).count() == 0
    path = M.save_model(m1, shared_path(spark, "test_model"))
    p3 = M.predict(M.load_model(path), te, NUMERIC, EV.TARGET, keep=["Year"])
    assert sorted(r[EV.PRED] for r in p3.collect()) == a


def test_onehot_unseen_is_all_zero(spark):
    tr = spark.createDataFrame([("a",), ("b",)], "c string")
    te = spark.createDataFrame([("b",), ("z",)], "c string")
    rows = M.onehot_columns(tr, te, ["c"], keep=["c"]).collect()
    got = {r["c"]: (r["c_a"], r["c_b"]) for r in rows}
    assert got == {"b": (0.0, 1.0), "z": (0.0, 0.0)}


def test_training_partitions_follow_slots_and_rows(spark, monkeypatch):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("g"))
    cores = spark.sparkContext.defaultParallelism
    slots = cores * -(-8 // cores)  # the fewest whole rounds that give 8 partitions
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        laid = M.stable_layout(df)
        assert laid.rdd.getNumPartitions() == slots and laid.count() == 1000
        monkeypatch.setattr(M, "PARTITION_ROWS", 50)  # more rows than one round of slots may hold
        laid = M.stable_layout(df)
        sizes = laid.rdd.glom().map(len).collect()
        assert len(sizes) == cores * -(-1000 // (cores * 50)) and sum(sizes) == 1000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_cross_validation_trains_in_few_partitions(spark, monkeypatch):
    rows = [(float(i), "ab"[i % 2], float(i % 11), i % 5) for i in range(300)]
    df = spark.createDataFrame(rows, "x double, c string, y double, fold int")
    seen, real = [], M.build_pipeline

    def watched(*a, **k):
        made = real(*a, **k)
        fit = made.fit
        made.fit = lambda d: (seen.append(d.rdd.getNumPartitions()), fit(d))[1]
        return made

    monkeypatch.setattr(M, "build_pipeline", watched)
    cores = spark.sparkContext.defaultParallelism
    slots = cores * -(-8 // cores)  # the fewest whole rounds that give 8 partitions
    keys = {"spark.sql.shuffle.partitions": "40", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.maxPartitionBytes": "1k"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        rmses, held = M.cross_validated(df, ["x"], ["c"], "y", "fold", num_trees=2, max_depth=2)
        assert len(rmses) == 5 and held.count() == 300
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(seen) == 5 and max(seen) <= slots
