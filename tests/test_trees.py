import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.operators import pooled, trees


@pytest.fixture(scope="module")
def rows(make_series):
    r = np.random.default_rng(6)
    frame = make_series(a=100 + r.normal(size=120).cumsum(), b=40 + r.normal(size=90).cumsum())
    return pooled.training_rows(frame)


@pytest.mark.parametrize("name", ["Random Forest", "GBT"])
def test_walk_gives_the_models_own_answers(spark, rows, monkeypatch, name):
    small = pooled.regressor(name)
    small = small.setNumTrees(7) if name == "Random Forest" else small.setMaxIter(4)
    monkeypatch.setattr(pooled, "regressor", lambda _: small.setMaxDepth(4))
    fitted = pooled.fit_pooled(rows, name)
    model = fitted.stages[-1]
    nodes = trees.node_table(model, spark)
    assert nodes.count() == sum(t.numNodes for t in model.trees)
    assert nodes.where("left >= 0 AND threshold IS NULL").isEmpty()
    answers = fitted.transform(rows)
    routed = trees.leaves(answers, nodes, len(model.trees), 4)
    weights = dict(enumerate(model.treeWeights))
    scale = sum(weights.values()) if name == "Random Forest" else 1.0
    sums = {}
    for x in routed.collect():
        key = x.series, x.date, x.predicted
        sums[key] = sums.get(key, 0.0) + weights[x.tree] * x.prediction / scale
    assert len(sums) == answers.count()
    for (_, _, expected), found in sums.items():
        assert found == pytest.approx(expected, rel=1e-9)


def test_leaf_means_of_a_tree_without_resampling(spark, rows, monkeypatch):
    first = pooled.regressor("GBT").setMaxIter(1).setMaxDepth(3)
    monkeypatch.setattr(pooled, "regressor", lambda _: first)
    train = rows.where("split = 'train'")
    fitted = pooled.fit_pooled(rows, "GBT")
    routed = trees.leaves(fitted.transform(train), trees.node_table(fitted.stages[-1], spark), 1, 3)
    found = trees.leaf_statistics(routed).collect()
    assert sum(x.n for x in found) == train.count() and len(found) > 3
    for x in found:  # the first tree of boosting learns from every row once
        assert x.prediction == pytest.approx(x.mean, rel=1e-9)


def test_partitions_grow_slowly(spark, rows, make_series, monkeypatch):
    """As before up to 32 partitions; then none for each few rows, as each costs statistics."""
    assert [pooled.placements(n) for n in (0, 19_999, 20_000, 533_473)] == [1, 1, 2, 27]
    assert [pooled.placements(n) for n in (3_200_000, 32_000_000, 192_000_000)] == [32, 33, 193]
    monkeypatch.setattr(pooled, "ROWS_PER_PARTITION", 10)
    monkeypatch.setattr(pooled, "PARTITIONS", 4)
    r = np.random.default_rng(6)
    frame = make_series(a=100 + r.normal(size=120).cumsum(), b=40 + r.normal(size=90).cumsum())
    found = pooled.training_rows(frame)
    assert found.rdd.getNumPartitions() == 4
    assert sorted(found.collect()) == sorted(rows.collect())


def test_fits_gather_small_partitions(rows, make_series, monkeypatch):
    monkeypatch.setattr(pooled, "ROWS_PER_PARTITION", 20)
    r = np.random.default_rng(6)
    frame = make_series(**{c: 50 + r.normal(size=60).cumsum() for c in "abcdef"})
    train = pooled.training_rows(frame).where("split = 'train'")
    assert train.rdd.getNumPartitions() == 19
    monkeypatch.setattr(pooled, "FIT_ROWS", 50)
    few = pooled.gathered(train)
    assert few.rdd.getNumPartitions() == train.count() // 50 + 1 < 19
    assert sorted(few.collect()) == sorted(train.collect())
    monkeypatch.setattr(pooled, "FIT_ROWS", 10)  # each has rows enough: left as they are
    assert pooled.gathered(train) is train
    alone = rows.where("split = 'train'")
    assert pooled.gathered(alone) is alone
