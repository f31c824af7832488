import math
import random

import numpy as np
import pytest

from llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank int, block string"


@pytest.fixture(scope="module")
def make(spark):
    def make(rows, parts=3):
        frame = spark.createDataFrame([(*r, 0.5, 1, "b") for r in rows], SCHEMA)
        return frame.repartition(parts) if rows else frame
    return make


def plain(rows, every=100):
    """Every pair, one after another."""
    own = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        own.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in vector], label))
    result = []
    for a, (anchor, q, label) in enumerate(own):
        if anchor is None or anchor % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i is None, i or 0, i, lab != label)
                        for b, (i, v, lab) in enumerate(own) if b != a)
        positives = [(-s[0], s[3]) for s in scored if not s[4]][:5]
        for score, positive in positives:
            some = [s for s in scored if s[4] and 80 * score <= -100 * s[0] <= 100 * score][:5]
            result += [(anchor, positive, r, s[3], score, -s[0]) for r, s in enumerate(some, 1)]
    return sorted(result, key=repr)


def rows(n, d, seed=1, labels=3):
    r = random.Random(seed)
    return [(i, [r.gauss(0.1, 0.2) for _ in range(d)], r.randrange(labels)) for i in range(n)]


def mined(frame, **options):
    return sorted(map(tuple, H.mine(frame, **options).collect()), key=repr)


def test_awkward_rows(make):
    some = rows(400, 6)
    some += [(1000, None, 1), (1001, [0.1, None], 1), (1002, [0.1, float("nan")], 1),
             (1003, [float("inf")] * 6, 1), (1004, [0.5] * 6, None), (1100, [0.2] * 6, 0),
             (None, [0.4] * 6, 0), (None, [0.4] * 6, 1), (1200, [], 2), (1300, [0.3, 0.3], 1),
             (1400, [0.0] * 6, 2), (1500, [-0.2] * 6, 1), (100, some[100][1], some[100][2])]
    some += [(2000 + i, [0.35] * 6, i % 2) for i in range(60)]  # ties
    assert mined(make(some)) == plain(some)


def test_small_segments_and_blocks(make, monkeypatch):
    monkeypatch.setattr(H, "SEGMENT", 16)
    monkeypatch.setattr(H, "ANCHORS", 3)
    some = rows(300, 70, 2)  # more than one word a code
    assert mined(make(some), every=10) == plain(some, 10)


def test_intervals_hold_every_score():
    r = np.random.default_rng(4)
    for d in (1, 3, 64, 100):
        turn = H.rotation(d)
        values = np.concatenate([r.integers(-300, 300, (200, d)), np.zeros((1, d), np.int64),
                                 r.integers(-2**24, 2**24, (5, d)), np.full((1, d), 256)])
        anchors = H.Anchors(values[:40], turn)
        lower, upper = anchors.intervals(*H.coded(values, turn))
        scores = values[:40].astype(object) @ values.T.astype(object)
        assert (lower <= scores).all() and (scores <= upper).all()


def test_filter_narrows_where_vectors_differ():
    """Rows close to the anchor keep the others out, unscored."""
    r = np.random.default_rng(4)
    values = np.concatenate([np.full((20, 64), 100) + r.integers(-9, 9, (20, 64)),
                             r.integers(-100, 100, (2000, 64))])
    turn = H.rotation(64)
    lower, upper = H.Anchors(values[:1], turn).intervals(*H.coded(values, turn))

    class Own:
        pass
    Own.values = values
    some = H._surviving(Own, values[0], np.arange(len(values)), lower[0], upper[0], -np.inf, np.inf, 5)
    assert set(np.argsort(-H.whole_scores(values, values[0]))[:5]) <= set(some) and len(some) < 300


def test_exact_beyond_doubles():
    big = np.full((1, 64), 2**27 - 1)
    assert H.whole_scores(big, big[0])[0] == 64 * (2**27 - 1) ** 2


def test_empty(make):
    assert H.mine(make([])).collect() == []
    assert H.mine(make([(1, [0.1], 1)])).collect() == []
