import random
import zlib

import numpy as np
import pytest

from llm import quality as Q


def prose(r, n):
    return " ".join("".join(r.choice("aeioulnrst") for _ in range(r.randrange(2, 9)))
                    for _ in range(n)) + "."


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(2)
    rows = []
    for i in range(260):
        good = i % 3 > 0
        text = prose(r, r.randrange(5, 200))
        rows.append((i, text if good else text.replace(" ", "*** "), int(good)))
    return rows


@pytest.fixture(scope="module")
def network(corpus):
    return Q.fit([t.encode() for _, t, _ in corpus], [y for _, _, y in corpus],
                 np.ones(len(corpus)), epochs=6)


def test_gradient():
    """Back propagation agrees with finite differences."""
    r = np.random.default_rng(0)
    texts = [bytes(r.integers(1, 255, n, dtype=np.uint8)) for n in (30, 700, 0)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    parts, first = Q.segments(data, offsets)
    y, weight = np.array([1, 0, 1], np.float32), np.array([1, 2, 1], np.float32)
    w = {k: v.astype(np.float64) for k, v in Q.start(3).items()}

    def loss():
        p, _ = Q.combined(w, Q.pooled(w, parts), first, np.diff(offsets))
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / weight.sum()
    for name, g in Q._gradient(w, parts, first, np.diff(offsets), y, weight).items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        keep, step = w[name][at], 1e-5
        w[name][at] = keep + step
        high = loss()
        w[name][at] = keep - step
        slope = (high - loss()) / (2 * step)
        w[name][at] = keep
        assert g[at] == pytest.approx(slope, rel=0.03, abs=1e-3)


def test_learns_and_covers_whole_texts(network, corpus):
    r = random.Random(9)
    fresh = [(prose(r, 120), 1) for _ in range(40)] + \
        [(prose(r, 120).replace(" ", "*** "), 0) for _ in range(40)]

    def score(texts):
        data = [t.encode() for t in texts]
        return Q.score_block(network, np.frombuffer(b"".join(data), np.uint8),
                             np.concatenate(([0], np.cumsum([len(t) for t in data]))))
    p = score([t for t, _ in fresh])
    assert ((p >= 0.5) == [y for _, y in fresh]).mean() > 0.95
    long = prose(r, 3000)
    assert score([long])[0] != score([long[:-200] + "*** " * 50])[0]
    together = score([fresh[0][0], "", long])
    assert together == pytest.approx([score([t])[0] for t in (fresh[0][0], "", long)], abs=1e-5)


def test_judged(spark, make_docs, awkward, corpus):
    labels = spark.createDataFrame(
        [(i, y, 0) for i, _, y in corpus] + [(None, 1, 0), (999, None, 0), (1, 7, 0)],
        "doc_id long, quality int, toxic int")
    docs = make_docs([(i, t) for i, t, _ in corpus] + awkward)
    found = Q.judged(docs, labels).collect()
    assert len(found) == len(corpus) + len(awkward)
    for r in found:
        own = "" if r.doc_id is None else str(r.doc_id)
        assert r.held_out == (zlib.crc32(own.encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_sample_is_bounded(spark, make_docs, corpus, monkeypatch):
    seen = []
    monkeypatch.setattr(Q, "fit", lambda texts, labels, weights: seen.append(
        (texts, labels, weights)) or Q.start())
    labels = spark.createDataFrame([(i, y) for i, _, y in corpus], "doc_id long, quality int")
    Q.train(make_docs([(i, t) for i, t, _ in corpus]), labels, rows=30, size=8000)
    texts, y, weights = seen[0]
    assert sum(map(len, texts)) <= 8000 and max(y.count(0), y.count(1)) <= 30


def test_without_labels_or_rows(spark, make_docs, awkward):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in Q.judged(make_docs(awkward), none).collect()} == {0.5}
    assert Q.judged(make_docs([]), none).collect() == []
    docs = make_docs(awkward)
    assert Q.sifted(docs, none).count() == len(awkward)
    assert Q.sifted(docs, none).columns == docs.columns
