import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import link_counts
from llm.jaccard_join import Threshold


def sets_of(n, seed, topics):
    """Sets around some topics, of very different sizes."""
    r = random.Random(seed)
    bases = [r.sample(range(10 ** 6), r.randrange(5, 60)) for _ in range(topics)]
    found = []
    for _ in range(n):
        base = r.choice(bases)
        own = {x for x in base if r.random() > 0.08} | {r.randrange(10 ** 6)}
        found.append(np.array(sorted(own), dtype=np.uint64))
    return found


def test_intersections_match_plain_sets():
    sets = sets_of(60, 1, 4)
    plain = [set(s.tolist()) for s in sets]
    every = slice(None)
    found = link_counts.intersections(sets, every, every)
    assert all(found[i, j] == len(a & b) for i, a in enumerate(plain)
               for j, b in enumerate(plain) if i != j)
    sided = link_counts.intersections(sets, slice(20), slice(20, None))
    assert (sided == found[:20, 20:]).all()


@pytest.mark.parametrize("topics, num, leaf", [(1, 80, 10), (12, 70, 10), (40, 90, 8), (5, 50, 200)])
def test_every_link_is_counted_once(spark, topics, num, leaf):
    """One dense region, many divided ones, and a region in one leaf, all by weight."""
    sets = sets_of(240, topics, topics)
    threshold = Threshold(num, 100)
    weights = [1 + i % 3 for i in range(len(sets))]
    rows = spark.createDataFrame(
        [(7, i, weights[i], bytearray(s.tobytes())) for i, s in enumerate(sets)],
        "region long, cid long, weight long, elements binary")
    found = link_counts.links(rows, threshold, leaf)
    degrees = dict(found.where("cid IS NOT NULL").groupBy("cid").agg(F.sum("links")).collect())
    plain = [set(s.tolist()) for s in sets]
    linked = {(i, j) for i, a in enumerate(plain) for j, b in enumerate(plain)
              if i != j and 100 * len(a & b) >= num * len(a | b)}
    expected = {}
    for i, j in linked:
        expected[i] = expected.get(i, 0) + weights[j]
    assert degrees == expected
    edges = {tuple(r) for r in found.where("a IS NOT NULL").select("a", "b").collect()}
    assert edges <= linked and len({x for e in edges for x in e}) == len(expected)
