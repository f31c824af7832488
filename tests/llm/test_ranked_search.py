import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from llm import ranked_search as R

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in TERM.findall(text or "")]


def plain(docs, items, k=10):
    held = [(i, Counter(words(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n, total = len(held), sum(x[2] for x in held)
    df = Counter(t for _, c, _ in held for t in c)
    result = []
    for item, text in items:
        scored = []
        for i, c, length in held:
            m = 10 + 90 * length * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                        * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(words(text)) & set(c))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        result += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(result, key=repr)


def corpus(n, seed=3, vocabulary=80, length=60):
    r = random.Random(seed)
    names = [f"t{i}" for i in range(vocabulary)] + ["É", "naïve"]
    weights = [1 / (i + 1) for i in range(len(names))]
    return [(i, " ".join(r.choices(names, weights, k=r.randrange(length)))) for i in range(n)]


@pytest.fixture(scope="module")
def make_items(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, 1, 2, 0.5) for i, t in rows],
                                     "item_id long, text string, item long, block long, score double")
    return make


ITEMS = [(1, "t3 T7 t7 t50"), (2, "É naïve, t0!"), (3, None), (4, ""), (5, "nowhere at-all"), (6, "t1"),
         (6, "t2 t60 t61 t62"), (None, "t9 t10"), (7, " ".join(f"t{i}" for i in range(80)))]


def ranked(docs, items, **options):
    return sorted(map(tuple, R.search(docs, items, **options).collect()), key=repr)


def test_awkward_rows(make_docs, make_items, awkward):
    docs = awkward + corpus(300) + [(900 + i, "t3 t7 same") for i in range(40)]
    assert ranked(make_docs(docs), make_items(ITEMS)) == plain(docs, ITEMS)


def test_many_segments_blocks_and_shared_columns(make_docs, make_items, monkeypatch):
    for name, value in (("DOCUMENTS", 64), ("ITEM_TERMS", 6), ("SHARES", 2), ("CELLS", 2000),
                        ("SLICE_BYTES", 4000)):
        monkeypatch.setattr(R, name, value)
    docs = corpus(600, 5) + [(5000, "t5 " * 30_000 + "t77")]
    assert ranked(make_docs(docs), make_items(ITEMS), size=4) == plain(docs, ITEMS)
    monkeypatch.setattr(R, "WIDTH", 8)  # columns shared by terms: looser bounds, the same result
    assert ranked(make_docs(docs), make_items(ITEMS), size=4, k=3) == plain(docs, ITEMS, 3)


def test_clusters_hold_every_document_once():
    r = np.random.default_rng(1)
    near = np.concatenate([r.normal(size=(90, 8)), np.ones((400, 8))]).astype(np.float32)
    order, begins = R.clusters(near, 16)
    assert sorted(order.tolist()) == list(range(490)) and begins[0] == 0
    lengths = np.diff(np.append(begins, 490))
    assert lengths.min() > 0 and lengths.max() <= 32


def test_blocks_are_skipped_only_by_their_bounds(spark, make_docs, make_items):
    docs = [(i, f"common w{i % 50} w{i % 50}") for i in range(3000)] + [(9000, "rare common w1")]
    items = [(1, "rare w1"), (2, "w7")]
    segments = R.build(make_docs(docs, 1))
    blocks = R.item_blocks(segments, make_items(items))
    stored = R.index(segments, blocks).join(blocks.select("block", "entries"), "block").toArrow()
    scored = total = 0
    for row in range(stored.num_rows):
        at = {c: stored.column(c)[row] for c in stored.schema.names}
        own = R.Segment(at, R.Items(at["entries"].values))
        for i in range(len(own.items.ids)):
            found, used = own.best(i, 10, 0)
            blocks_, bounds = own.bounds(i)
            least = found[-1][0] if len(found) == 10 else 0
            assert (bounds[np.argsort(-bounds)][used:] < max(1, least)).all()
            scored, total = scored + used, total + len(blocks_)
            for b, bound in zip(blocks_.tolist(), bounds.tolist()):
                docs_ = own.members[own.begins[b]:own.ends[b]].astype(np.int64)
                weights = np.zeros(len(own.items.vocabulary), np.int64)
                weights[own.items.terms[i]] = own.items.weights[i]
                assert own.scores(docs_, weights).max() <= bound
    assert 0 < scored <= total


def test_a_very_long_item(make_docs, make_items):
    text = " ".join(f"x{i}" for i in range(60_000))
    docs = [(i, f"x{i} x{i + 1} y") for i in range(200)]
    items = [(1, text), (2, "y x5")]
    assert ranked(make_docs(docs), make_items(items)) == plain(docs, items)


def test_empty(make_docs, make_items):
    assert ranked(make_docs([]), make_items(ITEMS)) == []
    assert ranked(make_docs([(1, "t1")]), make_items([])) == []
    assert ranked(make_docs([(1, None), (2, ". .")]), make_items(ITEMS)) == []


def test_a_row_group_holds_few_segments(make_docs, monkeypatch):
    """Readers and writers hold a row group, so it must not hold all segments of a task."""
    from glob import glob

    import pyarrow.parquet as pq
    monkeypatch.setattr(R, "LONG_ROWS", R.LONG_ROWS | {"parquet.block.size": 4096})
    stored = R.build(make_docs(corpus(6000)).coalesce(1))
    assert stored.count() > 2
    found = [pq.ParquetFile(f).metadata.num_row_groups
             for name in stored.inputFiles() for f in glob(name.removeprefix("file://"))]
    assert sum(found) >= stored.count()
