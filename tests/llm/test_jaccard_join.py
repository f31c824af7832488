import random
import re

import pytest

from llm import jaccard_join as jaccard_module
from llm.components import components
from llm.jaccard_join import jaccard_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    words = WORD.findall("".join(c.lower() if c < "\x80" else c for c in text or ""))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


def brute(rows, k, num, den, count=False):
    sets = [shingles(t, k) for _, t in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, x in enumerate(sets):
        for b, y in enumerate(sets[:a]):
            if x and y and den * len(x & y) >= num * len(x | y):
                parent[root(a)] = root(b)
                links[a] += 1
                links[b] += 1
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[root(a)] = min(i, least.get(root(a), i))
    return sorted(((i, len(s), least.get(root(a)) if s else i) + ((links[a],) if count else ())
                   for a, ((i, _), s) in enumerate(zip(rows, sets))), key=repr)


@pytest.fixture(scope="module")
def copies():
    """A large group of near copies beside unrelated texts of few words."""
    r = random.Random(3)
    base = [r.choice("abcdefgh") + str(r.randrange(40)) for _ in range(60)]
    rows = []
    for i in range(90):
        words = list(base)
        for _ in range(r.randrange(0, 4)):
            words[r.randrange(60)] = f"z{r.randrange(1000)}"
        rows.append((i, " ".join(words)))
    return rows + [(i, " ".join(r.choice(["aa", "bb", "cc", "dd"]) for _ in range(r.randrange(40))))
                   for i in range(90, 180)]


@pytest.mark.parametrize("count", [True, False])
@pytest.mark.parametrize("k, num, sizes", [
    (3, 90, {}), (5, 80, {"common": 3, "members": 5, "leaf": 10}),
    (2, 50, {"common": 4, "members": 1000, "leaf": 16})])
def test_matches_brute_force(make_docs, copies, k, num, sizes, count):
    """Small limits send the group through crowds, cells and blocks."""
    found = jaccard_join(make_docs(copies), k, num, 100, count=count, **sizes).collect()
    assert sorted(map(tuple, found), key=repr) == brute(copies, k, num, 100, count)


def near_copies(n, changes, seed=5):
    r = random.Random(seed)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(n):
        words = list(base)
        for _ in range(changes(r)):
            words[r.randrange(120)] = f"x{r.randrange(10 ** 6)}"
        rows.append((i, " ".join(words)))
    return rows


def test_leaf_rows_grow_with_a_group_of_near_copies(spark, make_docs, monkeypatch):
    """Sets that pivots connected already don't meet one another again."""
    leaves = []
    mapped = jaccard_module.mapped

    def seen(frame, function, schema):
        if "side" in frame.columns and "label" in frame.columns:
            leaves[-1] += frame.count()
        return mapped(frame, function, schema)
    monkeypatch.setattr(jaccard_module, "mapped", seen)
    for n in (200, 400):
        leaves.append(0)
        rows = near_copies(n, lambda r: r.randrange(3))
        found = jaccard_join(make_docs(rows), 3, 80, 100, common=3, members=5, leaf=40,
                             count=False).collect()
        assert sorted(map(tuple, found), key=repr) == brute(rows, 3, 80, 100)
    assert leaves[0] < 4 * 200 and leaves[1] < 4 * 400


@pytest.mark.parametrize("count", [True, False])
@pytest.mark.parametrize("changes", [lambda r: r.randrange(6), lambda r: 4 + r.randrange(4),
                                     lambda r: r.choice([0, 1, 1, 9])])
def test_loose_groups_match_brute_force(make_docs, changes, count):
    """Groups that pivots connect in part, or not at all, in further turns and in blocks."""
    rows = near_copies(220, changes)
    found = jaccard_join(make_docs(rows), 3, 90, 100, common=3, members=5, leaf=12,
                         count=count).collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows, 3, 90, 100, count)


def test_awkward_rows(make_docs, awkward):
    for count in (True, False):
        found = jaccard_join(make_docs(awkward), 3, 90, 100, count=count).collect()
        assert sorted(map(tuple, found), key=repr) == brute(awkward, 3, 90, 100, count)


def test_empty(make_docs):
    assert jaccard_join(make_docs([])).collect() == []


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)],
                                  "a long, b long")
    labels = dict(components(edges).collect())
    assert len({labels[i] for i in range(41)}) == 1
    assert labels[100] == labels[101] != labels[0]


def test_worker_takes_a_bounded_part_of_a_large_batch(monkeypatch):
    """Memory of a worker follows the slice and not the batch that Spark hands over."""
    import tracemalloc

    import pyarrow as pa

    from llm import exact_dedup, words
    monkeypatch.setattr(words, "_powers", {})
    r = random.Random(5)
    texts = [" ".join(str(r.randrange(10 ** 6)) for _ in range(1500)) for _ in range(380)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    assert batch.nbytes > 3_800_000
    for step in (jaccard_module._placed(5, lambda e: e[:10]), exact_dedup._digested):
        tracemalloc.start()
        for _ in step(iter([batch])):
            pass
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 60e6
