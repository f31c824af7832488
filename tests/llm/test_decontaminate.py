import hashlib
import re

import pytest

from llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c < "\x80" else c for c in text or ""))


def brute(docs, items, slop=D.SLOP):
    windows = []
    for item, text in items:
        w = words(text)
        windows += [(item, w[i:i + 10]) for i in range(max(1, len(w) - 9) if w else 0)]
    out = []
    for doc_id, text in docs:
        w, hit, exact, near = words(text), set(), set(), set()
        for item, x in windows:
            for s in range(len(w) - len(x) + 1):
                if w[s:s + len(x)] == x:
                    hit.update(range(s, s + len(x)))
                    exact.add(item)
                if all(word in w[max(0, s + k - slop):s + k + slop + 1]
                       for k, word in enumerate(x)):
                    near.add(item)
        ids = sorted(str(i) for i in exact if i is not None)
        out.append((doc_id, len(w), len(hit), len(ids),
                    hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit),
                    len([i for i in near if i is not None])))
    return sorted(out, key=repr)


ITEMS = [(1, "the quick brown fox jumps over the lazy dog and runs far away today"),
         (2, "short item"), (3, None), (4, "..."), (None, "nameless phrase here"),
         (5, "one two three four five six seven eight nine ten"), (5, "short item"), (12, "É a")]
DOCS = [(1, "Before. The quick brown fox jumps over the lazy dog, and runs far away today!"),
        (2, "the quick brown fox jumps over the dog lazy and runs far"), (3, "short"),
        (4, "item"), (5, "a SHORT  item; short-item"), (6, "nameless phrase here"),
        (7, "one two three four five six seven eight nine ten " * 30),
        (8, "two one four three six five eight seven ten nine"), (9, "É a")]


@pytest.mark.parametrize("segment_bytes, block_words", [(2 << 20, 400_000), (60, 3)])
def test_matches_brute_force(spark, make_docs, segment_bytes, block_words):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = D.decontaminate(make_docs(DOCS, 2), benchmark, segment_bytes=segment_bytes,
                            block_words=block_words).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute(DOCS, ITEMS)


def test_awkward_rows(spark, make_docs, awkward):
    items = [(1, "w1 w2"), (2, "x"), (3, awkward[-1][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = D.decontaminate(make_docs(awkward), benchmark).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute(awkward, items)


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert D.decontaminate(make_docs([]), some).collect() == []
    assert not any(r.contaminated for r in D.decontaminate(make_docs(DOCS), none).collect())


def test_candidates_in_parts():
    """Few candidates at a time give the same matches."""
    import numpy as np
    pieces = [w for _, text in ITEMS if (w := [x.encode() for x in words(text)])]
    vocabulary = sorted({x for w in pieces for x in w})
    phrases = D.Phrases([""] * len(pieces), b" ".join(vocabulary),
                        np.array([vocabulary.index(x) for w in pieces for x in w], "<u4").tobytes(),
                        np.array([len(w) for w in pieces], "<u4").tobytes())
    seg = D.Segment([3, 4], b"a item short", np.array([3, 2, 2], "<u4").tobytes(),
                    np.array([0, 1, 4, 2, 4, 3, 1], "<u4").tobytes())

    def all_(n):
        return sorted((int(p), int(s), e) for ps, ss, e in D.find(seg, phrases, 2, n)
                      for p, s in zip(ps, ss))
    assert all_(1) == all_(1000)


def test_one_very_long_item(spark, make_docs):
    """An item of 10**6 words is dealt to many blocks; matches cross the edges of its pieces."""
    item = [f"w{i}" for i in range(10 ** 6)]
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, "w5 w6")], "item_id long, text string")
    blocks, number = D.item_blocks(benchmark, block_words=100_000)
    assert number >= 10 and blocks.count() > 1
    edge = D.PIECE_WINDOWS
    docs = [(1, " ".join(item[edge - 30:edge + 40])), (2, " ".join(item[-12:])),
            (3, " ".join(item[edge - 9:edge])), (4, "x " + " ".join(item[edge:edge + 10])),
            (5, " ".join(item[:20]))]
    found = D.decontaminate(make_docs(docs), benchmark, block_words=100_000)
    assert {r.doc_id: (r.n_hit, r.n_items) for r in found.collect()} == {
        1: (70, 1), 2: (12, 1), 3: (0, 0), 4: (10, 1), 5: (20, 2)}
