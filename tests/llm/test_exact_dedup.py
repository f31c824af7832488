import hashlib
import re

import pytest

from llm import exact_dedup as E


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    out = []
    for text, ids in groups.items():
        least = min((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, least, len(ids), sha) for i in ids]
    return sorted(out, key=repr), len(groups)


@pytest.mark.parametrize("table_bytes", [16 << 20, 700])
def test_matches_brute_force(make_docs, awkward, monkeypatch, table_bytes):
    """Small tables fill up, so that texts go through several levels."""
    monkeypatch.setattr(E, "TABLE_BYTES", table_bytes)
    rows = awkward + [(100 + i, f"copy {i % 40}") for i in range(200)]
    found = E.exact_dedup(make_docs(rows)).collect()
    want, groups = brute(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found),
                  key=repr) == want
    kept = [r for r in found if r.kept]
    assert len(kept) == groups
    assert all(r.doc_id == r.keep_id for r in kept)


def test_empty(make_docs):
    assert E.exact_dedup(make_docs([])).collect() == []


def test_filter_keeps_columns(make_docs, awkward):
    docs = make_docs(awkward)
    left = E.deduplicated(docs)
    assert left.columns == docs.columns
    assert left.count() == brute(awkward)[1]


def test_table_compares_whole_texts():
    table = E.OpenTable(1 << 20)
    same = b"\x01" * 32
    first = table.add(~table.place(same, b"a"), same, b"a", None)
    assert table.place(same, b"a") == first
    assert table.place(same, b"b") < 0
