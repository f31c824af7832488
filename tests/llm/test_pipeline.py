"""The pipeline, each stage against brute force on what the one before it kept."""

import base64
import hashlib
import random
import re

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from llm.frames import written  # noqa: E402

from test_decontaminate import brute as contaminated  # noqa: E402
from test_jaccard_join import brute as linked  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(4)
    words = ["".join(r.choice("aeioulnrst") for _ in range(r.randrange(2, 9))) for _ in range(400)]

    def prose(n):
        return " ".join(r.choice(words) for _ in range(n)) + "."
    texts = [prose(r.randrange(20, 120)) for _ in range(150)]
    texts += [t.replace(" ", "  ", 3) for t in texts[:20]]
    texts += [t.replace(texts[0].split()[0], "changed", 1) + " more" for t in texts[20:40]]
    items = [(i, prose(14)) for i in range(5)]
    texts += [f"{prose(30)} {items[i % 5][1]} {prose(30)}" for i in range(10)]
    texts += [prose(60).replace(" ", "*** ") for _ in range(80)] + [None, "", "   "]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[0], (None, "no id but text of its own kind", "en", "s", 3)]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int("***" not in (t or "")), 0) for i, t in enumerate(texts) if i % 2],
                          "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), items


def test_stages(spark, folder):
    path, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = written(stage(spark, docs, path), "test-stage")
        kept[name] = [(r.doc_id, r.text) for r in before.collect()], docs.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before.columns and docs.dtypes == before.dtypes

    given, out = kept["quality classifier"]
    junk = {i for i, t in given if t and "***" in t}
    assert len(junk - {r.doc_id for r in out}) > 0.8 * len(junk)
    assert {i for i, t in given if t and len(t) > 40} - junk <= {r.doc_id for r in out}

    given, out = kept["exact dedup"]
    least = {}
    for i, t in given:
        key = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        least[key] = min((x for x in (least.get(key, i), i) if x is not None), default=None)
    assert sorted(map(repr, least.values())) == sorted(repr(r.doc_id) for r in out)

    given, out = kept["n-gram Jaccard join"]
    stay = [i for i, _, c in linked(given, 5, 80, 100) if c is None or i == c]
    assert sorted(map(repr, stay)) == sorted(repr(r.doc_id) for r in out)
    assert len(stay) < len(given)

    given, out = kept["benchmark decontamination"]
    clean = [x[0] for x in contaminated(given, items) if not x[5]]
    assert sorted(map(repr, clean)) == sorted(repr(r.doc_id) for r in out)
    assert len(clean) < len(given)

    tiktoken = pytest.importorskip("tiktoken")
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    given, out = kept["byte-level BPE"]
    texts = dict(given)
    assert len(out) == len(given)
    for r in out:
        ids = np.array(plain.encode_ordinary(texts[r.doc_id] or ""), dtype="<u4").tobytes()
        assert bytes(r.ids) == ids and r.n_tokens == len(ids) // 4
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_run_is_the_stages_in_order(spark, folder, monkeypatch):
    calls = []

    def stage(name):
        def run(session, docs, sf_dir):
            calls.append(name)
            return docs.limit(3)
        return run
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, stage(n)) for n in "abc"])
    assert corpus_pipeline.run(spark, folder[0]).count() == 3
    assert calls == ["a", "b", "c"]
