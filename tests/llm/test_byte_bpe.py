import base64
import hashlib
import random

import numpy as np
import pytest

from llm import byte_bpe as B

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    tiktoken = pytest.importorskip("tiktoken")
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    r = random.Random(1)
    return ["a" * 20_000, "ab" * 3000 + "  \n\n x'll don't '  ", "日本語🙂🙂 x\x1c\x85 ½²³",
            "<|endoftext|>", "".join(r.choice("abc \n'st1½é_\x1c-") for _ in range(5000)),
            "".join(chr(r.randrange(1, 0xD7FF)) for _ in range(5000))]


def test_same_ids_and_round_trip(make_docs, awkward, reference):
    rows = awkward + [(100 + i, t) for i, t in enumerate(texts())]
    want = []
    for i, t in rows:
        ids = np.array(reference.encode_ordinary(t or ""), dtype="<u4").tobytes()
        want.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    found = B.round_trip(make_docs(rows), PATH, P.PATTERN).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)


def test_known_words_stay_bounded(monkeypatch, reference):
    monkeypatch.setattr(B, "CACHE_ENTRIES", 5)
    with open(PATH, "rb") as f:
        own = B.Codec(f.read(), P.PATTERN)
    text = " ".join(f"word{i % 9}xyz{i % 7}" for i in range(200))
    assert np.frombuffer(own.encode(text), "<u4").tolist() == reference.encode_ordinary(text)
    assert len(own.known) <= 5 and len(own.known.older) <= 5


def test_empty(make_docs):
    assert B.round_trip(make_docs([]), PATH, P.PATTERN).collect() == []
