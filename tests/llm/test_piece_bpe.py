import hashlib
import random

import pytest

from llm import piece_bpe as B

P = pytest.importorskip("public_tokenizers")
PATH = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def own():
    with open(PATH, "rb") as f:
        return B.Codec(f.read())


def texts():
    r = random.Random(1)
    return ["", " ", "   ", "a" * 20_000, "ab" * 3000 + "  \n\n x'll don't '  ", "▁▁a ▁ b▁",
            "日本語🙂🙂 x\x1c\x85 ½²³ \x00z﻿�", "<s></s><unk><0x41>", "\n\nx", "\tx\r\n",
            " " * 3000 + "x", "=" * 777 + "-" * 333, "".join(r.choice("aeinorst") for _ in range(30_000)),
            "".join(r.choice("abc \n'st1½é_\x1c-") for _ in range(5000)),
            "".join(chr(r.randrange(1, 0xD7FF)) for _ in range(5000))]


def ids(packed):
    return [int.from_bytes(packed[i:i + 4], "little") for i in range(0, len(packed), 4)]


def test_same_as_the_library(own, library):
    r = random.Random(7)
    many = texts()
    for _ in range(1500):
        letters = r.choice(["ab ", "etaoin shrdlu", "▁ .", "01 23\n", "abAB.,é 日", "-= \t", "thein g "])
        many.append("".join(r.choice(letters) for _ in range(r.randrange(40))))
    found = own.encode(many)
    for text, packed in zip(many, found):
        want = library.encode(text, num_threads=1)
        assert ids(packed) == want, text[:60]
        assert own.decode(want).decode() == library.decode(want), text[:60]


def test_decodes_any_ids_as_the_library(own, library):
    r = random.Random(3)
    for _ in range(2000):
        some = [r.choice([r.randrange(0, 300), r.randrange(32000), 28705]) for _ in range(r.randrange(1, 8))]
        assert own.decode(some).decode() == library.decode(some), some


def test_table(make_docs, awkward, library):
    rows = awkward + [(100 + i, t) for i, t in enumerate(texts())]
    want = []
    for i, t in rows:
        found = library.encode(t or "", num_threads=1)
        want.append((i, len(found), hashlib.sha256(",".join(map(str, found)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(found).encode()).hexdigest()))
    got = B.round_trip(make_docs(rows), PATH).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_there_and_back_apart(make_docs, library):
    encoded = B.encode(make_docs([(1, "two words"), (2, None)]), PATH)
    assert {r.doc_id: r.decoded for r in B.decode(encoded, PATH).collect()} == {1: "two words", 2: ""}


def test_ties_and_early_pairs_against_one_merge_at_a_time():
    """Small models whose longer pieces may rank before the shorter ones they are made of."""
    r = random.Random(5)
    for _ in range(60):
        pieces = list({"".join(r.choice("ab") for _ in range(r.randrange(2, 6))) for _ in range(9)})
        scores = {p: -float(r.randrange(6)) for p in pieces}
        model = B.Model(_model(["a", "b", *pieces], [-9.0, -9.0, *(scores[p] for p in pieces)]))
        names = [p for p, _, _ in _pieces(["a", "b", *pieces], [0] * 20)]
        words = ["".join(r.choice("ab") for _ in range(r.randrange(1, 30))) for _ in range(40)]
        found, bounds = model.merged(words)
        for k, word in enumerate(words):
            own = list(word)
            while True:
                best = max(((scores[own[i] + own[i + 1]], -i) for i in range(len(own) - 1)
                            if own[i] + own[i + 1] in scores), default=None)
                if best is None:
                    break
                own[-best[1]:2 - best[1]] = [own[-best[1]] + own[1 - best[1]]]
            assert [names[i] for i in found[bounds[k]:bounds[k + 1]].tolist()] == own, (word, scores)


def _pieces(names, scores):
    special = [("<unk>", 0.0, B.UNKNOWN)] + [(f"<0x{i:02X}>", 0.0, B.BYTE) for i in range(256)]
    return special + [(n, s, B.NORMAL) for n, s in zip(names, scores)]


def _model(names, scores):
    import struct

    def field(number, value):
        if isinstance(value, int):
            return bytes([number << 3 & 127 | (128 if number > 15 else 0)]) + \
                (bytes([number >> 4]) if number > 15 else b"") + bytes([value])
        return bytes([number << 3 | 2, len(value)]) + value
    body = b""
    for name, score, kind in _pieces(names, scores):
        own = field(1, name.encode()) + bytes([2 << 3 | 5]) + struct.pack("<f", score) + field(3, kind)
        body += field(1, own)
    return body + field(2, field(3, B.BPE) + field(35, 1)) + field(3, field(4, 0))


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        B.Model(_model(["a"], [0.0]) + bytes([2 << 3 | 2, 2, 3 << 3, 1]))


def test_known_words_stay_bounded(monkeypatch, library):
    monkeypatch.setattr(B, "CACHE_ENTRIES", 5)
    with open(PATH, "rb") as f:
        own = B.Codec(f.read())
    text = " ".join(f"word{i % 9}xyz{i % 7}" for i in range(200))
    assert ids(own.encode([text])[0]) == library.encode(text)
    assert len(own.known) <= 5 and len(own.known.older) <= 5


def test_empty(make_docs):
    assert B.round_trip(make_docs([]), PATH).collect() == []
