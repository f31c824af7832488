"""Links of secrets to all their partners."""

import re

from llm import secret_scan as S

KEYS = ["Zm9vYmFyQmF6MTIzNDU2Nzg5", "QmF6Zm9vYmFyOTg3NjU0MzIx", "YWJjREVGZ2hpSktMNTY3ODkw"]


def links(make_docs, text):
    """{secret: (nearest, number, all text from the first partner to the last)}"""
    found, = S.scan_secrets(make_docs([(1, text)])).collect()
    out = {}
    for link in found.links:
        a, b, kind, c, d, n, first, last = re.fullmatch(
            r"secret:(\d+):(\d+)-(\w+):(\d+):(\d+)-(\d+):(\d+):(\d+)", link).groups()
        out[text[int(a):int(b)], kind] = (text[int(c):int(d)], int(n), text[int(first):int(last)])
    return out, found


def test_each_secret_of_a_list_meets_its_own_and_all_identifiers(make_docs):
    users = ["user=alice99", "user=bob77", "user=carol5"]
    for order in (1, -1):  # identifiers first, or secrets first
        lines = [x for u, k in zip(users, KEYS) for x in (u, f"key {k}")[::order]]
        text = "\n".join(lines)
        found, row = links(make_docs, text)
        every = text[text.index(users[0]):text.index(users[-1]) + len(users[-1])]
        assert found == {(k, "identifier"): (u, 3, every) for u, k in zip(users, KEYS)}
        assert row.spans.count("identifier:") == 3


def test_parts_far_apart_in_a_paragraph(make_docs):
    far = " pad" * 100
    text = f"user=alice99{far}\nkey {KEYS[0]}{far}\nat https://db.example/x\n\nuser=bob77"
    found, row = links(make_docs, text)
    assert found == {(KEYS[0], "identifier"): ("user=alice99", 1, "user=alice99"),
                     (KEYS[0], "endpoint"): ("https://db.example/x", 1, "https://db.example/x")}
    assert [x.split(":")[0] for x in row.spans.split(",")] == ["identifier", "secret", "endpoint"]
    assert row.n_linked == 3
