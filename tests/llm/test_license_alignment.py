"""Licence templates against an alignment of every template at every place."""

import random
import re

from llm import license_scan as L

from test_text_scans import WORD


def split(text):
    return WORD.findall("".join(c.lower() if c < "\x80" else c for c in text))


def brute(text):
    """{template: coverage} of the best window, over all places."""
    words, found = split(text), {}
    for name, (body, keys) in L.TEMPLATES.items():
        body = split(body)
        for low in range(-len(body) // 3 * 3 - 6, len(words) + 6, 3):
            near = words[max(0, low - 3):max(0, low + 9 + len(body))]
            padded = " " + " ".join(near) + " "
            if not all(f" {k} " in padded for k in keys):
                continue
            hit = sum(any(0 <= f + q < len(words) and words[f + q] == w
                          for f in range(low, low + 6)) for q, w in enumerate(body)) / len(body)
            if hit >= L.COVER:
                found[name] = max(hit, found.get(name, 0))
    return found


def files():
    r = random.Random(7)
    names = sorted(L.TEMPLATES)
    full = {n: re.sub(r"\s+", " ", L.TEMPLATES[n][0]) for n in names}
    rare = "mozilla sublicense disclaimer merchantability attribution creative merge hereby " \
           "obtaining modification binary international purpose fee either option gnu mpl"

    def prose(n):
        return " ".join(r.choice((rare + " the of to and a in word text").split())
                        for _ in range(n))
    yield "\n\n".join(full[n] for n in ("mit-text", "bsd-text", "gpl-notice", "mpl-notice"))
    yield "\n\n".join(full[n] for n in names)
    for n in names:
        yield f"{prose(150)} {full[n]} {prose(150)}"
    for _ in range(30):  # words lost, changed and put in
        parts = []
        for n in r.sample(names, r.randrange(1, 5)):
            words = full[n].split()
            for _ in range(r.randrange(0, 12)):
                at = r.randrange(len(words))
                words[at:at + r.randrange(0, 2)] = r.choice([["x"], [rare.split()[r.randrange(9)]]])
            parts.append(" ".join(words))
        yield f" {prose(20)} ".join(parts)


def test_every_template_is_found_as_by_brute_force(make_docs):
    texts = list(files())
    found = {x.doc_id: x for x in L.scan_licenses(make_docs(list(enumerate(texts)))).collect()}
    several = 0
    for i, text in enumerate(texts):
        want = brute(text)
        several += len(want) > 2
        own = {p.split(":")[0]: p.split(":")[2] for p in found[i].places}
        assert own == {n: f"{c:.3f}" for n, c in want.items()}, i
    assert several >= 5
    assert {"mit-text", "bsd-text", "gpl-notice", "mpl-notice"} <= set(found[0].labels.split(","))
    assert set(L.TEMPLATES) <= set(found[1].labels.split(","))
