"""Secret scan with multipart credential linking.

Base findings are single strings that look like secrets by themselves. A credential often
has several parts, an access identifier, a secret and an endpoint, and some parts only look
suspicious beside the others. Those weak candidates are found per kind as intervals of a
text and interval-joined within scopes: the paragraph, or with ``reach`` at most so many
characters around a part in it. A weak candidate is reported only where complementary parts co-occur.
"""

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from llm.frames import mapped

# The base patterns and the smallest length of what must match.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs of fewer than 16 fail
LEAST = {"assign": 12, "access": 18}

#: Weak candidates: each means something only beside its complements.
IDENTIFIER = re.compile(
    r"""(?:access_?key_?id|client_?id|user_?name|user|login|account)["']?\x20*[:=]\x20*["']?"""
    r"""[A-Za-z0-9@._-]{4,}""", re.ASCII | re.IGNORECASE)
SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
ADDRESS = re.compile(r"""[^\s"'<>]+""")
OPAQUE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
PARAGRAPH = re.compile(r"\n[\x20\t]*\n")

#: Kinds in the order in which spans of one start are listed.
KINDS = ["assign", "access", "hex", "identifier", "secret", "endpoint"]
REACH = 200


def addresses(text):
    """Spans of ``[A-Za-z][A-Za-z0-9+.-]*://`` and what follows up to a space, quote or bracket.

    Found from ``://`` to the left, so that a long run of letters is read once and not again
    from each of its letters.
    """
    spans, end, at = [], 0, text.find("://")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in SCHEME:
            start -= 1
        while start < at and not text[start].isalpha():
            start += 1
        rest = ADDRESS.match(text, at + 3) if start < at else None
        if rest:
            end = rest.end()
            spans.append((start, end))
        at = text.find("://", end if rest else at + 1)
    return spans


def base_spans(text):
    """{kind: [(start, end)]} of the base patterns, in code points."""
    found = {"assign": [], "access": [], "hex": []}
    if ":" in text or "=" in text:
        found["assign"] = [m.span() for m in ASSIGN.finditer(text)
                           if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found["access"] = [m.span() for m in ACCESS.finditer(text)
                           if m.end() - m.start() >= LEAST["access"]]
    found["hex"] = [m.span() for m in HEX.finditer(text)]
    return found


def _opaque(word):
    """Letters of both cases and digits: not a word of prose."""
    return (any(c.isdigit() for c in word) and any(c.islower() for c in word)
            and any(c.isupper() for c in word))


def _apart(spans, taken):
    """The spans that overlap none of the taken ones (sorted, disjoint)."""
    if not spans or not taken:
        return spans
    ends, starts = np.array([e for _, e in taken]), np.array([s for s, _ in taken])
    lo = np.searchsorted(ends, [s for s, _ in spans], "right")
    hi = np.searchsorted(starts, [e for _, e in spans], "left")
    return [x for x, a, b in zip(spans, lo, hi) if a >= b]


def interval_join(left, right, low, high):
    """For each left span, the range of right spans that overlap (low, high) around it.

    Spans of one side are sorted and disjoint, so the partners are one range: no pairs are
    made, whatever their number.
    """
    starts = np.array([s for s, _ in right], dtype=np.int64)
    ends = np.array([e for _, e in right], dtype=np.int64)
    return np.searchsorted(ends, low, "right"), np.searchsorted(starts, high, "left")


def _merged(*lists):
    """Union of spans as sorted disjoint spans."""
    out = []
    for s, e in sorted(x for spans in lists for x in spans):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def linked_parts(text, base, reach=REACH):
    """Weak candidates with complements in their scope, and the links between parts."""
    weak = {"identifier": [], "secret": [], "endpoint": []}
    if "://" in text:
        weak["endpoint"] = addresses(text)
    if ":" in text or "=" in text:
        weak["identifier"] = [m.span() for m in IDENTIFIER.finditer(text)]
    certain = _merged(base["assign"], base["hex"])
    weak["identifier"] = _apart(weak["identifier"], _merged(certain, base["access"]))
    if weak["endpoint"] or weak["identifier"] or base["access"]:
        strings = [m.span() for m in OPAQUE.finditer(text) if _opaque(m[0])]
        weak["secret"] = _apart(strings, _merged(
            certain, base["access"], weak["identifier"], weak["endpoint"]))
    identifiers = _merged(base["access"], weak["identifier"])
    secrets = _merged(certain, weak["secret"])
    endpoints = weak["endpoint"]
    if sum(map(bool, (identifiers, secrets, endpoints))) < 2:
        return {k: [] for k in weak}, []
    breaks = np.array([0] + [m.end() for m in PARAGRAPH.finditer(text)] + [len(text) + 1])

    def near(spans, others):
        starts = np.array([s for s, _ in spans], dtype=np.int64)
        ends = np.array([e for _, e in spans], dtype=np.int64)
        scope = np.searchsorted(breaks, starts, "right")
        low, high = breaks[scope - 1], breaks[np.minimum(scope, len(breaks) - 1)]
        if reach is not None:
            low, high = np.maximum(starts - reach, low), np.minimum(ends + reach, high)
        return interval_join(spans, others, low, high)

    beside = {}
    for name, spans, complements in (
            ("identifier", weak["identifier"], (secrets,)),
            ("secret", weak["secret"], (identifiers, endpoints)),
            ("endpoint", endpoints, (identifiers, secrets))):
        flags = [np.less(*near(spans, others)) for others in complements]
        keep = flags[0] if len(flags) == 1 else \
            flags[0] | flags[1] if name == "secret" else flags[0] & flags[1]
        beside[name] = [x for x, ok in zip(spans, keep) if ok]
    links = []
    for other, others in (("identifier", identifiers), ("endpoint", endpoints)):
        lo, hi = near(secrets, others)
        for i, at in _nearest(text, secrets, others, lo, hi, breaks):
            links.append((secrets[i], other, others[at], int(hi[i] - lo[i]),
                          (others[lo[i]][0], others[hi[i] - 1][1])))
    return beside, links


def _nearest(text, spans, others, lo, hi, breaks):
    """(span, partner) for each span with partners lo..hi: the one the fewest lines away.

    Of the ones before and after at equal distance it is the one before where the paragraph
    begins with a partner, else the one after.
    """
    own = np.flatnonzero(hi > lo)
    if not len(own):
        return
    lines = np.array([m.start() for m in re.finditer("\n", text)], dtype=np.int64)
    starts, places = np.array([s for s, _ in spans]), np.array([s for s, _ in others])
    at = np.searchsorted(places, starts[own])
    before, after = (np.clip(x, lo[own], hi[own] - 1) for x in (at - 1, at))
    line = np.searchsorted(lines, starts[own])
    back, ahead = (abs(np.searchsorted(lines, places[x]) - line) for x in (before, after))
    begin = breaks[np.searchsorted(breaks, starts[own], "right") - 1]
    leads = places[np.searchsorted(places, begin)] < starts[np.searchsorted(starts, begin)]
    yield from zip(own.tolist(), np.where((back < ahead) | (back == ahead) & leads,
                                          before, after).tolist())


def _listed(spans):
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(
        (s, KINDS.index(k), e, k) for k, found in spans.items() for s, e in found))


_OUT = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
        "spans string, n_linked long, links array<string>")


def _scan(reach):
    def scan(batches):
        for batch in batches:
            out = [[] for _ in range(8)]
            for key, text in zip(batch.column("doc_id").to_pylist(),
                                 batch.column("text").to_pylist()):
                base = base_spans(text or "")
                parts, links = linked_parts(text or "", base, reach)
                row = (key, len(base["assign"]), len(base["access"]), len(base["hex"]),
                       hashlib.sha256(_listed(base).encode()).hexdigest(),
                       _listed(base | parts), sum(map(len, parts.values())),
                       [f"secret:{a}:{b}-{kind}:{c}:{d}-{n}:{first}:{last}"
                        for (a, b), kind, (c, d), n, (first, last) in links])
                for column, value in zip(out, row):
                    column.append(value)
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types)],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_linked",
                 "links"])
    return scan


def scan_secrets(docs, reach=None):
    """One row for each row of ``docs(doc_id, text)``; other columns are left out.

    ``n_assign``, ``n_access``, ``n_hex`` count the base findings and ``base_sha256`` digests
    their list of ``kind:start:end``. ``spans`` lists them with the weak candidates that
    were linked. ``links`` joins each secret to the identifiers and to the endpoints in its
    scope, the paragraph or at most ``reach`` characters of it: the span of the nearest one,
    then the number of all of them, the start of the first and the end of the last; as spans
    of a kind are disjoint, all of them lie in that range and no other does. Places are code points, ends exclusive. Null text counts as empty, a null
    ``doc_id`` and repeated rows stay as they are, an empty table gives an empty result.
    """
    pairs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return mapped(pairs, _scan(reach), _OUT)
