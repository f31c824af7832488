"""Byte-level BPE encoding and decoding with a rank queue.

Merges of one pre-token are taken from a queue over merge ranks: a bucket for each rank
holds the places (in a linked list of pieces) of pairs with that rank, and a bitmap of
two levels tells by find-first-set which rank is the lowest with a bucket. Merging makes
older entries stale; they are skipped when they come up. Each step costs the same however
long the pre-token is.
"""

import base64
import hashlib
import re
from array import array
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import functions as F

from llm.frames import mapped
from llm.words import slices

#: Pre-tokens whose ids a worker keeps in each of two generations, and the longest kept.
CACHE_ENTRIES, CACHE_CHARS = 600_000, 48


def parse_ranks(content):
    """{bytes: rank} of a rank file: base64 and rank on each line."""
    return {base64.b64decode(token): int(rank)
            for token, rank in (line.split() for line in content.splitlines() if line)}


def merged(word, ranks):
    """Ids of one pre-token's bytes."""
    n = len(word)
    get = ranks.get
    after = list(range(1, n + 1))  # where the next piece begins
    before = list(range(-1, n))
    pair = [get(word[i:i + 2], -1) for i in range(n)]  # rank of the pair that begins here
    pair[-1] = -1
    buckets, leaves, top = {}, {}, 0
    for i, rank in enumerate(pair):
        if rank in buckets:
            buckets[rank].append(i)  # in order, so still a heap
        elif rank >= 0:
            buckets[rank] = [i]
    for rank in buckets:
        w = rank >> 8
        leaves[w] = leaves.get(w, 0) | 1 << (rank & 255)
        top |= 1 << w
    while top:
        w = (top & -top).bit_length() - 1
        bits = leaves[w]
        low = bits & -bits
        rank = w << 8 | low.bit_length() - 1
        bucket = buckets[rank]
        i = heappop(bucket)
        if not bucket:
            del buckets[rank]
            bits ^= low
            leaves[w] = bits
            if not bits:
                top ^= 1 << w
        if pair[i] != rank:
            continue  # stale
        j = after[i]
        k = after[j]
        after[i] = k
        before[k] = i
        pair[j] = -1
        at, end = i, after[k] if k < n else 0
        for _ in (0, 1):  # the pair that now begins here, then the one that ends here
            rank = get(word[at:end], -1) if end and at >= 0 else -1
            if at >= 0:
                pair[at] = rank
            if rank in buckets:
                heappush(buckets[rank], at)
            elif rank >= 0:
                buckets[rank] = [at]
                w = rank >> 8
                leaves[w] = leaves.get(w, 0) | 1 << (rank & 255)
                top |= 1 << w
            at, end = before[i], k
    ids, i = [], 0
    while i < n:
        ids.append(ranks[word[i:after[i]]])
        i = after[i]
    return ids


class _Known(dict):
    """Packed ids of pre-tokens, computed when first asked for.

    When the dictionary is full it becomes the older generation, from which what is asked
    for again is taken over; so words that keep coming stay known in bounded memory.
    """

    def __init__(self, ranks):
        super().__init__()
        self.ranks, self.older = ranks, {}

    def __missing__(self, token):
        packed = self.older.get(token)
        if packed is None:
            word = token.encode()
            rank = self.ranks.get(word)
            packed = np.array([rank] if rank is not None else merged(word, self.ranks),
                              dtype="<u4").tobytes()
        if len(token) <= CACHE_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.older = dict(self)
                self.clear()
            self[token] = packed
        return packed


class Codec:
    """Encoder and decoder of one rank table and one pre-token pattern."""

    def __init__(self, content, pattern):
        self.ranks = parse_ranks(content)
        self.pattern = regex.compile(pattern)
        # On ASCII text the letter and number classes are ranges, and re is faster there.
        plain = pattern.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9")
        plain = re.sub(r"(?<!\[\^\\s)(A-Za-z|0-9)\+", r"[\1]+", plain)
        self.ascii = re.compile(plain, re.ASCII) if "\\p" not in plain else self.pattern
        self.known = _Known(self.ranks)
        self.tokens = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token

    def encode(self, text):
        """Ids as little-endian unsigned 32-bit integers."""
        find = self.ascii if text.isascii() else self.pattern
        return b"".join(map(self.known.__getitem__, find.findall(text)))

    def decode(self, packed):
        return b"".join(map(self.tokens.__getitem__, array("I", packed)))


_codecs = {}


def codec(content, pattern):
    """One codec for each worker and table, so that its pre-tokens serve later tasks."""
    key = hashlib.sha256(content).digest(), pattern
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(content, pattern)
    return _codecs[key]


def _encoded(shared, pattern):
    def encode(batches):
        own = codec(shared.value, pattern)
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                packed = [own.encode(t or "") for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(packed, pa.binary())], ["doc_id", "ids"])
    return encode


def _decoded(shared, pattern):
    def decode(batches):
        own = codec(shared.value, pattern)
        for whole in batches:
            for batch in slices(whole, "ids", 1 << 20):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("ids"),
                     pa.array([own.decode(i) for i in batch.column("ids").to_pylist()],
                              pa.binary())], ["doc_id", "ids", "decoded"])
    return decode


def _shared(frame, path):
    with open(path, "rb") as file:  # a vocabulary file beside the driver, about 1 MB
        return frame.sparkSession.sparkContext.broadcast(file.read())


def encode(docs, path, pattern):
    """``doc_id, ids`` for each row of ``docs(doc_id, text)``: ids as packed integers.

    Null text counts as empty, repeated rows and null ids stay as they are, other columns
    are left out; an empty table gives an empty result.
    """
    pairs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return mapped(pairs, _encoded(_shared(docs, path), pattern), "doc_id long, ids binary")


def decode(encoded, path, pattern):
    """Adds ``decoded``, the bytes that the ids stand for, to ``encoded(doc_id, ids)``."""
    return mapped(encoded.select("doc_id", "ids"), _decoded(_shared(encoded, path), pattern),
                  "doc_id long, ids binary, decoded binary")


def encode_decode(docs, path, pattern):
    """``doc_id, ids, decoded``: both ways in one pass, so that one worker knows the words."""
    pairs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    shared = _shared(docs, path)
    there, back = _encoded(shared, pattern), _decoded(shared, pattern)
    return mapped(pairs, lambda batches: back(there(batches)),
                  "doc_id long, ids binary, decoded binary")


def round_trip(docs, path, pattern):
    """The columns of op5: number and digest of the ids, digest of the decoded bytes."""
    return encode_decode(docs, path, pattern).select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
