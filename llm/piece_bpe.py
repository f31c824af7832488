"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

Words of many texts lie behind one another in flat numpy arrays of symbols. In each round
the best pair of every word is found by a segmented minimum over pair ranks, all its
occurrences merge from the left, and the arrays are compacted; words without a pair left
are done. Several occurrences merge in one round only where no pair that arises on the way
would have come first; else the word merges its leftmost one.
"""

import hashlib
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from llm.frames import mapped
from llm.words import slices

#: Words whose ids a worker keeps in each of two generations, and the longest kept.
CACHE_ENTRIES, CACHE_CHARS = 400_000, 48
#: Rank of a pair that no piece joins.
NONE = np.int32(2**31 - 1)
#: Fixed values of the model file's format: field numbers, piece types, model type.
PIECE, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
SPACE = "▁"


def _fields(data):
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, data[at:at + size]
            at += size


def _word_pattern(beside):
    """Cuts a text between characters that no piece has side by side.

    Characters that pieces join, directly or through others, form a class; a word is space
    signs and a run of one class. If a piece has a space sign after another character, the
    whole text is one word.
    """
    if any(b == SPACE != a for a, b in beside):
        return re.compile(".+", re.DOTALL)
    parent = {}

    def root(c):
        parent.setdefault(c, c)
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    for a, b in beside:
        if a != SPACE:
            parent[root(a)] = root(b)
        elif b != SPACE:
            root(b)
    classes = {}
    for c in parent:
        classes.setdefault(root(c), []).append(c)
    runs = sorted((re.escape("".join(sorted(c))) for c in classes.values() if len(c) > 1), key=len)
    runs = "".join(f"|[{run}]+" for run in reversed(runs))
    known = re.escape("".join(sorted(parent)) + SPACE)
    return re.compile(f"{SPACE}*(?:[^{known}]+{runs}|[^{SPACE}])|{SPACE}+", re.DOTALL)


class Model:
    """Pieces and pair ranks of a BPE model with byte fallback and no rewriting of characters."""

    def __init__(self, content):
        pieces, trainer, normalizer = [], {}, {}
        for number, value in _fields(content):
            if number == PIECE:
                own = dict(_fields(value))
                pieces.append((own[1].decode(), struct.unpack("<f", own.get(2, bytes(4)))[0],
                               own.get(3, NORMAL)))
            elif number == TRAINER:
                trainer = dict(_fields(value))
            elif number == NORMALIZER:
                normalizer = dict(_fields(value))
        # 3 model type, 24 space as suffix, 35 byte fallback; 2 rules, 3 prefix, 4 fewer
        # spaces, 5 escaped spaces
        if trainer.get(3, 1) != BPE or not trainer.get(35) or trainer.get(24) \
                or normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1) \
                or any(kind in (USER_DEFINED, UNUSED) for _, _, kind in pieces):
            raise ValueError("only BPE models with byte fallback and identity rules are supported")
        self.prefix = SPACE if normalizer.get(3, 1) else ""
        unknown = trainer.get(44, " ⁇ ".encode())
        self.kinds = np.array([kind for _, _, kind in pieces], np.int8)
        #: Bytes each id stands for.
        self.surface = [
            bytes([int(p[3:5], 16)]) if kind == BYTE else unknown if kind == UNKNOWN
            else b"" if kind == CONTROL else p.replace(SPACE, " ").encode()
            for p, _, kind in pieces]
        self.byte_ids = np.zeros(256, np.int32)
        for i, (p, _, kind) in enumerate(pieces):
            if kind == BYTE:
                self.byte_ids[int(p[3:5], 16)] = i
        self.size = len(pieces)
        symbols = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == NORMAL}
        joined = [p for p in symbols if len(p) > 1]
        for p in joined:
            for c in p:  # a character that is no piece itself is a symbol too
                symbols.setdefault(c, len(symbols) + self.size)
        _, ranks = np.unique([-s for _, s, _ in pieces], return_inverse=True)
        found = [(symbols[p[:k]], symbols[p[k:]], symbols[p]) for p in joined
                 for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols]
        left, right, result = np.array(found, np.int64).reshape(-1, 3).T
        self.base = np.int64(2 * self.size + len(symbols) + 1)
        order = np.argsort(left * self.base + right)
        self.pairs = np.append((left * self.base + right)[order], np.int64(2**62))
        self.results = np.append(result[order], 0).astype(np.int32)
        self.ranks = np.append(ranks[result[order]], NONE).astype(np.int32)
        #: Symbol of each code point; -1 where no piece has it.
        self.symbol = np.full(0x110000, -1, np.int32)
        for text, i in symbols.items():
            if len(text) == 1:
                self.symbol[ord(text)] = i
        beside = {p[k:k + 2] for p in joined for k in range(len(p) - 1)}
        self.beside = np.array(sorted(
            int(self.symbol[ord(a)]) * int(self.base) + int(self.symbol[ord(b)])
            for a, b in beside), np.int64)
        self.words = _word_pattern(beside)

    def pair(self, left, right):
        """Places of pairs of symbols in the tables; the last place where there is none."""
        keys = left.astype(np.int64) * self.base + right
        at = np.searchsorted(self.pairs, keys)
        return np.where((self.pairs[at] == keys) & (left >= 0) & (right >= 0), at,
                        len(self.pairs) - 1)

    def merged(self, words):
        """Ids of each word, in one array, and where each word's ids begin and end."""
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        n = len(codes)
        begins = np.cumsum([0] + [len(w) for w in words])
        symbols = self.symbol[codes]
        final = np.full(n, -2, np.int32)  # the symbol that begins at a character, -2 for none
        # A segment ends where no piece has the two characters side by side.
        cut = np.ones(n + 1, bool)
        if n > 1:
            keys = symbols[:-1].astype(np.int64) * self.base + symbols[1:]
            at = np.minimum(np.searchsorted(self.beside, keys), max(0, len(self.beside) - 1))
            cut[1:-1] = (self.beside[at] != keys) if len(self.beside) else True
            cut[1:-1] |= (symbols[:-1] < 0) | (symbols[1:] < 0)
        cut[begins] = True
        places, ends = np.arange(n), cut[1:]  # of symbols: first character, last of a segment?
        pairs = np.full(n, len(self.pairs) - 1)
        inner = np.flatnonzero(~ends)
        pairs[inner] = self.pair(symbols[inner], symbols[inner + 1])
        while len(symbols):
            ranks = self.ranks[pairs]
            starts = np.flatnonzero(np.append(True, ends[:-1]))
            least = np.minimum.reduceat(ranks, starts)
            lengths = np.diff(np.append(starts, len(symbols)))
            if (least == NONE).any():  # segments without a pair are done
                live = np.repeat(least != NONE, lengths)
                final[places[~live]] = symbols[~live]
                symbols, places, ends, pairs = (x[live] for x in (symbols, places, ends, pairs))
                lengths, least = lengths[least != NONE], least[least != NONE]
                if not len(symbols):
                    break
                ranks = self.ranks[pairs]
            best = np.repeat(least, lengths)
            owner = np.repeat(np.arange(len(lengths)), lengths)
            hits = np.flatnonzero(ranks == best)
            # Overlapping occurrences: every other one of a run, from the left.
            run = np.append(True, np.diff(hits) != 1)
            first = np.flatnonzero(run)
            hits = hits[(np.arange(len(hits)) - first[np.cumsum(run) - 1]) % 2 == 0]
            many = np.bincount(owner[hits], minlength=len(lengths)) > 1
            after = self._merge(symbols, places, ends, pairs, hits)
            if many.any():
                early = self._early(symbols, ends, pairs, hits, after, best)
                if early.any():
                    late = np.zeros(len(lengths), bool)
                    late[owner[hits[early]]] = True
                    leading = np.append(True, owner[hits][1:] != owner[hits][:-1])
                    hits = hits[leading | ~late[owner[hits]]]
                    after = self._merge(symbols, places, ends, pairs, hits)
            symbols, places, ends, pairs = after
        own = np.flatnonzero(final != -2)
        symbols = final[own]
        known = (symbols >= 0) & (symbols < self.size)
        ids, counts = symbols.copy(), np.ones(len(own), np.int64)
        if not known.all():  # characters that are no piece: their bytes
            rest = np.flatnonzero(~known)
            spelled = [chr(c).encode("utf-8", "replace") for c in codes[own[rest]].tolist()]
            counts[rest] = [len(s) for s in spelled]
            ids = np.repeat(ids, counts)
            at = np.repeat(known, counts)
            ids[~at] = self.byte_ids[np.frombuffer(b"".join(spelled), np.uint8)]
        total = np.append(0, np.cumsum(counts))
        return ids, total[np.searchsorted(own, begins)]

    def _merge(self, symbols, places, ends, pairs, hits):
        """The arrays after the pairs that begin at ``hits`` have become one symbol each."""
        gone = np.ones(len(symbols), bool)
        gone[hits + 1] = False
        symbols, ends = symbols.copy(), ends.copy()
        symbols[hits] = self.results[pairs[hits]]
        ends[hits] = ends[hits + 1]
        at = np.cumsum(gone)[hits] - 1  # places of the new symbols
        symbols, places, ends, pairs = symbols[gone], places[gone], ends[gone], pairs[gone]
        near = np.zeros(len(symbols), bool)
        near[at] = near[at[at > 0] - 1] = True
        changed = np.flatnonzero(near)
        inner = changed[~ends[changed]]
        pairs[changed] = len(self.pairs) - 1
        pairs[inner] = self.pair(symbols[inner], symbols[inner + 1])
        return symbols, places, ends, pairs

    def _early(self, symbols, ends, pairs, hits, after, best):
        """Merges after which a pair of the new symbol would come before the next merge."""
        merged, _, closed, found = after
        at = hits - np.arange(len(hits))  # each merge before took one place
        early = np.zeros(len(hits), bool)
        before = np.flatnonzero((at > 0) & ~closed[at - 1])
        early[before] = self.ranks[found[at[before] - 1]] <= best[hits[before]]
        following = np.flatnonzero(~ends[hits + 1])
        own = self.pair(merged[at[following]], symbols[hits[following] + 2])
        early[following] |= self.ranks[own] <= best[hits[following]]
        return early


class _Known(dict):
    """Ids of words; when full it becomes the older generation, used words are taken over."""

    def __init__(self):
        super().__init__()
        self.older = {}

    def found(self, word):
        ids = self.get(word)
        if ids is None:
            ids = self.older.get(word)
            if ids is not None:
                self.put(word, ids)
        return ids

    def put(self, word, ids):
        if len(word) <= CACHE_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.older = dict(self)
                self.clear()
            self[word] = ids


class Codec:
    """Encoder and decoder of one model."""

    def __init__(self, content):
        self.model = Model(content)
        self.known = _Known()

    def encode(self, texts):
        """Ids of each text as little-endian 32-bit integers."""
        model, known, cut = self.model, self.known, []
        for text in texts:
            text = text or ""
            cut.append(model.words.findall(model.prefix + text.replace(" ", SPACE)) if text else [])
        own = dict.fromkeys(word for words in cut for word in words)
        new = []
        for word in own:
            ids = own[word] = known.found(word)
            if ids is None:
                new.append(word)
        if new:
            ids, bounds = model.merged(new)
            packed = ids.astype("<i4").tobytes()
            bounds = (4 * bounds).tolist()
            for i, word in enumerate(new):
                own[word] = packed[bounds[i]:bounds[i + 1]]
                known.put(word, own[word])
        return [b"".join(map(own.__getitem__, words)) for words in cut]

    def decode(self, ids):
        """The UTF-8 text that a list of ids stands for."""
        model = self.model
        parts = list(map(model.surface.__getitem__, ids))
        if model.prefix:
            kinds = model.kinds
            for i, x in enumerate(ids):
                if kinds[x] != CONTROL:  # the first piece gives up the space of the prefix
                    if kinds[x] == NORMAL and parts[i][:1] == b" ":
                        parts[i] = parts[i][1:]
                    break
        whole = b"".join(parts)
        try:
            whole.decode()
            return whole
        except UnicodeDecodeError:
            return self._repaired(ids, parts)

    def _repaired(self, ids, parts):
        """Every byte that is not part of a character becomes U+FFFD."""
        out, run = [], b""
        for x, part in [*zip(ids, parts), (None, b"")]:
            if x is not None and self.model.kinds[x] == BYTE:
                run += part
                continue
            while run:
                try:
                    out.append(run.decode().encode())
                    run = b""
                except UnicodeDecodeError as error:
                    out += [run[:error.start], "�".encode()]
                    run = run[error.start + 1:]
            out.append(part)
        return b"".join(out)


_codecs = {}


def codec(content):
    """One codec for each worker and model, so that its words serve later tasks."""
    key = hashlib.sha256(content).digest()
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(content)
    return _codecs[key]


def _encoded(shared):
    def encode(batches):
        own = codec(shared.value)
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                packed = own.encode(batch.column("text").to_pylist())
                ends = np.cumsum([0] + [len(p) // 4 for p in packed])
                ids = pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), "<i4")))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])
    return encode


def _decoded(shared):
    def decode(batches):
        own = codec(shared.value)
        for batch in batches:
            texts = [own.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.binary()).cast(pa.string())],
                ["doc_id", "ids", "decoded"])
    return decode


def _shared(frame, path):
    with open(path, "rb") as file:  # a model file beside the driver, about 0.5 MB
        return frame.sparkSession.sparkContext.broadcast(file.read())


def encode(docs, path):
    """``doc_id, ids`` for each row of ``docs(doc_id, text)``, without begin or end ids.

    Null text counts as empty and has no ids; repeated rows and null ids stay as they are,
    other columns are left out; an empty table gives an empty result. A very long text is
    encoded as a whole; a word of n characters takes at most as many rounds as it has merges,
    and one round merges all its occurrences of a pair.
    """
    pairs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return mapped(pairs, _encoded(_shared(docs, path)), "doc_id long, ids array<int>")


def decode(encoded, path):
    """Adds ``decoded``, the text that the ids stand for, to ``encoded(doc_id, ids)``."""
    return mapped(encoded.select("doc_id", "ids"), _decoded(_shared(encoded, path)),
                  "doc_id long, ids array<int>, decoded string")


def encode_decode(docs, path):
    """``doc_id, ids, decoded``: both ways in one pass over the texts."""
    pairs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    shared = _shared(docs, path)
    there, back = _encoded(shared), _decoded(shared)
    return mapped(pairs, lambda batches: back(there(batches)),
                  "doc_id long, ids array<int>, decoded string")


def round_trip(docs, path):
    """The columns of op13: number and digest of the ids, digest of the decoded text."""
    return encode_decode(docs, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
