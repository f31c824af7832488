"""Words of many texts at once: byte masks over whole Arrow columns.

All separators here are ASCII, so words can be cut on UTF-8 bytes: a byte of a longer
character is never a separator.
"""

import numpy as np
import pyarrow as pa

_BYTES = np.arange(256)
#: A-Z in lower case.
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
#: Word bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` on lower-cased text.
ALNUM = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
#: Word bytes of ``[^\x20\x09-\x0D]+``.
UNSPACED = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))

#: Text bytes that a worker takes at a time: it needs some forty bytes for each of them, and
#: a part of that stays with it for as long as it lives.
SLICE_BYTES = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_powers = {}


def _power(base, n):
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _powers[int(base)] = have
    return have[:n]


def mix(h):
    """Spread the bits of 64-bit numbers (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def utf8(column):
    """Bytes of a string column and where each text begins; null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + n + 1]
    first, last = (int(offsets[0]), int(offsets[-1])) if n else (0, 0)
    data = np.frombuffer(data, dtype=np.uint8)[first:last] if last > first \
        else np.zeros(0, np.uint8)
    return data, offsets - first if n else np.zeros(1, np.int64)


def slices(batch, text, limit):
    """Parts of a record batch whose texts hold about ``limit`` bytes, one row at least."""
    if not batch.num_rows:
        return
    column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
    sizes = np.diff(np.frombuffer(column.buffers()[1], dtype=np.int64)[
        column.offset:column.offset + len(column) + 1])
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


class Words:
    """The words of a block of texts: byte places, 64-bit hashes, words of each text."""

    def __init__(self, data, offsets, word_bytes, lower=True):
        self.data = LOWER[data] if lower else data
        self.offsets = offsets
        inside = word_bytes[self.data]
        before = np.empty_like(inside)
        after = np.empty_like(inside)
        if len(inside):
            before[0], before[1:] = False, inside[:-1]
            after[-1], after[:-1] = False, inside[1:]
            edges = offsets[:-1][offsets[1:] > offsets[:-1]]
            before[edges] = False
            after[edges[1:] - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        #: Text i has the words bounds[i] to bounds[i + 1].
        self.bounds = np.searchsorted(self.starts, offsets)

    def hashes(self):
        """A 64-bit hash of each word's bytes."""
        n = len(self.data)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * _power(_ODD, n), out=total[1:])
        h = (total[self.ends] - total[self.starts]) * _power(_INVERSE, n + 1)[self.starts]
        return mix(h + (self.ends - self.starts).astype(np.uint64))

    def text(self, i):
        return self.data[self.starts[i]:self.ends[i]].tobytes()
