"""Benchmark decontamination with a distributed positional inverted index.

Training texts are cut into segments of whole documents; each segment is one row of a stored
index: its terms, and for every term the list of word positions. Test phrases are looked up
in every segment: from a phrase's rarest term in the segment, lists are intersected after
moving each by the term's offset, next rarest first. Exact matches have every word in its
place, proximity matches every word within ``slop`` places of it.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from llm.frames import mapped, met, written
from llm.words import ALNUM, Words, slices, utf8

#: Words of a test phrase; places by which a proximity match may be off.
WINDOW, SLOP = 10, 2
#: Text bytes of a segment, words of a block of test items (of 8 bytes at most on average),
#: windows of a piece of an item, candidates held at once.
SEGMENT_BYTES, BLOCK_WORDS, PIECE_WINDOWS, CANDIDATES = 2 << 20, 400_000, 20_000, 1_000_000

_INDEX = ("segment long, doc_ids array<long>, doc_words array<int>, terms binary, "
          "counts binary, gaps binary")


def _equal_words(words, first, second):
    """Whether words first[i] and second[i] are the same bytes."""
    padded = np.concatenate([words.data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(padded) - 7, dtype="<u8", buffer=padded, strides=(1,))
    size = words.ends - words.starts
    same = size[first] == size[second]
    at = 0
    open_ = np.flatnonzero(same)
    while len(open_):
        left = np.minimum(size[first[open_]] - at, 8).astype(np.uint64)
        mask = np.where(left == 8, ~np.uint64(0), (np.uint64(1) << (left * np.uint64(8) & np.uint64(63)))
                        - np.uint64(1))
        a = eight[words.starts[first[open_]] + at] & mask
        b = eight[words.starts[second[open_]] + at] & mask
        same[open_[a != b]] = False
        at += 8
        open_ = open_[(a == b) & (size[first[open_]] > at)]
    return same


def term_order(words):
    """Word places in order of term and position, and where each term begins in them."""
    hashes = words.hashes()
    order = np.argsort(hashes, kind="stable")
    if not len(order):
        return order, np.zeros(0, dtype=np.int64)
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = hashes[order[1:]] != hashes[order[:-1]]
    again = np.flatnonzero(~fresh)
    if not _equal_words(words, order[again - 1], order[again]).all():
        # Two words with one hash: tell the words apart by their bytes.
        number = {}
        ids = np.array([number.setdefault(words.text(i), len(number)) for i in range(len(order))])
        order = np.argsort(ids, kind="stable")
        fresh[1:] = ids[order[1:]] != ids[order[:-1]]
    return order, np.flatnonzero(fresh)


def _indexed(segment_bytes):
    def index(batches):
        segment = TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch in slices(whole, "text", segment_bytes):
                words = Words(*utf8(batch.column("text")), ALNUM)
                order, begins = term_order(words)
                gaps = np.diff(order, prepend=0)
                gaps[begins] = order[begins]
                counts = np.diff(np.append(begins, len(order)))
                row = [[segment], [batch.column("doc_id").to_pylist()],
                       [np.diff(words.bounds).tolist()],
                       [b" ".join([words.text(i) for i in order[begins].tolist()])],
                       [counts.astype("<u4").tobytes()], [gaps.astype("<u4").tobytes()]]
                types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()),
                         pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(row, types)],
                    [c.split()[0] for c in _INDEX.split(", ")])
                segment += 1
    return index


def build_index(docs, segment_bytes=SEGMENT_BYTES):
    """The stored index of every word of ``docs(doc_id, text)``; one row for a segment."""
    pairs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return written(mapped(pairs, _indexed(segment_bytes), _INDEX), "postings", compression="zstd")


_PIECES = "piece long, item string, n long, text string"


def _cut(window, windows):
    names = [c.split()[0] for c in _PIECES.split(", ")]

    def cut(batches):
        piece = TaskContext.get().partitionId() << 40
        for whole in batches:
            for batch in slices(whole, "text", 2 << 20):
                words = Words(*utf8(batch.column("text")), ALNUM)
                items = batch.column("item_id").to_pylist()
                for item, first, last in zip(items, words.bounds[:-1].tolist(),
                                             words.bounds[1:].tolist()):
                    # Every window of an item lies in one of its pieces.
                    for begin in range(first, max(first + 1, last - window + 1) if last > first
                                       else first, windows):
                        end = min(begin + windows + window - 1, last)
                        text = b" ".join([words.text(i) for i in range(begin, end)]).decode()
                        yield pa.RecordBatch.from_arrays([
                            pa.array([piece], pa.int64()), pa.array([item], pa.string()),
                            pa.array([end - begin], pa.int64()), pa.array([text], pa.string())],
                            names)
                        piece += 1
    return cut


_BLOCKS = "block long, items array<string>, vocabulary binary, ids binary, sizes binary"


def _numbered(batches):
    """The words of a block's pieces as numbers in its vocabulary."""
    for batch in batches:
        for block, pieces in zip(batch.column("block").to_pylist(),
                                 batch.column("pieces").to_pylist()):
            vocabulary, ids, sizes = {}, [], []
            for piece in pieces:
                words = piece["text"].encode().split(b" ")
                ids += [vocabulary.setdefault(w, len(vocabulary)) for w in words]
                sizes.append(len(words))
            row = [[block], [[p["item"] for p in pieces]], [b" ".join(vocabulary)],
                   [np.array(ids, "<u4").tobytes()], [np.array(sizes, "<u4").tobytes()]]
            types = [pa.int64(), pa.list_(pa.string()), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, types)],
                                             [c.split()[0] for c in _BLOCKS.split(", ")])


def item_blocks(benchmark, window=WINDOW, block_words=BLOCK_WORDS, windows=PIECE_WINDOWS):
    """Stored blocks of test items and their number, 0 without words.

    Items are cut into pieces that overlap, so that one long item is dealt to several blocks;
    the number of blocks follows from the words and bytes of all pieces.
    """
    rows = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    pieces = written(mapped(rows, _cut(window, windows), _PIECES), "test-pieces")
    words, size = pieces.agg(F.sum("n"), F.sum(F.octet_length("text").cast("long"))).first()
    number = -(-max(words or 0, (size or 0) // 8) // block_words)
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("piece"), F.lit(max(1, number))))
    whole = dealt.groupBy("block").agg(F.collect_list(F.struct("item", "text")).alias("pieces"))
    return written(mapped(whole, _numbered, _BLOCKS), "test-blocks"), number


class Phrases:
    """Test phrases of a block: term numbers, padded with -1, and the pieces they are from."""

    def __init__(self, items, vocabulary, ids, sizes, window=WINDOW):
        self.items = items
        words = vocabulary.split(b" ") if vocabulary else []
        self.vocabulary = {word: i for i, word in enumerate(words)}
        ids = np.frombuffer(ids, "<u4").astype(np.int64)
        sizes = np.frombuffer(sizes, "<u4").astype(np.int64)
        ends = np.cumsum(sizes)
        end, first = np.repeat(ends, sizes), np.repeat(ends - sizes, sizes)
        at = np.arange(len(ids))
        begins = np.flatnonzero((at + window <= end) | (at == first))
        places = begins[:, None] + np.arange(window)
        self.terms = np.append(ids, np.full(window, -1))[places]
        self.terms[places >= end[begins, None]] = -1
        self.owner = np.repeat(np.arange(len(sizes)), sizes)[begins]
        self.sizes = (self.terms >= 0).sum(axis=1)


class Segment:
    """Postings of one row of the index, as (term, position) keys in order."""

    def __init__(self, doc_words, terms, counts, gaps):
        self.terms = terms.split(b" ") if terms else []
        self.counts = np.frombuffer(counts, "<u4").astype(np.int64)
        self.begins = np.concatenate(([0], np.cumsum(self.counts)))
        gaps = np.frombuffer(gaps, "<u4").astype(np.int64)
        total = np.cumsum(gaps)
        if len(total):
            before = np.concatenate(([0], total))[self.begins[:-1]]
            total -= np.repeat(before, self.counts)
        self.positions = total
        self.n = len(total)
        self.keys = np.repeat(np.arange(len(self.counts)), self.counts) * self.n + total
        self.bounds = np.concatenate(([0], np.cumsum(doc_words, dtype=np.int64)))

    def within(self, term, low, high):
        """Whether the term has a position from low to high."""
        low, high = np.clip(low, 0, self.n), np.clip(high, -1, self.n - 1)
        at = np.searchsorted(self.keys, term * self.n + low)
        found = self.keys[np.minimum(at, self.n - 1)]
        return (low <= high) & (at < self.n) & (found <= term * self.n + high)

    def document(self, position):
        return np.searchsorted(self.bounds, position, "right") - 1


def find(segment, phrases, slop=SLOP, candidates=CANDIDATES):
    """Yields (phrase, start, exact) of all matches in a segment, in parts."""
    if not segment.n or not len(phrases.terms):
        return
    own = np.full(len(phrases.vocabulary) + 1, -1, dtype=np.int64)
    for at, number in enumerate(map(phrases.vocabulary.get, segment.terms)):
        if number is not None:
            own[number] = at
    terms = own[phrases.terms]  # the padding reads the last entry, -1
    there = np.flatnonzero(((terms >= 0) | (phrases.terms < 0)).all(axis=1))
    if not len(there):
        return
    terms = terms[there]
    size = np.where(terms >= 0, segment.counts[terms], np.iinfo(np.int64).max)
    order = np.argsort(size, axis=1, kind="stable")  # rarest term first, padding last
    shifts = 2 * slop + 1  # a phrase may begin at so many places around a rarest term
    lists = np.take_along_axis(size, order[:, :1], 1)[:, 0] * shifts
    ends = np.cumsum(lists)
    begin = 0
    while begin < len(there):
        limit = (ends[begin - 1] if begin else 0) + candidates
        stop = max(begin + 1, int(np.searchsorted(ends, limit, "right")))
        rows = np.repeat(np.arange(begin, stop), lists[begin:stop])
        rank = np.arange(len(rows)) - np.repeat(
            ends[begin:stop] - lists[begin:stop] - (ends[begin - 1] if begin else 0),
            lists[begin:stop])
        offset = order[rows, 0]
        start = segment.positions[segment.begins[terms[rows, offset]] + rank // shifts] - offset
        start += rank % shifts - slop
        last = start + phrases.sizes[there[rows]] - 1
        fits = (start >= 0) & (last < segment.n)
        rows, start, last = rows[fits], start[fits], last[fits]
        doc = segment.document(start)
        one = doc == segment.document(last)
        rows, start, doc = rows[one], start[one], doc[one]
        for near in ((slop, 0) if slop else (0,)):
            for k in range(terms.shape[1]):
                offset = order[rows, k]
                term = terms[rows, offset]
                at = start + offset
                ok = (term < 0) | segment.within(
                    np.maximum(term, 0), np.maximum(at - near, segment.bounds[doc]),
                    np.minimum(at + near, segment.bounds[doc + 1] - 1))
                rows, start, doc = rows[ok], start[ok], doc[ok]
            yield there[rows], start, near == 0
        begin = stop


_FOUND = ("segment long, row int, doc_id long, n_words int, "
          "spans array<struct<start:int,end:int>>, items array<string>, near array<string>")


def _searched(window, slop):
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), span,
             pa.list_(pa.string()), pa.list_(pa.string())]
    names = [c.split()[0] for c in "segment, row, doc_id, n_words, spans, items, near".split(", ")]

    def search(batches):
        known, at, segment = {}, None, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (
                "segment", "doc_ids", "doc_words", "terms", "counts", "gaps", "block", "items",
                "vocabulary", "ids", "sizes")]
            for number, ids, sizes, terms, counts, gaps, block, *tests in zip(*columns):
                if number != at:  # a segment's blocks follow one another
                    at, segment = number, Segment(sizes, terms, counts, gaps)
                if block not in known:
                    if len(known) == 4:
                        known.clear()
                    known[block] = Phrases(*(tests if tests[0] is not None else
                                             ([], b"", b"", b"")), window)
                phrases = known[block]
                edges = np.zeros(segment.n + 1, dtype=np.int64)
                pairs = {True: set(), False: set()}
                for phrase, start, exact in find(segment, phrases, slop):
                    both = segment.document(start) * len(phrases.items) + phrases.owner[phrase]
                    pairs[exact].update(np.unique(both).tolist())
                    if exact:
                        edges += np.bincount(start, minlength=segment.n + 1)
                        edges -= np.bincount(start + phrases.sizes[phrase],
                                             minlength=segment.n + 1)
                hit = np.cumsum(edges[:-1]) > 0
                out = [[] for _ in types]
                found = {exact: {} for exact in pairs}
                for exact, keys in pairs.items():
                    for key in keys:
                        doc, item = divmod(key, len(phrases.items))
                        if phrases.items[item] is not None:
                            found[exact].setdefault(doc, set()).add(str(phrases.items[item]))
                for doc, (key, size) in enumerate(zip(ids, sizes)):
                    own = hit[segment.bounds[doc]:segment.bounds[doc + 1]]
                    spans = []
                    if own.any():
                        turns = np.flatnonzero(np.diff(np.concatenate(([0], own, [0]))))
                        spans = [{"start": a, "end": b} for a, b in turns.reshape(-1, 2).tolist()]
                    for column, value in zip(out, (
                            number, doc, key, size, spans, sorted(found[True].get(doc, ())),
                            sorted(found[False].get(doc, ())))):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, types)], names)
    return search


def search(index, benchmark, window=WINDOW, slop=SLOP, block_words=BLOCK_WORDS):
    """One row for each indexed document, in the columns of ``_FOUND``.

    ``spans`` are the word ranges that exact matches cover, ``items`` the test items with an
    exact match, ``near`` those with a proximity match. Blocks of items are made on the
    executors. If all test items fit in one block, which bounds its size, it is broadcast;
    else the blocks meet the segments by a shuffle, and what several blocks find in one
    document is put together.
    """
    tests, number = item_blocks(benchmark, window, block_words)
    if number <= 1:
        one = index.withColumn("block", F.col("segment") * 0)
        return mapped(one.join(F.broadcast(tests), "block", "left"), _searched(window, slop), _FOUND)
    found = mapped(met(index, "segment", tests), _searched(window, slop), _FOUND)
    return found.groupBy("segment", "row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))


def covered(spans):
    """Words in the union of spans that are sorted by start."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(spans, zero, lambda s, x: F.struct(
        (s["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(s["end"], x["start"]))).alias("n"),
        F.greatest(s["end"], x["end"]).alias("end")))["n"]


def decontaminate(docs, benchmark, window=WINDOW, slop=SLOP, segment_bytes=SEGMENT_BYTES,
                  block_words=BLOCK_WORDS):
    """One row for each row of ``docs(doc_id, text)``; other columns are left out.

    ``n_hit`` counts the words inside an exact match of a window of ``window`` consecutive
    words of a test item (of all its words if it has fewer); ``items_sha256`` digests the
    ids of such items, ``near_items`` counts those with a proximity match. Null or wordless
    texts have no hits, a test item without words no window, and a null item id marks words
    but isn't listed. Repeated rows and null ids stay as they are; an empty table gives an
    empty result, an empty benchmark no hits.
    """
    found = search(build_index(docs, segment_bytes), benchmark, window, slop, block_words)
    items = F.array_sort("items")
    return found.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"),
        covered(F.col("spans")).cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        F.size("near").cast("long").alias("near_items"))


#: The result of op1 in DuckDB's SQL. Proximity starts from the rarest word of the corpus.
SQL = r"""
WITH w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
p AS (
    SELECT DISTINCT item_id, least(len(words), 10) AS n,
        words[i:i + least(len(words), 10) - 1] AS phrase
    FROM (SELECT *, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM b WHERE len(words) > 0)),
t AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
f AS (SELECT word, count(*) AS seen FROM t GROUP BY word),
r AS (
    SELECT item_id, n, phrase, arg_min(word, (seen, word, k)) AS word, arg_min(k, (seen, word, k)) AS k,
    FROM (SELECT *, unnest(phrase) AS word, generate_subscripts(phrase, 1) AS k FROM p) LEFT JOIN f USING (word)
    GROUP BY item_id, n, phrase HAVING count(*) = count(seen)),
c AS (
    SELECT doc_id, item_id, n, phrase, t.i - r.k + 1 + unnest([-2, -1, 0, 1, 2]) AS s
    FROM r JOIN t USING (word)),
m AS (
    SELECT c.doc_id, item_id, s, n, words[s:s + n - 1] = phrase AS exact
    FROM c JOIN w USING (doc_id)
    WHERE s >= 1 AND s + n - 1 <= len(words) AND list_bool_and([
        list_contains(words[greatest(1, s + k - 3):s + k + 1], phrase[k]) FOR k IN range(1, n + 1)])),
h AS (
    SELECT doc_id, count(DISTINCT k) AS n_hit
    FROM (SELECT doc_id, unnest(range(s, s + n)) AS k FROM m WHERE exact) GROUP BY doc_id),
a AS (
    SELECT doc_id, count(*) FILTER (exact) AS n_items, count(*) AS near_items,
        sha256(coalesce(string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) FILTER (exact), ''))
        AS items_sha256
    FROM (SELECT doc_id, item_id, bool_or(exact) AS exact FROM m GROUP BY ALL) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
    coalesce(near_items, 0) AS near_items
FROM w LEFT JOIN h USING (doc_id) LEFT JOIN a USING (doc_id)
"""
