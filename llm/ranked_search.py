"""Ranked lexical search, exact, by posting lists in geometric blocks.

Documents are cut into segments, each a stored row with the terms of its documents. For a
block of search items every segment gets posting lists of the items' terms. A list is cut
into blocks of documents that lie close together (nearest of some pivots, after a random
projection), and each block stores a summary: the largest contribution of every term over
its documents, coordinate by coordinate. An item's weights times the summary bound the score
of all documents of the block, so a block is skipped only when its bound is below the
tenth score known so far; every other block is scored in whole numbers.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from llm.frames import LONG_ROWS, mapped, met, numbered, written
from llm.words import ALNUM, Words, slices, utf8

#: Postings (terms of its documents) and documents of a segment, bytes of text cut at a time.
POSTINGS, DOCUMENTS, SLICE_BYTES = 500_000, 2048, 2 << 20
#: Terms of all items of one item block; a longer item has a block of its own.
ITEM_TERMS = 16_384
#: Columns of a summary, and cells of all summaries of a segment. Terms beyond them share
#: columns, which makes bounds looser and changes no result.
WIDTH, CELLS = 4096, 1 << 25
#: Documents of a posting block, dimensions of the projection that clusters them.
BLOCK, DIMENSIONS = 32, 32
#: Of so many shares of the segments one is searched first, for a floor under the scores.
SHARES = 16
#: Saturation in thousandths, weight of the length in hundredths.
SCALE, SATURATION, LENGTH = 1_000_000_000, 8, 90


def counted(column):
    """Terms of each text: lengths, and (text, term, occurrences) by text and term."""
    words = Words(*utf8(column), ALNUM)
    n = np.diff(words.bounds)
    terms, at = np.unique(words.hashes(), return_inverse=True)
    key, tf = np.unique(np.repeat(np.arange(len(n)), n) * max(1, len(terms)) + at,
                        return_counts=True)
    if not len(key):
        return n, key, terms, tf
    return n, key // len(terms), terms[key % len(terms)], tf


def _packed(*arrays):
    """Each array as a column of one binary value, not copied."""
    return [pa.Array.from_buffers(pa.binary(), 1, [
        None, pa.py_buffer(np.array([0, a.nbytes], np.int32)),
        pa.py_buffer(np.ascontiguousarray(a))]) for a in arrays]


def _read(value, kind):
    return np.frombuffer(value.as_buffer(), kind)


def _pieces(batches):
    for whole in batches:
        for batch in slices(whole, "text", SLICE_BYTES):
            for at in range(0, batch.num_rows, DOCUMENTS // 2):
                yield batch.slice(at, DOCUMENTS // 2)


_SEGMENT = ("segment long, documents long, words long, doc_ids binary, missing binary, "
            "lengths binary, terms binary, df binary, docs binary, places binary, tf binary")


def _segments(batches):
    held, number = [], TaskContext.get().partitionId() << 32

    def closed():
        doc, term, tf = (np.concatenate(x) for x in zip(*(h[3:] for h in held)))
        terms, places = np.unique(term, return_inverse=True)
        ids, missing, n = (np.concatenate(x) for x in zip(*(h[:3] for h in held)))
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([len(ids)]), pa.array([int(n.sum())]), *_packed(
                ids, missing, n, terms, np.bincount(places, minlength=len(terms)),
                doc.astype("<u4"), places.astype("<u4"), tf.astype("<u4"))],
            [c.split()[0] for c in _SEGMENT.split(", ")])

    for batch in _pieces(batches):
        n, doc, term, tf = counted(batch.column("text"))
        kept = np.flatnonzero(n)  # a document without a term is not counted
        if not len(kept):
            continue
        renamed = np.cumsum(n > 0) - 1 + sum(len(h[0]) for h in held)
        ids = batch.column("doc_id")
        held.append((ids.fill_null(0).to_numpy(zero_copy_only=False)[kept],
                     ids.is_null().to_numpy(zero_copy_only=False)[kept].astype(np.uint8),
                     n[kept].astype("<i8"), renamed[doc], term, tf))
        if sum(len(h[3]) for h in held) >= POSTINGS or \
                sum(len(h[0]) for h in held) >= DOCUMENTS // 2:
            yield closed()
            held.clear()
            number += 1
    if held:
        yield closed()


def _item_terms(batches):
    block, size = TaskContext.get().partitionId() << 32, 0
    for whole in batches:
        for batch in slices(whole, "text", SLICE_BYTES):
            _, item, term, _ = counted(batch.column("text"))
            ends = np.searchsorted(item, np.arange(batch.num_rows + 1))
            blocks = []
            for k in np.diff(ends).tolist():
                if size and size + k > ITEM_TERMS:
                    block, size = block + 1, 0
                size += k
                blocks.append(block)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(blocks, np.int64)[item]), batch.column("item").take(pa.array(item)),
                 batch.column("item_id").take(pa.array(item)), pa.array(term.astype(np.int64))],
                ["block", "item", "item_id", "term"])


def _frequencies(batches):
    """Documents with each term of each item block, summed over the segments of a task."""
    known = {}

    def sent():
        for block, (terms, df) in known.items():
            some = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), block)), pa.array(terms[some].astype(np.int64)),
                 pa.array(df[some])], ["block", "term", "df"])
        known.clear()

    for batch in batches:
        for block, own, terms, df in zip(*(batch.column(c) for c in (
                "block", "vocabulary", "terms", "df"))):
            if block.as_py() not in known:
                if len(known) >= 64:
                    yield from sent()
                own = np.sort(own.values.to_numpy().astype(np.uint64))
                known[block.as_py()] = own, np.zeros(len(own), np.int64)
            own, total = known[block.as_py()]
            terms = _read(terms, np.uint64)
            at = np.minimum(np.searchsorted(terms, own), len(terms) - 1)
            total += np.where(terms[at] == own, _read(df, np.int64)[at], 0)
    yield from sent()


class Items:
    """The items of one block: their terms by place in the block's vocabulary."""

    def __init__(self, entries):
        item, self.ids, term, weight = (entries.field(c) for c in (
            "item", "item_id", "term", "weight"))
        item, weight = item.to_numpy(), weight.to_numpy()
        self.vocabulary, at = np.unique(term.to_numpy().astype(np.uint64), return_inverse=True)
        self.keys, first = np.unique(item, return_index=True)
        cuts = np.append(first, len(item))
        self.ids = self.ids.take(pa.array(first)).to_pylist()
        self.terms, self.weights = [], []
        for a, b in zip(cuts[:-1], cuts[1:]):
            order = np.argsort(at[a:b])
            self.terms.append(at[a:b][order])
            self.weights.append(weight[a:b][order])
        self._beside = None

    def beside(self, width):
        """For each term the columns of all items that hold it, its own among them."""
        if self._beside is None or self._beside[0] != width:
            owners, unions = [()] * len(self.vocabulary), {}
            for i, own in enumerate(self.terms):
                for t in own.tolist():
                    owners[t] += (i,)
            for some in set(owners):
                unions[some] = np.unique(np.concatenate([self.terms[i] for i in some]) % width)
            self._beside = width, [unions[some] for some in owners]
        return self._beside[1]

    def weighted(self, i, width):
        """Columns of item i and the sums of its weights in them."""
        columns, at = np.unique(self.terms[i] % width, return_inverse=True)
        sums = np.zeros(len(columns), np.int64)
        np.add.at(sums, at, self.weights[i])
        return columns, sums


_items = {}


def _known_items(entries):
    """Items of a block, read once for the rows of a worker that come with it."""
    key = hashlib.sha256(b"".join(entries.field(c).to_numpy().tobytes()
                                  for c in ("item", "term", "weight"))).digest()
    if key not in _items:
        _items.clear()
        _items[key] = Items(entries)
    return _items[key]


def clusters(near, size):
    """(order, first places of the blocks) of documents by their projected vectors."""
    if len(near) <= size:
        return np.arange(len(near)), np.zeros(1, np.int64)
    nearest = (near @ near[::size].T).argmax(axis=1)
    order = np.argsort(nearest, kind="stable")
    nearest = nearest[order]
    begins = np.flatnonzero(np.append(True, nearest[1:] != nearest[:-1]))
    lengths = np.diff(np.append(begins, len(near)))
    parts = -(-lengths // (2 * size))  # a cluster of many copies is cut into more blocks
    within = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    return order, np.repeat(begins, parts) + within * 2 * size


_INDEX = ("segment long, block long, width int, doc_ids binary, missing binary, docs binary, places binary, "
          "parts binary, lists binary, members binary, list_blocks binary, begins binary, "
          "summaries binary")


def _width(items, place, size):
    """The largest number of columns for which a segment's summaries stay within CELLS."""
    width = WIDTH
    lists, df = np.unique(place, return_counts=True)
    blocks = 1 + 2 * df // size
    while width > 64 and sum(
            k * len(items.beside(width)[t]) for t, k in zip(lists.tolist(), blocks.tolist())) > CELLS:
        width //= 2
    return width


def _indexed(size):
    def indexed(batches):
        names = [c.split()[0] for c in _INDEX.split(", ")]
        for batch in batches:
            for row in range(batch.num_rows):
                at = {c: batch.column(c)[row] for c in batch.schema.names}
                items = _known_items(at["entries"].values)
                vocabulary = items.vocabulary
                terms, n = _read(at["terms"], np.uint64), _read(at["lengths"], np.int64)
                own = np.minimum(np.searchsorted(vocabulary, terms), len(vocabulary) - 1)
                own = np.where(vocabulary[own] == terms, own, -1)
                place = own[_read(at["places"], "<u4")]
                some = place >= 0
                place, doc = place[some], _read(at["docs"], "<u4")[some].astype(np.int64)
                tf = _read(at["tf"], "<u4")[some].astype(np.int64)
                total, words = at["n_documents"].as_py(), at["n_words"].as_py()
                m = 100 - LENGTH + LENGTH * n * total // words
                part = SCALE * tf // (1000 * tf + SATURATION * m[doc])
                width = _width(items, place, size)
                dense = np.zeros((len(n), min(width, len(vocabulary))), np.int32)
                np.maximum.at(dense, (doc, place % width), part)
                beside = items.beside(width)
                signs = np.random.default_rng(1).choice(
                    np.array([-1, 1], np.float32), (len(vocabulary), DIMENSIONS))
                near = np.zeros((len(n), DIMENSIONS), np.float32)
                used, begin = np.unique(doc, return_index=True)
                if len(used):
                    near[used] = np.add.reduceat(signs[place] * part[:, None].astype(np.float32), begin)
                near /= np.maximum(np.linalg.norm(near, axis=1, keepdims=True), 1e-9)
                order = np.lexsort((doc, place))
                by_term, docs = place[order], doc[order]
                lists, begin = np.unique(by_term, return_index=True)
                members, blocks, firsts, summaries = [], [], [], []
                for t, a, b in zip(lists.tolist(), begin.tolist(), [*begin[1:].tolist(), len(docs)]):
                    own = docs[a:b]
                    by, cuts = clusters(near[own], size)
                    members.append(own[by])
                    blocks.append(len(cuts))
                    firsts.append(cuts + a)
                    summaries.append(np.maximum.reduceat(
                        dense[np.ix_(own[by], beside[t])], cuts, axis=0).ravel())
                joined = [np.concatenate(x) if x else np.zeros(0) for x in (
                    members, firsts, summaries)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at["segment"].as_py()]), pa.array([at["block"].as_py()]),
                     pa.array([width], pa.int32())] + _packed(
                        _read(at["doc_ids"], np.int64), _read(at["missing"], np.uint8),
                        doc.astype("<u4"), place.astype("<u4"), part.astype("<i4"),
                        lists.astype("<u4"), joined[0].astype("<u4"), np.array(blocks, "<u4"),
                        joined[1].astype("<u4"), joined[2].astype("<i4")), names)
    return indexed


class Segment:
    """Posting lists, blocks and summaries of one segment for one block of items."""

    def __init__(self, at, items):
        self.items = items
        self.doc_ids, missing = _read(at["doc_ids"], np.int64), _read(at["missing"], np.uint8)
        #: Ranks of the documents by ascending id, no id last.
        self.by_id = np.empty(len(self.doc_ids), np.int64)
        self.by_id[np.lexsort((self.doc_ids, missing))] = np.arange(len(self.doc_ids))
        self.missing = missing.astype(bool)
        docs = _read(at["docs"], "<u4")
        #: Postings by document.
        self.cuts = np.searchsorted(docs, np.arange(len(self.doc_ids) + 1))
        self.places, self.parts = _read(at["places"], "<u4"), _read(at["parts"], "<i4")
        self.members, self.begins = _read(at["members"], "<u4"), _read(at["begins"], "<u4")
        self.ends = np.append(self.begins[1:], len(self.members))
        self.width, self.lists = at["width"].as_py(), {}
        self.beside, summaries = items.beside(self.width), _read(at["summaries"], "<i4")
        first = place = 0
        for t, k in zip(_read(at["lists"], "<u4").tolist(), _read(at["list_blocks"], "<u4").tolist()):
            columns = len(self.beside[t])
            self.lists[t] = first, summaries[place:place + k * columns].reshape(k, columns)
            first, place = first + k, place + k * columns

    def bounds(self, i):
        """(blocks, an upper bound of item i's score in each) of all lists of the item."""
        columns, weights = self.items.weighted(i, self.width)
        blocks, bounds = [], []
        for t in self.items.terms[i].tolist():
            if t in self.lists:
                first, summary = self.lists[t]
                bounds.append(summary[:, np.searchsorted(self.beside[t], columns)] @ weights)
                blocks.append(np.arange(first, first + len(summary)))
        return (np.concatenate(blocks), np.concatenate(bounds)) if blocks else (None, None)

    def scores(self, docs, weights):
        """Whole scores of documents, by the weights of all terms."""
        n = self.cuts[docs + 1] - self.cuts[docs]
        ends = np.cumsum(n)
        at = np.arange(ends[-1]) + np.repeat(self.cuts[docs] - ends + n, n)
        return np.add.reduceat(self.parts[at] * weights[self.places[at]], ends - n)

    def best(self, i, k, floor):
        """The item's k best documents of at least ``floor`` as (score, place), blocks scored."""
        blocks, bounds = self.bounds(i)
        if blocks is None:
            return [], 0
        weights = np.zeros(len(self.items.vocabulary), np.int64)
        weights[self.items.terms[i]] = self.items.weights[i]
        order = np.argsort(-bounds, kind="stable")
        blocks, bounds = blocks[order], bounds[order]
        seen = np.zeros(len(self.doc_ids), bool)
        found, scores, at, step = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 4
        least = max(1, floor)
        while at < len(blocks) and bounds[at] >= least:
            some = blocks[at:at + step][bounds[at:at + step] >= least]
            docs = np.unique(np.concatenate([
                self.members[self.begins[b]:self.ends[b]] for b in some.tolist()])).astype(np.int64)
            docs = docs[~seen[docs]]
            if len(docs):
                seen[docs] = True
                found = np.append(found, docs)
                scores = np.append(scores, self.scores(docs, weights))
                top = np.lexsort((self.by_id[found], -scores))[:k]
                found, scores = found[top], scores[top]
                if len(found) == k:
                    least = max(least, int(scores[-1]))
            at, step = at + len(some), step * 2
        good = scores >= max(1, floor)
        return list(zip(scores[good].tolist(), found[good].tolist())), at


def _searched(k):
    def searched(batches):
        for batch in batches:
            out = [[] for _ in range(4)]
            for row in range(batch.num_rows):
                at = {c: batch.column(c)[row] for c in batch.schema.names}
                items = _known_items(at["entries"].values)
                own = Segment(at, items)
                floors = dict((f["item"], f["floor"]) for f in at["floors"].as_py() or ())
                for i, (key, name) in enumerate(zip(items.keys.tolist(), items.ids)):
                    for score, doc in own.best(i, k, floors.get(key, 0))[0]:
                        doc_id = None if own.missing[doc] else int(own.doc_ids[doc])
                        for column, value in zip(out, (key, name, doc_id, score)):
                            column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in out], ["item", "item_id", "doc_id", "score"])
    return searched


def build(docs):
    """The stored segments of ``docs(doc_id, text)``: terms of all documents."""
    pairs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return written(mapped(pairs, _segments, _SEGMENT), "segments", compression="zstd", **LONG_ROWS)


def item_blocks(segments, items):
    """Item blocks with the weights of their terms, and the sizes that scores need."""
    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    terms = written(mapped(numbered(rows, "item"), _item_terms,
                           "block long, item long, item_id long, term long"), "item-terms")
    vocabulary = terms.groupBy("block").agg(F.collect_set("term").alias("vocabulary"))
    counts = mapped(met(segments.select("segment", "terms", "df"), "segment", vocabulary), _frequencies,
                    "block long, term long, df long").groupBy("block", "term").agg(F.sum("df").alias("df"))
    documents, words = segments.agg(F.sum("documents"), F.sum("words")).first()
    documents, words = documents or 0, words or 0
    weight = F.floor(1000 * F.log(F.lit(2 * documents + 2) / (2 * F.col("df") + 1)))
    return written(terms.join(counts, ["block", "term"]).groupBy("block").agg(
        F.lit(documents).cast("long").alias("n_documents"), F.lit(words).cast("long").alias("n_words"),
        F.sort_array(F.collect_list(F.struct("item", "item_id", "term", weight.alias("weight"))))
        .alias("entries")), "item-blocks")


def index(segments, blocks, size=BLOCK):
    """The stored posting blocks with their summaries, a row for each segment and item block."""
    return written(mapped(met(segments, "segment", blocks), _indexed(size), _INDEX), "posting-blocks",
                   compression="zstd", **LONG_ROWS)


def _ranked(found, k):
    order = Window.partitionBy("item").orderBy(
        F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs, items, k=10, size=BLOCK):
    """``item_id, rank, doc_id, score``: the k best documents for each row of ``items``.

    ``docs(doc_id, text)`` and ``items(item_id, text)`` are read whole. Terms are runs of
    ASCII letters, digits and other characters from U+0080, A-Z lower-cased, told apart by
    64-bit hashes; an item's terms count once each. Only scores above 0 are ranked; equal
    scores by ascending ``doc_id``, none last. Null and wordless texts match nothing; rows
    with the same id are rows of their own; other columns are left out; empty tables give an
    empty result. A very long text is one row of a segment, an item never leaves its block.
    """
    segments = build(docs)
    blocks = item_blocks(segments, items)
    stored = index(segments, blocks, size)
    queries = blocks.select("block", "entries")

    def best(part, floors):
        asked = met(part, "segment", queries.join(floors, "block", "left"), ["block"])
        return mapped(asked, _searched(k), "item long, item_id long, doc_id long, score long")

    owner = queries.select("block", F.explode(F.array_distinct("entries.item")).alias("item"))
    none = "array<struct<item:long,floor:long>>"
    first = best(stored.where(F.pmod(F.xxhash64("segment", F.lit(7)), F.lit(SHARES)) == 0),
                 queries.select("block", F.lit(None).cast(none).alias("floors")))
    floors = _ranked(first, k).where(F.col("rank") == k).select("item", F.col("score").alias("floor"))
    floors = written(owner.join(floors, "item").groupBy("block").agg(
        F.collect_list(F.struct("item", "floor")).alias("floors")), "floors")
    return _ranked(best(stored, floors), k).select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


#: The result of op12 in DuckDB's SQL.
SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
i AS (
    SELECT item_id, unnest(list_distinct(regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term FROM benchmark),
s AS (SELECT count(*) AS docs, sum(len(words))::BIGINT AS total FROM d WHERE len(words) > 0),
p AS (
    SELECT doc_id, term, n, count(*) AS tf
    FROM (SELECT doc_id, len(words) AS n, unnest(words) AS term FROM d) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS weight FROM f, s),
r AS (
    SELECT item_id, doc_id, sum(weight * ((1000000000 * tf)
        // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // total))))::BIGINT AS score
    FROM i JOIN p USING (term) JOIN w USING (term), s GROUP BY item_id, doc_id),
k AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place
    FROM r WHERE score > 0)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM k WHERE place <= 10
"""
