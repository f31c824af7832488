"""Hard-negative mining: exact searches that one-bit codes of rotated vectors filter.

Each row's vector is rotated; the signs are its code, and two lengths are stored with it: the
alignment, which is the part of the vector along its code, and the rest across it. For an
anchor, popcounts over the bits of its rounded coordinates estimate the part of the inner
product that lies along the code; what the rest may add is bounded by Cauchy and Schwarz,
what rounding may add by the length of its error. So every inner product lies in a known
interval. Only rows whose interval reaches the best ones found, or the window of a positive,
are scored, in whole numbers.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from llm.frames import mapped, met, written

#: Rows and bytes of a segment, anchors and bytes of a block.
SEGMENT, SEGMENT_BYTES, ANCHORS, ANCHOR_BYTES = 4096, 4 << 20, 256, 1 << 20
#: Bits of an anchor's rounded coordinates.
PLANES = 8
#: Times the wanted number of rows that are scored first, by their estimates.
SEEDS = 8
#: Vectors become whole numbers by this factor.
SCALE = 256
#: Positives of an anchor, negatives of a positive, share of its score that they reach.
POSITIVES, NEGATIVES, SHARE = 5, 5, 80


def rotation(d):
    """A random rotation of d dimensions, the same on every machine up to rounding."""
    return np.linalg.qr(np.random.default_rng(d).normal(size=(d, d)))[0]


def packed_bits(bits):
    """Rows of bits as rows of 64-bit words."""
    n, d = bits.shape
    full = np.zeros((n, -(-d // 64) * 64), np.uint8)
    full[:, :d] = bits
    return np.packbits(full, axis=1, bitorder="little").view("<u8")


def coded(values, turn):
    """Codes, alignments and rests of rows of whole numbers."""
    turned = values.astype(np.float64) @ turn
    align = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])
    rest = np.sqrt(np.maximum(0, (turned * turned).sum(axis=1) - align * align))
    return packed_bits(turned >= 0), align, rest


class Anchors:
    """Rotated anchors, rounded to PLANES bits a coordinate."""

    def __init__(self, values, turn):
        self.values = values
        turned = values.astype(np.float64) @ turn
        self.d = turned.shape[1]
        self.square = (turned * turned).sum(axis=1)
        self.low = turned.min(axis=1)
        self.step = (turned.max(axis=1) - self.low) / ((1 << PLANES) - 1)
        self.step[self.step == 0] = 1
        rounded = np.rint((turned - self.low[:, None]) / self.step[:, None]).astype(np.int64)
        near = self.low[:, None] + self.step[:, None] * rounded
        self.total = near.sum(axis=1)
        self.error = np.sqrt(((turned - near) ** 2).sum(axis=1))
        self.planes = [packed_bits(rounded >> j & 1) for j in range(PLANES)]

    def intervals(self, codes, align, rest):
        """Bounds below and above every inner product, by anchor and row."""
        ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        weighed = np.zeros((len(self.low), len(codes)), np.int64)
        for j, plane in enumerate(self.planes):
            for w in range(codes.shape[1]):
                weighed += np.bitwise_count(plane[:, w:w + 1] & codes[:, w]).astype(np.int64) << j
        along = (2 * (self.low[:, None] * ones + self.step[:, None] * weighed)
                 - self.total[:, None]) / np.sqrt(self.d)
        error = self.error[:, None]
        across = np.sqrt(np.maximum(
            0, self.square[:, None] - np.maximum(0, np.abs(along) - error) ** 2))
        reach = align * error + across * rest
        # Floating-point sums are wrong by far less than this.
        reach += 1e-3 + 1e-9 * np.sqrt(self.square)[:, None] * np.hypot(align, rest)
        middle = align * along
        return middle - reach, middle + reach


def whole_scores(values, anchor):
    """Inner products of rows with an anchor, exact."""
    largest = np.abs(values).max(initial=0), np.abs(anchor).max(initial=0)
    if float(largest[0]) * float(largest[1]) * len(anchor) < 2.0 ** 53:
        return (values.astype(np.float64) @ anchor.astype(np.float64)).astype(np.int64)
    return values.astype(np.int64) @ anchor.astype(np.int64)


def _read(value, kind, shape=-1):
    return np.frombuffer(value.as_buffer(), kind).reshape(shape)


def _binary(*arrays):
    return [pa.array([np.ascontiguousarray(a).tobytes()], pa.binary()) for a in arrays]


_SEGMENT = ("segment long, first long, ids binary, missing binary, labels binary, values binary, "
            "codes binary, align binary, rest binary")


def _segments(d):
    rows = max(1, min(SEGMENT, SEGMENT_BYTES // (8 * d)))

    def segments(batches):
        turn = rotation(d)
        segment = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                own = batch.slice(at, rows)
                vectors = own.column("vector")
                values = np.zeros((own.num_rows, d), np.int64)
                ends = np.append(0, np.cumsum(vectors.value_lengths().to_numpy()))
                owner = np.repeat(np.arange(own.num_rows), np.diff(ends))
                values[owner, np.arange(ends[-1]) - ends[owner]] = vectors.flatten().to_numpy()
                ids = own.column("vec_id")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([segment]), pa.array([segment << 12]), *_binary(
                        ids.fill_null(0).to_numpy(zero_copy_only=False),
                        ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8),
                        own.column("label").to_numpy(), values.astype("<i4"),
                        *coded(values, turn))], [c.split()[0] for c in _SEGMENT.split(", ")])
                segment += 1
    return segments


class Segment:
    """Rows of one segment, unpacked."""

    def __init__(self, at, d):
        self.ids, self.missing = _read(at["ids"], "<i8"), _read(at["missing"], "u1").astype(bool)
        self.rows = at["first"].as_py() + np.arange(len(self.ids))
        self.labels = _read(at["labels"], "<i8")
        self.values = _read(at["values"], "<i4", (-1, d)).astype(np.int64)
        self.codes = _read(at["codes"], "<u8", (len(self.ids), -1))
        self.align, self.rest = _read(at["align"], "<f8"), _read(at["rest"], "<f8")

    def best(self, some, scores, k):
        """The k best of some rows, equal scores by ascending id, no id last."""
        order = np.lexsort((self.rows[some], self.ids[some], self.missing[some], -scores))[:k]
        return some[order], scores[order]

    def id(self, i):
        return None if self.missing[i] else int(self.ids[i])


_BLOCK = "block long, anchors binary, anchor_ids binary, anchor_labels binary, anchor_values binary"


def _blocks(d, every):
    most = max(1, min(ANCHORS, ANCHOR_BYTES // (4 * d)))

    def blocks(batches):
        block, held, size = TaskContext.get().partitionId() << 32, [], 0

        def closed():
            whole = [np.concatenate(x) for x in zip(*held)]
            return [pa.RecordBatch.from_arrays(
                [pa.array([block + k]), *_binary(*(x[at:at + most] for x in whole))],
                [c.split()[0] for c in _BLOCK.split(", ")])
                for k, at in enumerate(range(0, size, most))]

        for batch in batches:
            for row in range(batch.num_rows):
                own = Segment({c: batch.column(c)[row] for c in batch.schema.names}, d)
                some = np.flatnonzero(~own.missing & (own.ids % every == 0))
                held.append((own.rows[some], own.ids[some], own.labels[some],
                             own.values[some].astype("<i4")))
                size += len(some)
                if size >= most:
                    found = closed()
                    yield from found
                    block, held, size = block + len(found), [], 0
        if size:
            yield from closed()
    return blocks


def _met_rows(d, found, names):
    """Rows that ``found(segment, anchors, i, labels, lower, upper, at)`` gives for each anchor."""
    def mapped_rows(batches):
        turn, known, last = rotation(d), {}, (None, None)
        for batch in batches:
            out = [[] for _ in names]
            for row in range(batch.num_rows):
                at = {c: batch.column(c)[row] for c in batch.schema.names}
                block, segment = at["block"].as_py(), at["segment"].as_py()
                if block not in known:
                    if len(known) >= 16:
                        known.clear()
                    known[block] = Anchors(_read(at["anchor_values"], "<i4", (-1, d)).astype(np.int64), turn)
                if last[0] != segment:
                    last = segment, Segment(at, d)
                own, anchors = last[1], known[block]
                lower, upper = anchors.intervals(own.codes, own.align, own.rest)
                keys, ids, labels = (_read(at[c], "<i8") for c in ("anchors", "anchor_ids", "anchor_labels"))
                wanted = at["wanted"].as_py() if "wanted" in at else None
                for i in range(len(keys)):
                    for values in found(own, anchors.values[i], int(keys[i]), int(labels[i]),
                                        lower[i], upper[i], wanted):
                        for column, value in zip(out, (block, int(keys[i]), int(ids[i]), *values)):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names)
    return mapped_rows


def _surviving(own, anchor, some, lower, upper, low, high, k):
    """Rows whose interval reaches the k-th best score that likely rows have in the window.

    Those with the highest estimates within it are scored first.
    """
    if len(some) <= SEEDS * k:
        return some
    likely = (lower[some] + upper[some]) / 2
    likely[likely > high] = -np.inf
    seeds = some[np.argpartition(-likely, SEEDS * k)[:SEEDS * k]]
    scores = whole_scores(own.values[seeds], anchor)
    scores = np.sort(scores[(scores >= low) & (scores <= high)])
    return some[upper[some] >= scores[-k]] if len(scores) >= k else some


_POSITIVE = ["block", "anchor", "anchor_id", "positive", "positive_id", "positive_score"]


def _positives(d, k):
    def found(own, anchor, key, label, lower, upper, _):
        some = np.flatnonzero((own.labels == label) & (own.rows != key))
        some = _surviving(own, anchor, some, lower, upper, -np.inf, np.inf, k)
        some, scores = own.best(some, whole_scores(own.values[some], anchor), k)
        for i, score in zip(some.tolist(), scores.tolist()):
            yield int(own.rows[i]), own.id(i), score
    return _met_rows(d, found, _POSITIVE)


_NEGATIVE = [*_POSITIVE, "negative", "negative_id", "negative_score"]


def _negatives(d, k, share):
    def found(own, anchor, key, label, lower, upper, wanted):
        others = own.labels != label
        for positive in wanted:
            if positive["anchor"] != key:
                continue
            high = positive["positive_score"]
            low = -(-share * high // 100)
            if low > high:
                continue
            some = np.flatnonzero(others & (upper >= low) & (lower <= high))
            some = _surviving(own, anchor, some, lower, upper, low, high, k)
            scores = whole_scores(own.values[some], anchor)
            inside = (scores >= low) & (scores <= high)
            some, scores = own.best(some[inside], scores[inside], k)
            for i, score in zip(some.tolist(), scores.tolist()):
                yield (positive["positive"], positive["positive_id"], high,
                       int(own.rows[i]), own.id(i), score)
    return _met_rows(d, found, _NEGATIVE)


def _longs(names):
    return ", ".join(f"{n} long" for n in names)


def prepared(vectors, relabelled=7, classes=10):
    """``vec_id, label, vector`` of the rows that take part, vectors in whole numbers."""
    one = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding")
    kind = F.col("label")
    if relabelled:
        kind = F.when(F.col("vec_id") % relabelled == 0, (F.col("label") + 1) % classes).otherwise(kind)
    width = one.agg(F.max(F.size("embedding"))).first()[0]
    d = max(1, width or 1)
    limit = float(1 << (62 - (d - 1).bit_length()) // 2)
    scaled = F.transform("embedding", lambda x: F.floor(SCALE * x.cast("double")))
    fits = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(SCALE * x.cast("double")) < limit))
    return one.where(F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(fits).select(
        "vec_id", kind.alias("label"), scaled.alias("vector")), d


def mine(vectors, every=100, positives=POSITIVES, negatives=NEGATIVES, share=SHARE, relabelled=7):
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors(vec_id, embedding, label)``: rows with a null label, a null vector or a null
    or non-finite component take no part, nor do rows with a component so large that scores
    would not fit a long (2^20 at 64 dimensions). Where ``vec_id`` is divisible by
    ``relabelled`` the label becomes the next of ten. Rows whose ``vec_id`` is divisible by
    ``every`` are anchors; of the other rows with its label the ``positives`` best are its
    positives, and each has the ``negatives`` best rows of other labels whose score lies
    between ``share`` per cent of the positive's and all of it. Equal scores go by ascending
    ``vec_id``, null last; rows with the same ``vec_id`` are rows of their own. Shorter vectors
    end in zeros, empty ones are all zeros; other columns are left out; an empty table gives
    an empty result.
    """
    rows, d = prepared(vectors, relabelled)
    segments = written(mapped(rows, _segments(d), _SEGMENT), "vectors")
    blocks = written(mapped(segments, _blocks(d, every), _BLOCK), "anchors")

    near = mapped(met(segments, "segment", blocks), _positives(d, positives), _longs(_POSITIVE))
    order = Window.partitionBy("anchor").orderBy(
        F.col("positive_score").desc(), F.col("positive_id").asc_nulls_last(), "positive")
    near = near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    wanted = written(near.groupBy("block").agg(F.collect_list(F.struct(
        "anchor", "positive", "positive_id", "positive_score")).alias("wanted")), "positives")

    asked = blocks.join(wanted, "block")
    hard = mapped(met(segments, "segment", asked), _negatives(d, negatives, share), _longs(_NEGATIVE))
    order = Window.partitionBy("anchor", "positive").orderBy(
        F.col("negative_score").desc(), F.col("negative_id").asc_nulls_last(), "negative")
    return hard.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
        "positive_score", "negative_score")


#: The result of op11 in DuckDB's SQL.
SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
        list_inner_product(a.e, b.e)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (
        PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""
