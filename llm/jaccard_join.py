"""Exact n-gram Jaccard join of texts: numbers of links and components of linked documents.

Jaccard distance is a metric, but between unrelated texts it is about 1, so pivots alone
would put every document within the window of every region. Regions are therefore made in
two steps. First, documents that share an anchor meet: the anchors of a set are its first
elements in a global order, as many as two linked sets cannot both avoid. There a sketch
that never overestimates the difference removes pairs that cannot be linked, and what is
left connects documents to coarse regions. Then a region is joined recursively and exactly:
pivots create Voronoi cells, a document goes to the cell of its nearest pivot and, within a
window of twice the radius that the triangle inequality allows, to others. ``link_counts``
counts every link there once. Where only components are asked for, links found on
the way are contracted, so that sets connected already don't meet again; regions that no
pivots divide are compared in blocks of sets that nothing connects yet.
"""

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from llm.components import components
from llm.frames import mapped, parallelism, written
from llm.link_counts import links as counted_links
from llm.words import SLICE_BYTES, UNSPACED, Words, mix, slices, utf8

#: Elements are counted in 2**BUCKET_BITS buckets, of which a slice of 2**SLICE_BITS is one
#: array; so what is broadcast has a fixed size. Bucket collisions only make elements look
#: more common than they are, which changes their order and not the result.
BUCKET_BITS, SLICE_BITS = 27, 18
#: Elements of so many sets come last in the order; members of an anchor that are compared
#: in one task; members of a leaf region.
COMMON, MEMBERS, LEAF = 16, 1000, 1000
#: Pivots of a region.
PIVOTS = 16
#: A region is not divided by its pivots if a cell keeps more than this part of it, or if
#: all cells together hold more than so many times its sets.
UNDIVIDED, REPEATED = 0.8, 3

_FACTORS = [np.uint64(x) for x in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
    0x85EBCA77C2B2AE63)]


def _factor(i):
    return _FACTORS[i % 5] + np.uint64(2 * (i // 5))


def shingle_sets(column, size):
    """Each text's distinct shingles as sorted 64-bit hashes."""
    words = Words(*utf8(column), UNSPACED)
    h = words.hashes()
    n = len(h) - size + 1
    grams = mix(sum(h[i:n + i] * _factor(i) for i in range(size))) if n > 0 else h[:0]
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        if b - a >= size:
            yield np.unique(grams[a:b - size + 1])
        elif b > a:
            yield mix(sum(h[a + i:a + i + 1] * _factor(i) for i in range(b - a)) + np.uint64(b - a))
        else:
            yield h[:0]


class Threshold:
    """Jaccard similarity of at least ``num / den``, in whole numbers."""

    def __init__(self, num, den):
        self.num, self.den = num, den
        self.radius = 1 - num / den

    def anchors(self, n):
        """Elements of which linked sets share one, in any order of all elements."""
        return n - -(-self.num * n // self.den) + 1

    def overlap(self, a, b):
        """Smallest intersection that links sets of these sizes."""
        return -(-self.num * (a + b) // (self.num + self.den))

    def linked(self, a, b, shared):
        return self.den * shared >= self.num * (a + b - shared)


def _buckets(hashes):
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _flags(bits, hashes):
    at = _buckets(hashes)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _sliced(hashes):
    """A batch of (slice, places in the slice) for elements to be counted."""
    at = np.sort(_buckets(hashes))
    cuts = np.searchsorted(at, np.arange((1 << BUCKET_BITS - SLICE_BITS) + 1) << SLICE_BITS)
    used = np.flatnonzero(np.diff(cuts))
    places = (at & (1 << SLICE_BITS) - 1).astype("<u4")
    return pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)),
         pa.array([places[cuts[i]:cuts[i + 1]].tobytes() for i in used], pa.binary())],
        ["slice", "places"])


_PLACES = "slice int, places binary"


def _reached(thresholds):
    def reached(batches):
        counts = {}
        for batch in batches:
            for number, places in zip(*(batch.column(c).to_pylist() for c in ("slice", "places"))):
                own = counts.setdefault(number, np.zeros(1 << SLICE_BITS, dtype=np.uint16))
                at, n = np.unique(np.frombuffer(places, "<u4"), return_counts=True)
                own[at] = np.minimum(own[at] + n, 65535)
        for number, own in counts.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * len(thresholds), pa.int32()), pa.array(thresholds, pa.int32()),
                 pa.array([np.packbits(own >= t, bitorder="little").tobytes() for t in thresholds],
                          pa.binary())], ["slice", "least", "bits"])
    return reached


def _bitsets(places, thresholds):
    """For each threshold a broadcast bitset of the buckets with at least that count."""
    spark = places.sparkSession
    parts = min(1 << BUCKET_BITS - SLICE_BITS, parallelism(spark))
    dealt = places.repartition(parts, "slice")
    found = mapped(dealt, _reached(thresholds), "slice int, least int, bits binary").toArrow()
    size = 1 << SLICE_BITS - 3
    sets = {t: np.zeros(1 << BUCKET_BITS - 3, dtype=np.uint8) for t in thresholds}
    for number, least, bits in zip(*(found.column(c).to_pylist() for c in (
            "slice", "least", "bits"))):
        sets[least][number * size:(number + 1) * size] = np.frombuffer(bits, np.uint8)
    return [spark.sparkContext.broadcast(sets[t]) for t in thresholds]


def _released(*bitsets):
    """What was found by them is written: the executors need not hold them any longer."""
    for bits in bitsets:
        bits.unpersist()


class Order:
    """The global order of elements from which anchors are taken.

    The share of all elements below ``limit`` was counted. Those counted once come first,
    as they meet no one; then those of few sets, then the uncounted, then the common ones.
    """

    def __init__(self, limit, repeated=None, common=None):
        self.limit, self.repeated, self.common = np.uint64(limit), repeated, common

    def first(self, elements, n):
        """The first n of a sorted set."""
        counted = int(np.searchsorted(elements, self.limit))
        own = elements[:counted]
        common = _flags(self.common.value, own)
        repeated = _flags(self.repeated.value, own) & ~common
        ranked = [own[~repeated & ~common], own[repeated], elements[counted:], own[common]]
        return np.concatenate(ranked)[:n]


def sketch(elements):
    """Parities of the elements' numbers in hash buckets, of half as many bits or more.

    The sketches of two sets differ in at most as many bits as the sets in elements.
    """
    bits = max(64, (1 << (len(elements) - 1).bit_length()) // 2)
    counts = np.bincount((elements >> np.uint64(8) & np.uint64(bits - 1)).astype(np.int64),
                         minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def _fresh(column, size, seen):
    """(row, elements, digest, whether this task met the set first) of each text."""
    for row, elements in enumerate(shingle_sets(column, size)):
        digest = hashlib.blake2b(elements.tobytes(), digest_size=16).digest()
        first = digest not in seen and len(elements) > 0
        if first:
            seen.add(digest)
        yield row, elements, digest, first


def _placed(size, chosen):
    """Buckets of the chosen elements of every set, once for each task that meets it."""
    def placed(batches):
        seen = set()
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                found = [chosen(e) for _, e, _, first in _fresh(batch.column("text"), size, seen)
                         if first]
                if found:
                    yield _sliced(np.concatenate(found))
    return placed


_ROWS = ("row long, doc_id long, digest binary, n int, anchors array<long>, "
         "crowded array<long>, sketch binary")


def _described(size, threshold, order, shared, crowded):
    types = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int64()),
             pa.list_(pa.int64()), pa.binary()]
    names = ["row", "doc_id", "digest", "n", "anchors", "crowded", "sketch"]

    def described(batches):
        number, seen = TaskContext.get().partitionId() << 40, set()
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                ids = batch.column("doc_id").to_pylist()
                out = [[] for _ in types]
                for i, elements, digest, first in _fresh(batch.column("text"), size, seen):
                    some = more = bits = None
                    if first:
                        own = order.first(elements, threshold.anchors(len(elements)))
                        own = own[_flags(shared.value, own)]
                        many = _flags(crowded.value, own)
                        some, more = (own[~many].astype(np.int64).tolist(),
                                      own[many].astype(np.int64).tolist())
                        bits = sketch(elements)
                    for column, value in zip(out, (
                            number, ids[i], digest, len(elements), some, more, bits)):
                        column.append(value)
                    number += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, types)], names)
    return described


def _folded(bits, width, size):
    """A sketch of fewer bits (both powers of two): parities over joined buckets."""
    while width > size:
        width >>= 1
        bits = (bits >> width) ^ (bits & (1 << width) - 1)
    return bits


def _forest(members, threshold):
    """Edges that connect members of one anchor which the sketches leave possible.

    A member is compared with each group found so far until one of its members fits, so
    that near copies cost one comparison each, not one for every pair.
    """
    groups = []
    for key, n, width, bits in sorted(members, key=lambda m: (m[1], m[0])):
        own, apart = [(key, n, width, bits)], []
        for group in groups:
            fits = None
            for other in reversed(group):  # sizes fall
                if threshold.den * other[1] < threshold.num * n:
                    break
                small = min(width, other[2])
                apart_by = _folded(bits, width, small) ^ _folded(other[3], other[2], small)
                if apart_by.bit_count() <= n + other[1] - 2 * threshold.overlap(n, other[1]):
                    fits = other
                    break
            if fits is None:
                apart.append(group)
            else:
                yield fits[0], key
                own = group + own if len(own) == 1 else sorted(group + own, key=lambda m: m[1])
        groups = [*apart, own]


def _meeting(threshold):
    def meeting(batches):
        anchor, members, out = None, [], set()

        def closed():
            if len(members) > 1:
                out.update(_forest(members, threshold))

        def sent():
            a, b = zip(*out)
            batch = pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
            out.clear()
            return batch

        for batch in batches:
            for key, cid, n, bits in zip(*(batch.column(c).to_pylist() for c in (
                    "anchor", "cid", "n", "sketch"))):
                if key != anchor:
                    closed()
                    anchor, members = key, []
                    if len(out) > 50_000:
                        yield sent()
                members.append((cid, n, 8 * len(bits), int.from_bytes(bits, "little")))
        closed()
        if out:
            yield sent()
    return meeting


def _sets(size, wanted):
    def sets(batches):
        seen = set()
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                digests, blobs = [], []
                for _, elements, digest, first in _fresh(batch.column("text"), size, seen):
                    if first and _flags(wanted.value, _place(digest[:8]))[0]:
                        digests.append(digest)
                        blobs.append(elements.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests, pa.binary()), pa.array(blobs, pa.binary())],
                    ["digest", "elements"])
    return sets


def _place(digest):
    return np.frombuffer(digest, dtype="<u8").astype(np.uint64)


def _digest_places(batches):
    for batch in batches:
        digests = batch.column("digest").to_pylist()
        if digests:
            yield _sliced(_place(b"".join(d[:8] for d in digests)))


class Region:
    """Sets that are joined in memory."""

    def __init__(self, keys, sides, sets, labels, threshold):
        self.keys, self.sides, self.sets, self.threshold = keys, sides, sets, threshold
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        first = {}  # sets of a label are linked already
        self.parent = [first.setdefault(label, i) for i, label in enumerate(labels)]
        self.edges = []

    def root(self, i):
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def link(self, i, j):
        a, b = self.root(i), self.root(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.edges.append((self.keys[i], self.keys[j]))

    def shared(self, i, others):
        """Sizes of the intersections of set i with the others."""
        own = self.sets[i]
        all_ = np.concatenate([self.sets[j] for j in others])
        at = np.minimum(np.searchsorted(own, all_), len(own) - 1)
        sizes = self.sizes[others]
        return np.add.reduceat((own[at] == all_).astype(np.int64),
                               np.cumsum(sizes) - sizes)

    def join(self, members):
        """Links of the members by recursive Voronoi cells."""
        if len({self.root(i) for i in members.tolist()}) == 1:
            return None
        if len(members) <= 16:
            return self.compare(members, None)
        pivots, distances = [], []
        nearest = np.full(len(members), np.inf)
        while len(pivots) < PIVOTS:  # the next pivot is the member farthest from the others
            p = int(nearest.argmax()) if pivots else 0
            if pivots and nearest[p] <= 0:
                break
            shared = self.shared(members[p], members)
            union = self.sizes[members] + self.sizes[members[p]] - shared
            distances.append(1 - shared / union)
            pivots.append(p)
            linked = self.threshold.linked(self.sizes[members], self.sizes[members[p]], shared)
            for i in members[linked].tolist():
                self.link(int(members[p]), i)
            nearest = np.minimum(nearest, distances[-1])
        distances = np.array(distances)
        reach = distances <= nearest + 2 * self.threshold.radius + 1e-9
        cells = [members[r] for r in reach if r.sum() > 1]
        sizes = [len(c) for c in cells]
        if max(sizes, default=0) > UNDIVIDED * len(members) or sum(sizes) > REPEATED * len(members):
            return self.compare(members, distances)
        for cell in cells:
            self.join(cell)
        return None

    def compare(self, members, distances):
        """Links of members whose distances to every pivot allow it, by size and pivots."""
        order = np.argsort(self.sizes[members], kind="stable")
        members = members[order]
        if distances is not None:
            distances = distances[:, order]
        sizes, t = self.sizes[members], self.threshold
        for k in range(len(members)):
            stop = int(np.searchsorted(sizes * t.num, sizes[k] * t.den, "right"))
            rest = np.arange(k + 1, stop)
            if distances is not None and len(rest):
                rest = rest[(np.abs(distances[:, rest] - distances[:, [k]])
                             <= t.radius + 1e-9).all(axis=0)]
            i, own = int(members[k]), self.root(int(members[k]))
            rest = members[rest]
            if self.sides is not None:
                rest = rest[self.sides[rest] != self.sides[i]]
            rest = [j for j in rest.tolist() if self.root(j) != own]
            if rest:
                shared = self.shared(i, rest)
                ok = t.linked(self.sizes[i], self.sizes[rest], shared)
                for j in np.array(rest)[ok].tolist():
                    self.link(i, j)


def _leaves(threshold):
    def leaves(batches):
        region, rows = None, {}

        def closed():
            if len(rows) < 2:
                return None
            keys = sorted(rows)
            sides = np.array([rows[k][0] for k in keys])
            own = Region(keys, sides if len(set(sides.tolist())) > 1 else None,
                         [np.frombuffer(rows[k][1], dtype=np.uint64) for k in keys],
                         [rows[k][2] for k in keys], threshold)
            own.join(np.arange(len(keys))) if own.sides is None else \
                own.compare(np.arange(len(keys)), None)
            if not own.edges:
                return None
            a, b = zip(*own.edges)
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            for key, cid, side, blob, label in zip(*(batch.column(c).to_pylist() for c in (
                    "region", "cid", "side", "elements", "label"))):
                if key != region:
                    if (found := closed()) is not None:
                        yield found
                    region, rows = key, {}
                rows[cid] = (side, blob, label)
        if (found := closed()) is not None:
            yield found
    return leaves


_CELLS = "region long, parent long, cid long, elements binary, a long, b long"


def _celled(threshold):
    """Rows of large regions with their region's pivots: the cells each row belongs to."""
    def celled(batches):
        names = [c.split()[0] for c in _CELLS.split(", ")]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
        known = {}
        for batch in batches:
            out = [[] for _ in types]
            for region, cid, blob, pivots in zip(*(batch.column(c) for c in (
                    "region", "cid", "elements", "pivots"))):
                region, cid, blob = region.as_py(), cid.as_py(), blob.as_py()
                if region not in known:
                    known = {region: [(p["cid"], np.frombuffer(p["elements"], np.uint64))
                                      for p in pivots.as_py()]}
                own = np.frombuffer(blob, dtype=np.uint64)
                distance = []
                for key, other in known[region]:
                    at = np.minimum(np.searchsorted(other, own), len(other) - 1)
                    shared = int((other[at] == own).sum())
                    distance.append(1 - shared / (len(own) + len(other) - shared))
                    if key != cid and threshold.linked(len(own), len(other), shared):
                        for column, value in zip(out, (None, None, None, None, key, cid)):
                            column.append(value)
                least = min(distance)
                for i, d in enumerate(distance):
                    if d <= least + 2 * threshold.radius + 1e-9:
                        cell = hash((region, i)) & (1 << 62) - 1
                        for column, value in zip(out, (cell, region, cid, blob, None, None)):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)
    return celled


def _split(large, threshold, turn, leaf):
    """Cells of large(region, cid, label, elements, n) and the links to pivots found on the way.

    Labels are dealt to PIVOTS shares of a region, and the set with the smallest hash in each
    is a pivot, so that sets linked already give one pivot at most; each turn has others. A
    region's rows are dealt over the cluster, in as many shares as it is large, and its pivots
    go to each share.
    """
    most = 4 * parallelism(large.sparkSession)
    pivots = large.groupBy("region", F.pmod(F.xxhash64("label", F.lit(turn)), F.lit(PIVOTS)).alias(
        "part")).agg(F.min(F.struct(F.xxhash64("cid", F.lit(turn)).alias("order"), F.col("cid")))
                     .alias("least")).select("region", F.col("least.cid").alias("cid"))
    chosen = large.join(pivots, ["region", "cid"]).groupBy("region", "n").agg(
        F.sort_array(F.collect_list(F.struct("cid", "elements"))).alias("pivots"))
    shares = F.least(F.lit(most).cast("long"), F.ceil(F.col("n") / leaf).cast("long"))
    dealt = large.withColumn("share", F.pmod(F.xxhash64("cid", F.lit(1)), shares))
    spread = chosen.select("region", "pivots", F.explode(F.sequence(
        F.lit(0).cast("long"), shares - 1)).alias("share"))
    rows = dealt.join(spread, ["region", "share"])
    return written(mapped(rows.select("region", "cid", "elements", "pivots"),
                          _celled(threshold), _CELLS), "cells")


def _blocks(dense, leaf):
    """Leaves of two sides: pairs of blocks of dense(region, cid, label, elements).

    Pivots could not divide these regions, so all their sets lie close together. Sets of one
    label are linked already: a label of more than half a leaf has blocks of its own, which
    meet the blocks of the others only; so a large group of linked sets is met by what is
    outside of it, and not by itself.
    """
    half = max(1, leaf // 2)
    per_label = dense.groupBy("region", "label").agg(F.count(F.lit(1)).alias("m"))
    own = F.col("m") > half
    rest = per_label.where(~own).groupBy("region").agg(F.sum("m").alias("rest"))
    named = written(per_label.join(rest, "region", "left").select(
        "region", "label", F.when(own, F.col("label")).alias("group"),
        F.ceil(F.when(own, F.col("m")).otherwise(F.col("rest")) / half).cast("long").alias("parts")),
        "labels")
    part = F.pmod(F.when(F.col("group").isNull(), F.xxhash64("label", F.lit(2)))
                  .otherwise(F.xxhash64("cid", F.lit(2))), F.col("parts"))
    rows = dense.join(named, ["region", "label"]).withColumn("part", part)
    blocks = written(rows.select("region", "group", "part").distinct().withColumn(
        "block", F.xxhash64("group", "part")), "blocks")
    other = blocks.select("region", F.col("group").alias("group2"), F.col("block").alias("block2"))
    pairs = blocks.join(other, "region").where(
        "block <= block2 AND (group IS NULL OR group2 IS NULL OR group <> group2)").select(
        "region", "block", "block2", F.xxhash64("region", "block", "block2").alias("leaf"))
    sides = pairs.select("region", "block", "leaf", F.lit(0).alias("side")).union(
        pairs.where("block < block2").select("region", "block2", "leaf", F.lit(1)))
    return rows.withColumn("block", F.xxhash64("group", "part")).join(
        sides, ["region", "block"]).select(
        F.col("leaf").alias("region"), "cid", "side", "label", "elements")


def _labelled(rows, labels):
    """The rows with the label of what links found so far connect them to."""
    return rows.drop("label").join(labels, "cid", "left").withColumn(
        "label", F.coalesce("label", "cid"))


def _divided(rows, cells, labels, leaf):
    """What becomes of each region that was split.

    (cell, keep) of the cells that go on, and (region, left, again) of the regions that their
    pivots did not divide: ``left`` is what lies outside of the largest label. While a turn
    halves that, the region gets other pivots ``again``; else it is compared in blocks.
    """
    tally = written(_labelled(cells.select("region", "parent", "cid"), labels).groupBy(
        "parent", "region").agg(F.count(F.lit(1)).alias("m"),
                                (F.min("label") != F.max("label")).alias("mixed")), "cell-sizes")
    ids = _labelled(rows.select("region", "cid", "n", "before"), labels)
    largest = ids.groupBy("region", "n", "before", "label").agg(F.count(F.lit(1)).alias("m")) \
        .groupBy("region", "n", "before").agg((F.col("n") - F.max("m")).alias("left"))
    state = written(tally.groupBy(F.col("parent").alias("region")).agg(
        F.max("m").alias("most"), F.sum("m").alias("all")).join(largest, "region").select(
        "region", "left",
        ((F.col("most") > UNDIVIDED * F.col("n")) | (F.col("all") > REPEATED * F.col("n")))
        .alias("dense"),
        ((F.col("left") > leaf) & (2 * F.col("left") <= F.coalesce("before", "n"))).alias("again")),
        "states")
    kept = tally.where("mixed").join(
        state.where("NOT dense").select(F.col("region").alias("parent")), "parent", "left_semi")
    return kept.select("region"), state.where("dense AND left > 0").drop("dense")


def _joined(regions, threshold, leaf):
    """Exact links within regions(region, cid, elements); large ones are divided first.

    Links to pivots are contracted after every turn: cells and leaves whose sets are all
    connected already are done.
    """
    links, leaves, turn = [], [], 0
    regions = regions.select("region", "cid", F.col("cid").alias("label"), "elements",
                             F.lit(None).cast("long").alias("before"))
    while True:
        sizes = written(regions.groupBy("region").agg(F.count(F.lit(1)).alias("n")), "region-sizes")
        large = sizes.where(F.col("n") > leaf)
        divided = not large.isEmpty()
        small = regions.join(large, "region", "left_anti") if divided else regions
        leaves.append(small.select("region", "cid", F.lit(0).alias("side"), "label", "elements"))
        if not divided:
            break
        rows = regions.join(large, "region")
        split = _split(rows, threshold, turn, leaf)
        links.append(split.where("a IS NOT NULL").select("a", "b"))
        labels = written(components(_union(links)).select(F.col("node").alias("cid"), "label"),
                         "linked")
        cells = split.where("a IS NULL").select("region", "parent", "cid", "elements")
        kept, dense = _divided(rows, cells, labels, leaf)
        rows = _labelled(rows.select("region", "cid", "label", "elements").join(
            dense, "region"), labels)
        leaves.append(_blocks(rows.where("NOT again"), leaf))
        columns = ["region", "cid", "label", "elements", "before"]
        regions = _labelled(cells.join(kept, "region", "left_semi"), labels).withColumn(
            "before", F.lit(None).cast("long")).select(columns).union(
            rows.where("again").withColumn("before", F.col("left")).select(columns))
        turn += 1
    for some in leaves:
        dealt = some.repartition(parallelism(some.sparkSession), "region") \
            .sortWithinPartitions("region")
        links.append(mapped(dealt, _leaves(threshold), "a long, b long"))
    return _union(links)


def _union(frames):
    return reduce(lambda a, b: a.unionByName(b), frames)


def jaccard_join(docs, size=5, num=80, den=100, common=COMMON, members=MEMBERS, leaf=LEAF,
                 count=True):
    """``doc_id, n_shingles, component_id, n_links`` for each row of ``docs(doc_id, text)``.

    A text's set is its distinct shingles of ``size`` words (``[^\\x20\\x09-\\x0D]+`` after
    lower-casing A-Z); one of fewer words has its whole sequence as one, a null or wordless
    text has none and is linked with nothing. Rows whose sets have a Jaccard similarity of at
    least ``num / den`` are linked; ``component_id`` is the smallest ``doc_id`` that links
    reach, the own one included (null only where all are null), ``n_links`` the number of
    other rows linked to it directly. Without ``count`` there is no ``n_links``: sets that are
    connected already don't meet again, which saves most of the work in large groups. ``common``, ``members`` and
    ``leaf`` say how work is divided, not what is found. Equal sets count as one until the
    end, so copies cost nothing; repeated rows stay; other columns are left out; an empty
    table gives an empty result.
    """
    threshold = Threshold(num, den)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    texts = docs.select("text")
    # Four times as many elements as anchors are counted: enough that most sets find as many
    # anchors among those of no other set.
    limit = min((1 << 64) - 1, int((1 - num / den) * 4 * (1 << 64)))
    order = Order(limit, *_bitsets(
        mapped(texts, _placed(size, lambda e: e[:np.searchsorted(e, np.uint64(limit))]), _PLACES),
        [2, common]))
    shared, crowded = _bitsets(
        mapped(texts, _placed(size, lambda e: order.first(e, threshold.anchors(len(e)))), _PLACES),
        [2, members])
    rows = written(mapped(docs, _described(size, threshold, order, shared, crowded), _ROWS),
                   "described")
    _released(order.repeated, order.common, shared, crowded)
    classes = rows.where("n > 0").groupBy("digest").agg(
        F.min("row").alias("cid"), F.min("doc_id").alias("least"),
        F.count(F.lit(1)).alias("copies"))
    heads = rows.where("sketch IS NOT NULL").join(classes.select("cid", "copies"),
                                                  F.col("row") == F.col("cid"))
    met = heads.select(F.explode("anchors").alias("anchor"), "cid", "n", "sketch")
    met = met.repartition(parallelism(docs.sparkSession), "anchor").sortWithinPartitions("anchor")
    near = mapped(met, _meeting(threshold), "a long, b long")
    crowds = heads.select(F.explode("crowded").alias("anchor"), "cid")
    hubs = crowds.groupBy("anchor").agg(F.min("cid").alias("a"))
    near = near.union(crowds.join(hubs, "anchor").select("a", F.col("cid").alias("b")))
    coarse = components(near).select(F.col("node").alias("cid"), F.col("label").alias("region"))
    involved = written(heads.select("cid", "digest", "copies").join(coarse, "cid"), "involved")
    wanted, = _bitsets(mapped(involved.select("digest"), _digest_places, _PLACES), [1])
    sets = mapped(texts, _sets(size, wanted), "digest binary, elements binary")
    sets = sets.dropDuplicates(["digest"])
    regions = written(involved.join(sets, "digest").select(
        "region", "cid", F.col("copies").alias("weight"), "elements"), "regions")
    _released(wanted)
    if count:
        found = counted_links(regions, threshold, leaf)
        links = found.where("a IS NOT NULL").select("a", "b")
        degrees = found.where("cid IS NOT NULL").groupBy("cid").agg(F.sum("links").alias("links"))
        classes = classes.join(degrees, "cid", "left").withColumn(
            "n_links", F.col("copies") - 1 + F.coalesce("links", F.lit(0)))
    else:
        links = _joined(regions, threshold, leaf)
    labels = components(links).select(F.col("node").alias("cid"), "label")
    named = classes.join(labels, "cid", "left").withColumn(
        "label", F.coalesce("label", "cid"))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    counts = ["n_links"] if count else []
    named = named.join(least, "label").select("digest", "component_id", *counts)
    return rows.join(named, "digest", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
        .alias("component_id"), *[F.coalesce(c, F.lit(0)).alias(c) for c in counts])


#: The result of op2 in DuckDB's SQL.
SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(words[i:i + 2], ' ') AS shingle
    FROM (SELECT *, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
    FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (
    SELECT x, y FROM i JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
    WHERE 100 * shared >= 90 * (a.n + b.n - shared)),
r AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x),
d AS (SELECT x AS doc_id, count(*) AS n_links FROM l GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links
FROM c LEFT JOIN n USING (doc_id) LEFT JOIN d USING (doc_id)
"""
