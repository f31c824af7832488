"""How many links each set of a Jaccard join has, and links enough to connect them.

Regions of more sets than a leaf are divided by pivots: a set goes to the Voronoi cell of its
nearest pivot, its home, and to every cell whose window the triangle inequality leaves open to
it. So two linked sets meet in the homes of both. Their link is counted in one place: in that
of the two homes which comes first, at every level. Regions whose cells would not halve the
pairs are compared in blocks, of sets whose sizes allow a link.
"""

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from llm.frames import mapped, parallelism, written
from llm.words import mix

#: Pivots of a region; kinds of elements that are multiplied at once.
PIVOTS, KINDS = 16, 2048


def intersections(sets, left, right):
    """Sizes of the intersections of sets[left] with sets[right] (slices of sorted sets).

    Elements that the same sets hold are one kind, told by a 64-bit sum over the sets; near
    copies have few kinds, however long they are.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    elements = np.concatenate(sets)
    order = np.argsort(elements, kind="stable")
    elements, owner = elements[order], np.repeat(np.arange(len(sets)), sizes)[order]
    begins = np.flatnonzero(np.concatenate(([True], elements[1:] != elements[:-1])))
    holders = np.diff(np.append(begins, len(elements)))
    kinds = np.add.reduceat(mix(owner.astype(np.uint64) + np.uint64(1)), begins)
    several = holders > 1
    begins, holders = begins[several], holders[several]
    _, first, weight = np.unique(kinds[several], return_index=True, return_counts=True)
    begins, holders = begins[first], holders[first]
    # Whole numbers up to 2**24 are exact in 32 bits.
    kind = np.float32 if sizes.max() < 1 << 24 else np.float64
    n = np.arange(len(sets))
    shared = np.zeros((len(n[left]), len(n[right])), dtype=kind)
    for at in range(0, len(begins), KINDS):
        begin, held = begins[at:at + KINDS], holders[at:at + KINDS]
        ends = np.cumsum(held)
        places = np.arange(ends[-1]) + np.repeat(begin - ends + held, held)
        holds = np.zeros((len(begin), len(sets)), dtype=kind)
        holds[np.repeat(np.arange(len(begin)), held), owner[places]] = 1
        weighed = holds[:, right] * weight[at:at + KINDS, None].astype(kind)
        shared += holds[:, left].T @ weighed
    return shared.astype(np.int64)


def _spanning(linked):
    """Edges of a forest that connects what a symmetric matrix links."""
    left = np.ones(len(linked), dtype=bool)
    for seed in np.flatnonzero(linked.any(axis=1)).tolist():
        if not left[seed]:
            continue
        left[seed] = False
        waiting = [seed]
        while waiting:
            node = waiting.pop()
            new = np.flatnonzero(linked[node] & left)
            left[new] = False
            for other in new.tolist():
                yield node, other
            waiting += new.tolist()


_LEAF = ["region", "cid", "side", "weight", "elements", "homes", "cells"]
_LINKS = "cid long, links long, a long, b long"


def _leaf(rows, threshold):
    """(cid, links) and edges of a leaf's rows: all of side 0, or those of side 1 before side 2.

    Of two sides one may be empty; the other doesn't meet itself here.
    """
    keys, sides, weights, blobs, homes, cells = zip(*rows)
    sets = [np.frombuffer(b, np.uint64) for b in blobs]
    sizes, weights = np.array([len(s) for s in sets], np.int64), np.array(weights, np.int64)
    k, everyone = sides.count(1), slice(None)
    left, right = (slice(k), slice(k, None)) if sides[0] else (everyone, everyone)
    shared = intersections(sets, left, right)
    linked = threshold.linked(sizes[left, None], sizes[None, right], shared)
    for level, cell in enumerate(cells[0]):
        home = np.array([h[level] for h in homes])
        linked &= np.minimum(home[left, None], home[None, right]) == cell
    whole = np.zeros((len(rows), len(rows)), dtype=bool)
    whole[left, right] = linked
    whole |= whole.T
    np.fill_diagonal(whole, False)
    degrees = whole @ weights
    some = np.flatnonzero(degrees)
    counts = [(keys[i], int(degrees[i])) for i in some.tolist()]
    return counts, [(keys[i], keys[j]) for i, j in _spanning(whole)]


def _leaves(threshold):
    def leaves(batches):
        region, rows = None, []

        def closed():
            counts, edges = _leaf(rows, threshold) if len(rows) > 1 else ([], [])
            blank = [None] * len(counts), [None] * len(edges)
            columns = ([c for c, _ in counts] + blank[1], [n for _, n in counts] + blank[1],
                       blank[0] + [a for a, _ in edges], blank[0] + [b for _, b in edges])
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["cid", "links", "a", "b"])

        for batch in batches:
            for key, *row in zip(*(batch.column(c).to_pylist() for c in _LEAF)):
                if key != region:
                    yield closed()
                    region, rows = key, []
                rows.append(row)
        yield closed()
    return leaves


_ROW = ("region long, parent long, cid long, weight long, n long, elements binary, "
        "homes binary, cells binary")


def _celled(threshold):
    names = [c.split()[0] for c in _ROW.split(", ")]
    types = [pa.int64()] * 5 + [pa.binary()] * 3

    def celled(batches):
        known = {}
        for batch in batches:
            out = [[] for _ in types]
            for region, cid, weight, n, blob, homes, cells, pivots in zip(*(
                    batch.column(c) for c in ("region", "cid", "weight", "n", "elements", "homes",
                                              "cells", "pivots"))):
                region, blob, n = region.as_py(), blob.as_py(), n.as_py()
                if region not in known:
                    known = {region: [np.frombuffer(p, np.uint64) for p in pivots.as_py()]}
                own, distances = np.frombuffer(blob, np.uint64), []
                for other in known[region]:
                    at = np.minimum(np.searchsorted(other, own), len(other) - 1)
                    shared = int((other[at] == own).sum())
                    distances.append(1 - shared / (n + len(other) - shared))
                least = min(distances)
                home = homes.as_py() + bytes([distances.index(least)])
                for i, d in enumerate(distances):
                    if d <= least + 2 * threshold.radius + 1e-9:
                        for column, value in zip(out, (
                                hash((region, i)) & (1 << 62) - 1, region, cid.as_py(),
                                weight.as_py(), n, blob, home, cells.as_py() + bytes([i]))):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)
    return celled


def _split(large, threshold, turn, leaf):
    """Cells of large(region, cid, weight, n, elements, homes, cells, m) with m sets a region.

    Pivots are the sets with the smallest hash in each of PIVOTS shares. A region's rows are
    dealt over the cluster in as many shares as it is large, and its pivots go to each.
    """
    part = F.pmod(F.xxhash64("cid", F.lit(turn)), F.lit(PIVOTS))
    pivots = large.groupBy("region", part.alias("part")).agg(F.min(F.struct(
        F.xxhash64("cid", F.lit(turn + 1)).alias("order"), "cid")).alias("least")).select(
        "region", F.col("least.cid").alias("cid"))
    chosen = large.join(pivots, ["region", "cid"]).groupBy("region", "m").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("cid", "elements"))), lambda p: p["elements"])
        .alias("pivots"))
    shares = F.least(F.lit(4 * parallelism(large.sparkSession)).cast("long"),
                     F.ceil(F.col("m") / leaf).cast("long"))
    dealt = large.withColumn("share", F.pmod(F.xxhash64("cid", F.lit(1)), shares))
    spread = chosen.select("region", "pivots", F.explode(F.sequence(
        F.lit(0).cast("long"), shares - 1)).alias("share"))
    return written(mapped(dealt.join(spread, ["region", "share"]), _celled(threshold), _ROW),
                   "link-cells")


def _blocks(dense, threshold, leaf):
    """Leaves that are blocks (side 0) or pairs of blocks (sides 1 and 2) of a region's sets.

    Sizes fall into classes of the threshold's ratio; linked sets are of one class or of two
    that follow each other.
    """
    half = max(1, leaf // 2)
    ratio = math.log(threshold.den / threshold.num) * (1 + 1e-6) if threshold.num else 0
    sized = dense.withColumn("class", F.floor(F.log("n") / ratio) if ratio else (
        F.col("n") if threshold.num else F.lit(0)).cast("long"))
    parts = written(sized.groupBy("region", "class").agg(
        F.ceil(F.count(F.lit(1)) / half).cast("long").alias("parts")), "link-classes")
    rows = sized.join(parts, ["region", "class"]).withColumn(
        "part", F.pmod(F.xxhash64("cid", F.lit(2)), F.col("parts")))
    blocks = parts.select("region", "class", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    later = F.explode(F.array("class", F.col("class") + 1)).alias("class2")
    other = blocks.select("region", F.col("class").alias("class2"), F.col("part").alias("part2"))
    pairs = blocks.select("*", later).join(other, ["region", "class2"]).where(
        "class < class2 OR part <= part2").withColumn(
        "leaf", F.xxhash64("region", "class", "part", "class2", "part2"))
    apart = F.expr("class < class2 OR part < part2")
    first = pairs.select("region", "class", "part", "leaf", apart.cast("int").alias("side"))
    second = pairs.where(apart).select(
        "region", F.col("class2").alias("class"), F.col("part2").alias("part"), "leaf",
        F.lit(2).alias("side"))
    return rows.join(first.union(second), ["region", "class", "part"]).withColumn(
        "region", F.col("leaf")).select(_LEAF)


def links(regions, threshold, leaf):
    """``cid, links, a, b`` of regions(region, cid, weight, elements): written rows.

    Rows with ``cid`` say how much weight a leaf found linked to that set, and add up; the
    others are links that connect whatever is connected.
    """
    empty = F.lit(b"").alias("homes"), F.lit(b"").alias("cells")
    rows = regions.select("region", "cid", "weight", (F.octet_length("elements") / 8).cast("long")
                          .alias("n"), "elements", *empty)
    leaves, turn = [], 0
    while True:
        sizes = written(rows.groupBy("region").agg(F.count(F.lit(1)).alias("m")), "link-sizes")
        large = sizes.where(F.col("m") > leaf)
        more = not large.isEmpty()
        small = rows.join(sizes.where((F.col("m") > 1) & (F.col("m") <= leaf)), "region", "left_semi")
        leaves.append(small.withColumn("side", F.lit(0)).select(_LEAF))
        if not more:
            break
        big = rows.join(large, "region")
        cells = _split(big, threshold, turn, leaf)
        pairs = cells.groupBy("parent", "region").agg(F.count(F.lit(1)).alias("c")).groupBy(
            F.col("parent").alias("region")).agg(F.sum(F.col("c").cast("double") ** 2).alias("all"))
        divided = written(large.join(pairs, "region").where(
            2 * F.col("all") <= F.col("m").cast("double") ** 2).select("region"), "divided")
        leaves.append(_blocks(big.join(divided, "region", "left_anti"), threshold, leaf))
        rows = cells.join(divided.withColumnRenamed("region", "parent"), "parent", "left_semi") \
            .drop("parent")
        turn += 1
    # Sides in order: a leaf's rows of side 1 come before those of side 2.
    found = [mapped(some.repartition(parallelism(some.sparkSession), "region")
                    .sortWithinPartitions("region", "side", "cid"), _leaves(threshold), _LINKS)
             for some in leaves]
    return written(reduce(lambda a, b: a.unionByName(b), found), "links")
