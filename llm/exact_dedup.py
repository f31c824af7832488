"""Exact deduplication by Grace hashing.

Records are dealt by the hash of their normalised text into buckets that Spark's exchange
writes to spill files; each bucket is read through an open-addressing table that compares
complete texts. A text that finds no room in a full table is handed on, and the next level
deals what is left by other digits of the hash into more buckets, until nothing is left.

Before the first exchange every task folds its own copies in a table of the same kind, so
that of a group with a third of all rows one record for each task is dealt, not one for
each copy. Copies only carry the number of the record they were folded into.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.frames import mapped, parallelism, written
from llm.words import SLICE_BYTES, UNSPACED, slices, utf8

#: Text bytes that one table may hold, and that one bucket should hold.
TABLE_BYTES = 16 << 20
BUCKET_BYTES = 12 << 20


class OpenTable:
    """Open addressing with linear probing; equal means equal in all bytes."""

    def __init__(self, limit):
        self.limit, self.bytes = limit, 0
        self.slots = [-1] * 1024
        self.digests, self.texts, self.values = [], [], []

    def place(self, digest, text):
        """The entry of this text, or ~slot where it would go."""
        mask = len(self.slots) - 1
        slot = int.from_bytes(digest[:8], "little") & mask
        while (entry := self.slots[slot]) >= 0:
            if self.digests[entry] == digest and self.texts[entry] == text:
                return entry
            slot = (slot + 1) & mask
        return ~slot

    def full(self, text):
        return bool(self.texts) and self.bytes + len(text) > self.limit

    def add(self, slot, digest, text, value):
        self.slots[slot] = len(self.texts)
        self.digests.append(digest)
        self.texts.append(text)
        self.values.append(value)
        self.bytes += len(text) + 200
        if 2 * len(self.texts) > len(self.slots):
            self.slots = [-1] * (2 * len(self.slots))
            mask = len(self.slots) - 1
            for entry, key in enumerate(self.digests):
                slot = int.from_bytes(key[:8], "little") & mask
                while self.slots[slot] >= 0:
                    slot = (slot + 1) & mask
                self.slots[slot] = entry
        return len(self.texts) - 1


def squeezed(column):
    """Each text's UTF-8 bytes with every run of white space as one space."""
    data, offsets = utf8(column)
    blank = ~UNSPACED[data]
    keep = np.ones(len(data), dtype=bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    keep[offsets[:-1][offsets[1:] > offsets[:-1]]] = True  # a text's first byte stays
    data = np.where(blank, np.uint8(32), data)[keep].tobytes()
    places = np.concatenate(([0], np.cumsum(keep)))[offsets]
    return [data[a:b] for a, b in zip(places[:-1].tolist(), places[1:].tolist())]


_FOLDED = "row long, id long, rep long, copies long, least long, digest binary, text binary"


def _fold(batches):
    """Each row with the row of this task that it is a copy of; only the latter has a text."""
    row = TaskContext.get().partitionId() << 40
    table, counts = OpenTable(TABLE_BYTES), []

    def closed():
        """What the table has gathered: text rows with counts and smallest ids."""
        out = [[], [], [], [], [], [], []]
        for entry, (first, n, least) in enumerate(counts):
            for column, value in zip(out, (first, None, first, n, least, table.digests[entry],
                                           table.texts[entry])):
                column.append(value)
        return out

    def sent(columns):
        types = [pa.int64()] * 5 + [pa.binary()] * 2
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)],
            ["row", "id", "rep", "copies", "least", "digest", "text"])

    for whole in batches:
        for batch in slices(whole, "text", SLICE_BYTES):
            ids = batch.column("doc_id").to_pylist()
            out = [[], [], [], [], [], [], []]
            for key, text in zip(ids, squeezed(batch.column("text"))):
                digest = hashlib.sha256(text).digest()
                entry = table.place(digest, text)
                if entry < 0:
                    if table.full(text):
                        yield sent(closed())
                        table, counts = OpenTable(TABLE_BYTES), []
                        entry = table.place(digest, text)
                    entry = table.add(~entry, digest, text, None)
                    counts.append([row, 0, None])
                gathered = counts[entry]
                gathered[1] += 1
                if key is not None and (gathered[2] is None or key < gathered[2]):
                    gathered[2] = key
                for column, value in zip(out, (row, key, gathered[0], None, None, digest, None)):
                    column.append(value)
                row += 1
            yield sent(out)
    yield sent(closed())


_SETTLED = "rep long, keep_id long, group_size long, keep_rep long, digest binary, text binary"


def _settle(batches):
    """Classes of a bucket's texts; rows beyond the table keep their text for the next level."""
    table, members, full = OpenTable(TABLE_BYTES), [], False
    types = [pa.int64()] * 4 + [pa.binary()] * 2
    names = ["rep", "keep_id", "group_size", "keep_rep", "digest", "text"]
    for batch in batches:
        left = [[], [], [], [], [], []]
        for rep, n, least, digest, text in zip(*(
                batch.column(c).to_pylist() for c in ("rep", "copies", "least", "digest", "text"))):
            entry = table.place(digest, text)
            if entry < 0:
                full = full or table.full(text)  # from then on no new text is let in
                if full:
                    for column, value in zip(left, (rep, least, n, None, digest, text)):
                        column.append(value)
                    continue
                entry = table.add(~entry, digest, text, None)
                members.append([[], 0, None, None])
            group = members[entry]
            group[0].append(rep)
            group[1] += n
            order = (least is None, least, rep)
            if group[2] is None or order < group[2]:
                group[2], group[3] = order, rep
        if left[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(left, types)], names)
    for start in range(0, len(members), 4096):
        out = [[], [], [], []]
        for reps, n, order, keep_rep in members[start:start + 4096]:
            out[0] += reps
            out[1] += [order[1]] * len(reps)
            out[2] += [n] * len(reps)
            out[3] += [keep_rep] * len(reps)
        blank = pa.nulls(len(out[0]), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(out, types)] + [blank, blank], names)


def exact_dedup(docs, bucket_bytes=BUCKET_BYTES):
    """One row for each row of ``docs(doc_id, text)``, whatever other columns it has.

    ``keep_id`` is the smallest ``doc_id`` among rows with the same text after every run of
    ``[\\x20\\x09-\\x0D]`` became one space, ``group_size`` their number, ``kept`` whether
    this row stays, ``text_sha256`` the digest of that text. Null text counts as empty; a
    null ``doc_id`` comes after every other. Where the smallest id stands on several rows
    of a group, one of them stays. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    pairs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    folded = written(mapped(pairs, _fold, _FOLDED), "folded")
    level, left, settled = 0, folded.where("text IS NOT NULL").drop("row", "id"), []
    while True:
        size = left.agg(F.sum(F.length("text") + 200)).first()[0] or 0
        if level and not size:
            break
        buckets = max(parallelism(spark), -(-size // bucket_bytes))
        dealt = left.repartition(buckets, F.xxhash64(F.lit(level), "digest"))
        done = written(mapped(dealt, _settle, _SETTLED), f"bucket-level-{level}")
        settled.append(done.where("text IS NULL").drop("digest", "text"))
        left = done.where("text IS NOT NULL").select(
            "rep", F.col("group_size").alias("copies"), F.col("keep_id").alias("least"),
            "digest", "text")
        level += 1
    classes = settled[0]
    for more in settled[1:]:
        classes = classes.union(more)
    rows = folded.where("text IS NULL").select("row", "id", "rep", "digest")
    # The row that stays: the first of its task's fold with the smallest id.
    firsts = rows.join(classes.where("rep = keep_rep"), "rep").where("id <=> keep_id") \
        .groupBy("rep").agg(F.min("row").alias("keep_row"))
    classes = classes.join(firsts.withColumnRenamed("rep", "keep_rep"), "keep_rep")
    return rows.join(classes, "rep").select(
        F.col("id").alias("doc_id"), "keep_id", "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def _digested(batches):
    for whole in batches:
        for batch in slices(whole, "text", SLICE_BYTES):
            digests = [hashlib.sha256(text).digest() for text in squeezed(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(digests, pa.binary())], [*batch.schema.names, "digest*"])


def deduplicated(docs):
    """The rows of ``docs`` with all their columns, one of each group of equal texts."""
    kept = exact_dedup(docs).where("kept").select(
        F.col("doc_id").alias("kept_id"), F.unhex("text_sha256").alias("kept_digest"))
    rows = mapped(docs, _digested, T.StructType(
        [*docs.schema.fields, T.StructField("digest*", T.BinaryType())]))
    on = rows["doc_id"].eqNullSafe(kept["kept_id"]) & (rows["`digest*`"] == kept["kept_digest"])
    # Rows that repeat id and text are still together; one of them stays.
    return rows.join(kept, on, "left_semi").dropDuplicates(["doc_id", "digest*"]).drop("digest*")


#: The result of op9 in DuckDB's SQL.
SQL = r"""
WITH t AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
    FROM documents),
g AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t.body) AS text_sha256
FROM t JOIN g ON t.body = g.body
"""
