"""From raw documents to token ids: quality, copies, near copies, benchmark texts, tokens.

Every stage works on all rows that the one before it kept. ``STAGES`` holds the functions in
order; each takes the session, the documents left and the folder with the other tables, and
all but the last return the columns of ``documents``.

In every stage a null text counts as empty, a null or repeated ``doc_id`` is a row of its own,
an empty table gives an empty result, and other columns are handed on as they are. Very long
texts are read whole: a task holds one of them at a time beside its bounded batch.
"""

import public_tokenizers
from pyspark.sql import functions as F

from llm import byte_bpe, decontaminate, exact_dedup, jaccard_join, quality
from llm.frames import numbered, table, without, written

#: Decisions are about rows: ids may be null or repeat.
ROW = "row_of_stage"


def quality_classifier(spark, docs, sf_dir):
    """Documents that the quality network doesn't reject."""
    return quality.sifted(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark, docs, sf_dir):
    """One document of each group of equal texts, ties by the smallest ``doc_id``.

    Null and empty texts are equal to one another.
    """
    return exact_dedup.deduplicated(docs)


def near_copies(spark, docs, sf_dir):
    """The first document of each group that five-word shingles link at 0.8 or more.

    First is the smallest ``doc_id``, nulls last, ties by row. Texts without words all stay.
    """
    rows = numbered(docs, ROW)
    found = jaccard_join.jaccard_join(rows.select(F.col(ROW).alias("doc_id"), "text"),
                                      count=False)
    found = written(found.select(F.col("doc_id").alias(ROW), "component_id"), "near-copies")
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", ROW)
    first = found.join(rows.select(ROW, "doc_id"), ROW).groupBy("component_id").agg(
        F.min(order).alias("least")).select(F.col(f"least.{ROW}").alias(ROW))
    return without(rows, ROW, found.join(first, ROW, "left_anti")).select(docs.columns)


def benchmark_texts(spark, docs, sf_dir):
    """Documents that hold no window of a benchmark item.

    Texts without words stay, and an empty benchmark drops nothing.
    """
    rows = numbered(docs, ROW)
    found = decontaminate.decontaminate(rows.select(F.col(ROW).alias("doc_id"), "text"),
                                        table(spark, sf_dir, "benchmark"))
    hit = found.where("contaminated").select(F.col("doc_id").alias(ROW))
    return without(rows, ROW, hit).select(docs.columns)


def token_ids(spark, docs, sf_dir):
    """Ids of every text, packed, with digests of them and of the bytes they decode to.

    A null or empty text has no ids.
    """
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return byte_bpe.encode_decode(docs, path, pattern).select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality classifier", quality_classifier), ("exact dedup", exact_copies),
          ("n-gram Jaccard join", near_copies), ("benchmark decontamination", benchmark_texts),
          ("byte-level BPE", token_ids)]

#: SQL cannot express the network or the merges; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The last stage's rows; each stage is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
