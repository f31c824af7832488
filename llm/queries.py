"""The queries of this subpackage and their SQL counterparts."""

import public_tokenizers

from llm import (
    byte_bpe, chat_format, decontaminate, exact_dedup, hard_negatives, jaccard_join, license_scan,
    piece_bpe, quality, ranked_search, secret_scan, url_filter, warc)
from llm.frames import table

QUERIES, ORACLES = {}, {}


def query(sql=None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function
    return register


@query(exact_dedup.SQL)
def op9_exact_dedup(spark, folder):
    return exact_dedup.exact_dedup(table(spark, folder, "documents"))


@query()
def op10_url_filter(spark, folder):
    return url_filter.filter_urls(table(spark, folder, "pages"))


@query(chat_format.SQL)
def op7_chat_format(spark, folder):
    rows = chat_format.with_added(table(spark, folder, "conversations"))
    return chat_format.digests(chat_format.format_conversations(rows))


@query()
def op3_secret_scan(spark, folder):
    return secret_scan.scan_secrets(table(spark, folder, "documents"))


@query()
def op6_license_scan(spark, folder):
    return license_scan.scan_licenses(table(spark, folder, "documents"))


@query()
def op5_byte_bpe(spark, folder):
    docs = table(spark, folder, "documents")
    return byte_bpe.round_trip(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query(warc.SQL)
def op4_warc(spark, folder):
    return warc.through_archives(table(spark, folder, "pages"))


@query()
def op8_quality(spark, folder):
    return quality.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query(decontaminate.SQL)
def op1_decontaminate(spark, folder):
    return decontaminate.decontaminate(table(spark, folder, "documents"),
                                       table(spark, folder, "benchmark"))


@query(jaccard_join.SQL)
def op2_jaccard_join(spark, folder):
    return jaccard_join.jaccard_join(table(spark, folder, "documents"), 3, 90, 100)


@query(ranked_search.SQL)
def op12_ranked_search(spark, folder):
    return ranked_search.search(table(spark, folder, "documents"),
                                table(spark, folder, "benchmark"))


@query()
def op13_piece_bpe(spark, folder):
    return piece_bpe.round_trip(table(spark, folder, "documents"),
                                public_tokenizers.path("piece_bpe_32k.model"))


@query(hard_negatives.SQL)
def op11_hard_negatives(spark, folder):
    return hard_negatives.mine(table(spark, folder, "embeddings"))
