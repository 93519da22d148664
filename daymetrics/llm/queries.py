"""The operators as named queries over a test-data folder, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymetrics.llm import filter_audit, histogram_sort, html_mincut, language, license_scan, maxscore, mixing, ngram_join, packing, quality, simhash, source_divergence, url_filter
from daymetrics.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


URL_RULES = (
    url_filter.Rule("block", "net/"),
    url_filter.Rule("allow", "example.net/en/"),
    url_filter.Rule("block", "example.com/de/"),
    url_filter.Rule("allow", "org/fr/"),
)


@query
def op7_url_vocabulary(spark, sf_dir):
    """Every page's URL judged by the rules, else by the vocabulary."""
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


ORACLES["op7_url_vocabulary"] = url_filter.sql(URL_RULES, url_filter.STRICT_TERMS, url_filter.SOFT_TERMS, 2)


@query
def op8_license_dice(spark, sf_dir):
    """Every document's best licence template."""
    return license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


ORACLES["op8_license_dice"] = license_scan.sql()


@query
def op6_histogram_sort(spark, sf_dir):
    """Every document's place in 24 shards of near equal bytes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64("text").alias("group"),
    )
    placed = histogram_sort.shard(rows, F.col("group"), F.col("doc_id"), F.col("size"), 24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op10_simhash_covering(spark, sf_dir):
    """Every document's fingerprint and component of near duplicates."""
    return simhash.cluster(table(spark, sf_dir, "documents"))


TOKENIZER = "word_bpe_49k.json"


@query
def op9_pack_windows(spark, sf_dir):
    """Every piece of every document in sequences of 2048 tokens."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), 2048, 1)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op3_byte_gru(spark, sf_dir):
    """Every document's language, by a network learned from two thirds of the labelled ones."""
    found = language.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return found.select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )


@query
def op2_certified_rules(spark, sf_dir):
    """Every document's word statistics and the verdict of the certified rules, by language."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.judge(documents, table(spark, sf_dir, "labels"), "lang", columns=["doc_id", "lang"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


ORACLES["op2_certified_rules"] = quality.sql()


@query
def op4_raked_mix(spark, sf_dir):
    """Every document's weight, expected and drawn copies after raking to source, language and topic."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return mixing.mix(documents, max_copies=None, columns=["doc_id", "source", "lang"])


@query
def op5_maxscore(spark, sf_dir):
    """The five best rows for every fiftieth vector, by inner product of its integer components."""
    return maxscore.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


ORACLES["op5_maxscore"] = maxscore.sql()


@query
def op1_html_mincut(spark, sf_dir):
    """Every page's main text."""
    return html_mincut.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op11_token_prefixes(spark, sf_dir):
    """Every document's set of four-word shingles: its size and the component of its links."""
    return ngram_join.cluster(table(spark, sf_dir, "documents"))


@query
def op12_filter_folds(spark, sf_dir):
    """What each of five filters removes at each step of all their orders, for each source."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op12_filter_folds"] = filter_audit.sql()


@query
def op13_source_tree(spark, sf_dir):
    """How far each source's terms lie from the other sources of its language and from the language."""
    return source_divergence.audit(table(spark, sf_dir, "documents"))


ORACLES["op13_source_tree"] = source_divergence.sql()
