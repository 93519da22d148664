"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all documents that the one before kept, and
returns a DataFrame that is written as Parquet and read again for the next. All but the last
return the columns of the documents they were given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymetrics.llm import language, mixing, packing, quality, simhash
from daymetrics.llm.common import stored, table, without

#: Mean probability of the likeliest language below which a text counts as none of them.
LEAST_SCORE = 0.4
TOKENIZER = "word_bpe_49k.json"
WINDOW, END_ID = 2048, 1
#: Words of a shingle, and the bits in which linked fingerprints may differ.
SHINGLE, RADIUS = 3, 3
#: Tokens to keep, as a share of those that reach the mixing stage; fewer where the targets cannot be
#: had otherwise, as a document is kept once at most.
RATE = 0.5


#: Columns that stages look at; the rest travels in one struct, out of the way of any name they add.
USED = ("doc_id", "text", "lang", "source")


def _packed(docs: DataFrame) -> DataFrame:
    rest = [c for c in docs.columns if c not in USED]
    return docs.select(*USED, (F.struct(*rest) if rest else F.lit(None)).alias("_rest"))


def _unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*(F.col(c) if c in USED else F.col("_rest")[c].alias(c) for c in columns))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and texts that no learned language fits."""
    found = language.identify(_packed(docs))
    fits = (F.col("lang_pred") != language.UNKNOWN) & (F.col("lang_score") >= LEAST_SCORE)
    return _unpacked(found.where(fits), docs.columns)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what fails the base rules or a rule that the labels certify for its language."""
    judged = quality.judge(_packed(docs), table(spark, sf_dir, "labels"), "lang")
    return _unpacked(judged.where("kept"), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of linked fingerprints: the smallest id.

    Rows are known by their doc_id. Where rows share one or have none, all are stored with a number
    of their own instead, so each of them counts as a document.
    """
    row = "_row" + "_" * max((len(c) for c in docs.columns), default=0)
    if docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").isEmpty():
        rows = docs.withColumn(row, F.col("doc_id").cast("long"))
    else:
        rows = stored(docs.withColumn(row, F.monotonically_increasing_id()))
    found = simhash.cluster(rows, row, radius=RADIUS, width=SHINGLE)
    copies = stored(found.where(F.col(row) != F.col("component_id")).select(row))
    return without(rows, copies, row).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents drawn by probabilities raked to source, language and topic."""
    return _unpacked(mixing.mix(_packed(docs), rate=RATE).where("copies > 0"), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of WINDOW tokens, with their ids."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), WINDOW, END_ID)


STAGES = [
    ("language_id", identify_language),
    ("quality_rules", apply_quality_rules),
    ("simhash_dedup", drop_near_duplicates),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]

#: Training a network, certifying cutoffs and linking by bits are not for SQL: see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
