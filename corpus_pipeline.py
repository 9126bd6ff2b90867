"""A training corpus from the documents table.

Toxic documents go, repeated lines go, one document of each group of near copies stays, documents with benchmark items go,
and what is left is encoded. Every stage reads what the one before it has stored and keeps the columns of
``documents``; the last gives the token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabreg.llm import byte_bpe, decontaminate, lines, simhash, toxicity
from tabreg.llm.common import read_table, stage, tokenizer_path

RANKS = "byte_bpe_multi_50k.tiktoken"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity field, learned from the labels of these documents, does not reject."""
    return toxicity.keep_clean(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later copies of line runs with any word; n_chars follows the text."""
    return lines.drop_repeats(docs, min_words=1, length_col="n_chars")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: fingerprints of four-word shingles, linked at four bits or fewer."""
    return simhash.keep_one_of_each(docs, shingle=4, threshold=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, a fifth of its words edited or not."""
    return decontaminate.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and whether the ids decode to the text's bytes."""
    ranks = tokenizer_path(RANKS)
    return byte_bpe.encode_checked(docs, ranks).select(
        F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip"
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level BPE", encode),
]

#: A fitted field and bit-parallel distances have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is stored and read again by the next stage."""
    docs = read_table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
