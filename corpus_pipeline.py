"""The corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next stage's
documents. All but the last return the columns of documents.
"""

from cartwright.llm import exact_dedup, importance, language, near_dedup, packing
from cartwright.llm.encoding import default_path
from cartwright.sources.scratch import materialize


def known_language(spark, docs, sf_dir):
    """Documents without a letter, or of which no language holds two fifths, go."""
    return language.keep_identified(docs)


def good_quality(spark, docs, sf_dir):
    """Documents that importance resampling towards the labelled good ones draws; what it rejects goes."""
    return importance.keep_sampled(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark, docs, sf_dir):
    """One document of each group of equal texts (after lower-casing A-Z) stays: the one with the largest doc_id."""
    return exact_dedup.remove_copies(docs)


def drop_near_copies(spark, docs, sf_dir):
    """One document of each group that shares four fifths of its five-word shingles stays: the one with the least doc_id."""
    return near_dedup.remove_near_copies(docs, words=5, percent=80)


def pack(spark, docs, sf_dir):
    """Token sequences of at most 2048, one row per piece of a document."""
    return packing.pack_documents(docs, default_path("byte_bpe_50k.json"))


STAGES = [
    ("language ID", known_language),
    ("quality classifier", good_quality),
    ("exact dedup", drop_exact_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("packing", pack),
]

#: Language models, samplers and tokenizers are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialize(docs, "stage")
    return docs
