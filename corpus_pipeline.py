"""The corpus pipeline: documents in, packed training sequences out.

Each stage gets all that the one before it kept, written as Parquet and read again, and
returns documents with all their columns; the last returns the pieces of the sequences.
Clean documents pass through all stages unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlake.llm import decontaminate, encode, near, packing, suffix, toxicity
from chainlake.llm.common import settle, table

#: Documents that score this or more are toxic.
TOXIC = 0.7

#: Words of the least passage that is removed where it repeats: passages of over 50 words.
PASSAGE = 51


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject; labels of all ``documents`` train it.

    Null and empty texts stay. Without labels nothing is rejected.
    """
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity.score_toxicity(docs, model).where(F.col("score") < TOXIC).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest ``doc_id``.

    Near duplicates share 0.8 of their five-word shingles or more, directly or through
    others. Of rows that share this ``doc_id`` one stays; rows without a ``doc_id`` stay where
    all of their group are without.
    """
    return near.keep_one_of_each(docs)


def drop_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings and the passages of over 50 words that occur twice.

    Characters cut in two at an end of a string are dropped. ``n_chars`` follows the
    text. A document of which nothing stays has an empty text.
    """
    found = suffix.remove_repeats(docs, words=PASSAGE)
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("text")).otherwise(F.col("row.text"))
    row = F.col("row").withField("text", text)
    if "n_chars" in docs.columns:
        size = F.length(text).cast(docs.schema["n_chars"].dataType)
        row = row.withField("n_chars", F.when(changed, size).otherwise(F.col("row.n_chars")))
    return found.select(row.alias("row")).select("row.*")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no item of the benchmark."""
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.where(~decontaminate.contaminated()).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    return packing.pack_documents(docs, encode.tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", drop_repeated_strings),
    ("benchmark_decontamination", drop_leaks),
    ("best_fit_packing", pack),
]

#: SQL has no tokenizer and no trained model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
