"""Registered queries of the operators: each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, encode, language, neighbours, oracles, packing, quality, simhash, spelling, substring, suffix, token_files, toxicity, vector_codes
from .common import fold, settle, table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    packed = packing.pack_documents(
        table(spark, sf_dir, "documents"), encode.tokenizer_path("word_bpe_49k.json"), ids=False
    )
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without windows of 20 words that appeared before."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = substring.remove_repeats(docs)
    return found.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without strings of 400 bytes that occur twice."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffix.remove_repeats(docs)
    return found.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as ids in binary files, read back from them."""
    manifest = token_files.write_token_files(
        table(spark, sf_dir, "documents"), encode.tokenizer_path("byte_bpe_50k.json")
    )
    return token_files.read_token_files(manifest).drop("ids")


def judged(scored: DataFrame, divisor: int, remainder: int, threshold: float) -> DataFrame:
    """Scores with the fold of each document and the verdict."""
    return scored.select(
        "doc_id",
        F.coalesce(fold(divisor) == remainder, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learnt from four folds of five."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return judged(quality.score_quality(docs, labels, fold(5) != 0), 5, 0, 0.3)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learnt from two folds of three."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, fold(3) != 1)
    return judged(toxicity.score_toxicity(docs.select("doc_id", "text"), model).select("row.doc_id", "score"), 3, 1, 0.7)


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that leak test items: a row for each document and item."""
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.find_leaks(docs.select("doc_id", "text"), benchmark)
    leaks = found.select("row.doc_id", F.explode("leaks").alias("leak")).where(F.col("leak.coverage") >= decontaminate.COVERAGE)
    return leaks.select("doc_id", "leak.item_id", "leak.coverage")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learnt from three folds of four."""
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.train(docs, fold(4) != 2))
    held_out = F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score", "ambiguous")


#: A conversation that says the template's own marks, added to those of the table.
MARKS = r"\### Assistant: </turn> ok"


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, written, and read back."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-7, 0, "user", MARKS), (-7, 1, "assistant", MARKS)], given.schema)
    messages = given.unionByName(added).withColumn("content", chat.text_part(F.col("text")))
    return chat.digests(settle(chat.format_chat(messages), "chat"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors as codes of eight entries."""
    codes = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    rows = vector_codes.with_label_errors(codes.rows)
    return rows.select("vec_id", "code", "error", "label_error", F.lit(codes.digest()).alias("codebooks_sha256"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the frequent words of all documents."""
    return spelling.group_variants(table(spark, sf_dir, "documents"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_best_fit_packing,
        op2_substring_dedup,
        op3_simhash_near_dedup,
        op4_suffix_array_dedup,
        op5_nearest_neighbours,
        op6_token_id_output,
        op7_quality_classifier,
        op8_toxicity,
        op9_benchmark_decontamination,
        op10_language_id,
        op11_chat_format,
        op12_vector_codes,
        op13_spelling_variants,
    )
}

#: The others can't be said in SQL: tokenizers, hashes and trained models.
ORACLES: dict[str, str] = {
    "op2_substring_dedup": oracles.substring_dedup(),
    "op4_suffix_array_dedup": oracles.suffix_array_dedup(),
    "op11_chat_format": oracles.chat_format(MARKS),
    "op12_vector_codes": oracles.vector_codes(),
    "op13_spelling_variants": oracles.spelling_variants(),
}
