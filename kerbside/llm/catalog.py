"""Queries of this subpackage over the tables below a directory, and their DuckDB statements."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import byte_bpe, chat, decontamination, exact_dedup, fuzzy_lines, katz, language_id, licenses, merkle, packing, pii, simhash_golay, whitening

TOKENIZER = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)

RANKS = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans by patterns, further ones by the random field trained on their contexts."""
    documents = _table(spark, sf_dir, "documents")
    return pii.base_digest(pii.find_pii(documents, pii.fit(documents)))


def op2_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bigram Katz score of every document, learned outside the held-out fold."""
    fold = katz.held_out(F.col("doc_id"))
    found = katz.score_documents(_table(spark, sf_dir, "documents"), ~fold)
    return found.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations that begin no longer one, rendered."""
    return chat.rendered(_table(spark, sf_dir, "conversations"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned outside the held-out fold."""
    documents = _table(spark, sf_dir, "documents")
    fold = language_id.held_out(F.col("doc_id"))
    found = language_id.predict(documents, language_id.fit(documents.filter(~fold)))
    return found.select("doc_id", fold.alias("held_out"), "lang_pred", "score")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of equal texts the largest doc_id stays."""
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"), keep="largest")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens."""
    return packing.packed_pieces(_table(spark, sf_dir, "documents"), *TOKENIZER)


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document, taken as a file of its source's tree."""
    documents = _table(spark, sf_dir, "documents")
    files = documents.select(F.col("doc_id").alias("file"), licenses.document_path(F.col("doc_id"), F.col("source")).alias("path"), "text")
    return licenses.scan(files).withColumnRenamed("file", "doc_id")


def op8_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with the occurrence of its group that stays."""
    return fuzzy_lines.similar_lines(_table(spark, sf_dir, "documents"))


def op9_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of three-word shingle fingerprints within three bits."""
    return simhash_golay.near_duplicates(_table(spark, sf_dir, "documents"), 3, 3)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the benchmark items they hold."""
    return decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates of every vector along the four leading components, at unit variance."""
    return whitening.whitened(_table(spark, sf_dir, "embeddings"), components=4)


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of every document in its language's tree, folded from a leaf that may be tampered with."""
    documents = _table(spark, sf_dir, "documents")
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    changed = merkle.leaf_digest(*(F.col(c) + 1 if c == "n_chars" else F.col(c) for c in columns))
    leaves = documents.select(merkle.tree_key(F.col("lang")).alias("tree"), "doc_id", merkle.leaf_digest(*map(F.col, columns)).alias("digest"),
                              F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, changed).alias("claimed"))
    found = merkle.manifest(leaves, ["doc_id"])[0].withColumn("claimed", F.coalesce("claimed", "digest"))
    found = found.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", merkle.siblings_digest().alias("proof_sha256"), merkle.folded("claimed").alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text by the ranks, decoded again."""
    found = byte_bpe.round_trip(_table(spark, sf_dir, "documents"), *RANKS)
    return found.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (op1_pii, op2_katz, op3_chat, op4_language_id, op5_exact_dedup, op6_packing, op7_licenses, op8_fuzzy_lines, op9_simhash_golay, op10_decontamination, op11_whitening, op12_merkle, op13_byte_bpe)}

ORACLE: dict[str, str] = {
    "op3_chat": chat.ORACLE,
    "op5_exact_dedup": """
        WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256)""",
    "op12_merkle": merkle.ORACLE,
}
