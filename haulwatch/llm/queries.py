"""Registered queries of the operators: each applies one with its production parameters to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulwatch.llm import decontamination, html_text, licenses, near_duplicates, pieces, quality_model, quality_rules, secret_scans, shingle_join, storage, token_counts, vector_codes, warc, whitening
from haulwatch.llm.oracles import ORACLES  # noqa: F401

#: Vocabulary files; a deployment names its own.
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = token_counts.count_tokens(table(spark, sf_dir, "documents"), BYTE_BPE)
    return docs.select("doc_id", "tokens.n_bytes", "tokens.n_tokens", "tokens.over_limit")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "found.n_words", "found.n_hit", "found.n_items", digest, "found.contaminated")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_text.extract_text(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = secret_scans.scan_secrets(table(spark, sf_dir, "documents")).select("doc_id", "secrets")
    base, spans = F.col("secrets.base"), F.col("secrets.spans")
    count = lambda k: F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long")
    return docs.select(
        "doc_id",
        *(count(k).alias(f"n_{kind}") for k, kind in enumerate(secret_scans.PATTERNS)),
        F.sha2(secret_scans.listed(base), 256).alias("base_sha256"),
        secret_scans.listed(spans).alias("spans"),
        F.size(F.filter(spans, lambda s: s["live"])).cast("long").alias("n_live"),
    )


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    scored = quality_model.classify(docs.select("doc_id", "text"), labels.where(~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= quality_model.THRESHOLD).cast("int").alias("predicted"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_duplicates.mark_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_shingles", "component_id", "kept")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of each text, a digest of them, and whether decoding gives the text back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = pieces.decode_documents(pieces.encode_documents(docs, PIECES), PIECES, into="decoded")
    return docs.select(
        "doc_id",
        F.size("pieces").cast("long").alias("n_pieces"),
        F.sha2(F.array_join(F.col("pieces").cast("array<string>"), ","), 256).alias("pieces_sha256"),
        (F.col("decoded") == F.regexp_replace(F.coalesce("text", F.lit("")), pieces.MARK, " ")).alias("same_text"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = quality_rules.judge_quality(table(spark, sf_dir, "documents"), PIECES)
    return docs.select("doc_id", "rules.*")


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = licenses.scan_licenses(table(spark, sf_dir, "documents")).select("doc_id", "licenses")
    span = lambda s: F.concat_ws(":", s["license"], s["start"].cast("string"), s["end"].cast("string"), F.round(s["coverage"], 4).cast("string"))
    return docs.select(
        "doc_id",
        F.size("licenses").cast("long").alias("n_spans"),
        F.array_join(F.array_sort(F.array_distinct("licenses.license")), ",").alias("licenses"),
        F.array_join(F.transform("licenses", span), ",").alias("spans"),
    )


#: The second replica of the audit query: in these pages, by the first two hex digits of a digest of the key, a byte is lost.
DAMAGED = ("00", "7f")


def op10_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record of the pages' archives, where it stands, and what the audit of a damaged replica says about it."""
    pages = table(spark, sf_dir, "pages")
    records = warc.to_records(pages)
    damaged = F.substring(F.sha2(F.col("key").cast("string"), 256), 1, 2).isin(*DAMAGED)
    read = F.when(damaged, F.sha2(F.expr("substring(record, 1, size - 5)"), 256)).otherwise(F.col("leaf"))
    indexed = storage.checkpointed(warc.index(records.withColumn("replica_leaf", read)))  # hashes and offsets only
    levels = warc.height(indexed)
    mine, other = (warc.merkle_levels(warc.leaves(indexed, leaf), levels) for leaf in ("leaf", "replica_leaf"))
    found = warc.audit(mine, other).select("archive", "position", "status")
    rows = indexed.join(found, ["archive", "position"], "left")
    return rows.select(F.col("key").alias("page_id"), "archive", "position", "start", "end", F.col("leaf").alias("record_sha256"), F.coalesce("status", F.lit("intact")).alias("status"))


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shingle_join.join_similar(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_shingles", "component_id")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return vector_codes.compress(vectors).select("vec_id", "codes.*")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.whiten(vectors).select("vec_id", F.inline("whitened"))


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_decontamination, op3_html_extraction, op4_secret_scans, op5_quality_classifier, op6_near_duplicates, op7_sentencepiece, op8_quality_rules, op9_license_scans, op10_warc_fixity, op11_ngram_join, op12_vector_codes, op13_embedding_whitening)}
