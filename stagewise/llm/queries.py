"""The operators of this subpackage as queries over the test tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.llm import oracles
from stagewise.llm.bpe import decode_ids, encode_texts, joined_digest, public_file
from stagewise.llm.decontamination import find_windows, hit_words, items_digest
from stagewise.llm.embedding_dedup import link_vectors
from stagewise.llm.filter_audit import audit_filters
from stagewise.llm.jaccard_join import link_documents
from stagewise.llm.language_model import score_texts
from stagewise.llm.license_scan import scan_licenses
from stagewise.llm.line_dedup import dedup_lines
from stagewise.llm.quality_classifier import fit_quality, score_quality
from stagewise.llm.quality_classifier import is_held_out as is_held_out_quality
from stagewise.llm.substring_dedup import dedup_substrings
from stagewise.llm.tokenizer_alignment import align_tokenizers
from stagewise.llm.toxicity import fit_toxicity, is_held_out, score_toxicity
from stagewise.llm.warc import read_archives, write_archives

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its score; labels are learned from rows that are not held out."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(documents, table(spark, sf_dir, "labels"))
    return score_toxicity(documents, model).select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


@query("op3_bpe")
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of what they decode to."""
    path = public_file("word_bpe_49k.json")
    encoded = encode_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    decoded = decode_ids(encoded.select("doc_id", "ids"), path)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        joined_digest("ids").alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op4_decontamination", oracles.DECONTAMINATION)
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document stands in windows of benchmark items."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_windows(documents, table(spark, sf_dir, "benchmark"))
    n_hit = hit_words(F.col("spans"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        items_digest(F.col("items")).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@query("op1_line_dedup", oracles.LINE_DEDUP)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines, how many of them go, and a digest of what stays."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(documents).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


@query("op5_license_scan")
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in every document."""
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op6_warc", oracles.WARC)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record into ZIP-packaged archives and read back from them."""
    archives = write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return read_archives(archives, payloads=False).drop("url")


@query("op8_lm_scoring")
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every document under the interpolated model and under the base one."""
    return score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op9_embedding_dedup", oracles.EMBEDDING_DEDUP)
def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors."""
    return link_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))


@query("op10_substring_dedup", oracles.SUBSTRING_DEDUP)
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document go, and a digest of those that stay."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_substrings(documents).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


@query("op7_jaccard_join", oracles.JACCARD_JOIN)
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents."""
    return link_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op11_filter_audit", oracles.FILTER_AUDIT)
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes from each source, in every order."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return audit_filters(documents, table(spark, sf_dir, "labels"))


@query("op12_quality_classifier")
def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its quality score; labels are learned from rows that are not held out."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(documents, table(spark, sf_dir, "labels"))
    return score_quality(documents, model).select(
        "doc_id", is_held_out_quality(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


@query("op13_tokenizer_alignment")
def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two tokenizers lie over each other in every document, and how usual their links are."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return align_tokenizers(documents, public_file("byte_bpe_50k.json"), public_file("piece_bpe_32k.model"))
