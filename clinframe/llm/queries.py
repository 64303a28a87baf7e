"""Registered queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from .decontaminate import contaminated_pairs
from .html_text import extract
from .language_id import identify
from .licenses import scan
from .line_dedup import line_dedup
from .merkle import verified_manifest
from .near_dup import near_duplicates
from .oracle import ORACLE
from .packing import pack
from .quality import line_frequency
from .quality_votes import classify
from .substring_dedup import repeated_bytes
from .url_filter import url_verdicts
from .whitening import whiten


def _read(spark, sf_dir: str, table: str):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_string_tiling(spark, sf_dir):
    """(document, benchmark item) pairs where the document holds the item."""
    return contaminated_pairs(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op2_superminhash(spark, sf_dir):
    """Near-duplicate components of all documents (4-word shingles, similarity 0.8)."""
    return near_duplicates(_read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op3_html_blocks(spark, sf_dir):
    """Main text of every page."""
    return extract(_read(spark, sf_dir, "pages"))


def op4_line_frequency(spark, sf_dir):
    """Base statistics and line-frequency verdict of every document."""
    return line_frequency(_read(spark, sf_dir, "documents")).drop("tkey", "host", "frequent")


def op5_nnls_packing(spark, sf_dir):
    """All documents packed into sequences of 1024 tokens."""
    out = pack(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_induced_suffixes(spark, sf_dir):
    """Bytes of every document covered by repeated strings of 400 bytes."""
    out = repeated_bytes(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), "kept_sha256",
                      (F.col("n_bytes") - F.col("n_removed")).alias("n_kept"))


def op7_line_windows(spark, sf_dir):
    """Every document without later copies of three-line windows, as digests."""
    out = line_dedup(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", "line_dedup.*", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


def op8_kneser_ney(spark, sf_dir):
    """Language of every document, learned from four of five."""
    return identify(_read(spark, sf_dir, "documents")).drop("entropy")


def op9_url_trees(spark, sf_dir):
    """Verdict on the URL of every page."""
    return url_verdicts(_read(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


def op10_license_bands(spark, sf_dir):
    """(document, license) pairs over all documents."""
    return scan(_read(spark, sf_dir, "documents"))


def op11_neighbour_votes(spark, sf_dir):
    """Quality of every document, learned from the labels of two of three."""
    return classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op12_merkle_witnesses(spark, sf_dir):
    """Merkle manifest of all documents, each witness checked against its tampered document."""
    return verified_manifest(_read(spark, sf_dir, "documents"))


def op13_lanczos_whitening(spark, sf_dir):
    """Whitened embeddings, one row per vector and component."""
    out = whiten(_read(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.col("deviation").cast("long"))


QUERIES = {
    "op1_string_tiling": op1_string_tiling,
    "op2_superminhash": op2_superminhash,
    "op3_html_blocks": op3_html_blocks,
    "op4_line_frequency": op4_line_frequency,
    "op5_nnls_packing": op5_nnls_packing,
    "op6_induced_suffixes": op6_induced_suffixes,
    "op7_line_windows": op7_line_windows,
    "op8_kneser_ney": op8_kneser_ney,
    "op9_url_trees": op9_url_trees,
    "op10_license_bands": op10_license_bands,
    "op11_neighbour_votes": op11_neighbour_votes,
    "op12_merkle_witnesses": op12_merkle_witnesses,
    "op13_lanczos_whitening": op13_lanczos_whitening,
}

__all__ = ["ORACLE", "QUERIES"]
