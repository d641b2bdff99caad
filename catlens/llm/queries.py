"""The registered query of each operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import contamination
from .fingerprint import fingerprints
from .html_extract import extract_pages
from .importance import resample
from .lattice_lm import score_texts
from .mixing import mix
from .ngram_join import ngram_components
from .periodic_runs import periodic_runs
from .prefix_trie import prefix_trie
from .shared import ship, table
from .substring_dedup import remove_repeats
from .token_files import read_tokens, write_tokens
from .toxicity import toxicity
from .warc import archive_and_read


def op1_minhash_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text."""
    ship(spark)
    return fingerprints(table(spark, sf_dir, "documents"))


def op2_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, log_weight, sample_key, selected of every document."""
    ship(spark)
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", "log_weight", "sample_key", "selected")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id of every document (4-word shingles, similarity 0.85)."""
    ship(spark)
    return ngram_components(table(spark, sf_dir, "documents"), size=4, percent=85).select("doc_id", "n_shingles", "component_id")


def op4_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, contaminated, items and the best cosine and LCS share of every document."""
    ship(spark)
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", F.array_sort("leaks.item_id").alias("items"), F.array_max("leaks.cosine").alias("cosine"), F.array_max("leaks.lcs").alias("lcs"))


def op5_hierarchical_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, domain, lang, source, n_tokens, budget of the leaf and copies taken of every document."""
    ship(spark)
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", F.col("mix_domain").alias("domain"), "lang", "source", F.col("mix_tokens").alias("n_tokens"), F.col("mix_budget").alias("budget"), F.col("mix_copies").alias("copies"))


def op6_tag_path_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    ship(spark)
    return extract_pages(table(spark, sf_dir, "pages"))


def op7_fm_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    ship(spark)
    kept = remove_repeats(table(spark, sf_dir, "documents"), window=50)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


def op8_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    ship(spark)
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_bit_plane_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read from the written files."""
    ship(spark)
    return read_tokens(spark, write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def op10_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, read back through the index."""
    ship(spark)
    return archive_and_read(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_runs, the strongest run and the digests of all runs and of the text without repeats, of every document."""
    ship(spark)
    return periodic_runs(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per node of the prefix trie of all rebuilt conversations."""
    ship(spark)
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    ship(spark)
    return score_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of corpus_pipeline.run."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash_fingerprint,
        op2_importance_resampling,
        op3_ngram_join,
        op4_latent_decontamination,
        op5_hierarchical_mixing,
        op6_tag_path_extraction,
        op7_fm_index_dedup,
        op8_toxicity_cnn,
        op9_bit_plane_tokens,
        op10_warc_index,
        op11_periodic_runs,
        op12_prefix_trie,
        op13_lattice_lm,
        pipeline,
    )
}
