"""The operators bound to the driver's tables, by their contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabready.llm import (bpe, centroid_search, decontaminate, html_text, jaccard_join, language_id, license_scan, quality_rules,
                          repeat_removal, simhash, token_alignment, url_filter, warc)
from tabready.llm.common import on_executors, read_table

#: Path rules of the url query.
URL_RULES = [url_filter.Rule("org", "/", "allow"), url_filter.Rule("example.org", "/es/", "block"),
             url_filter.Rule("example.org", "/en/1", "block"), url_filter.Rule("com", "/fr/", "allow"),
             url_filter.Rule("com", "/de/", "block")]


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@on_executors
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.quality_filter(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                      "rule")


@on_executors
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(read_table(spark, sf_dir, "pages"))


@on_executors
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.train(url_filter.seed_labels(spark))
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"), URL_RULES, model)


@on_executors
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read_table(spark, sf_dir, "pages"))


@on_executors
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_texts(read_table(spark, sf_dir, "documents"), vocabulary())


@on_executors
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


@on_executors
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_removal.remove_repeats(read_table(spark, sf_dir, "documents")).drop("spans")


@on_executors
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return language_id.predict_language(docs, language_id.train(docs))


@on_executors
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read_table(spark, sf_dir, "documents")).drop("spans")


@on_executors
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_benchmark_passages(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@on_executors
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_alignment.align_tokenizers(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                            public_tokenizers.path("piece_bpe_32k.model"))


@on_executors
def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


@on_executors
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_search.cluster_vectors(read_table(spark, sf_dir, "embeddings"))


QUERIES = {"op1_quality_rules": op1_quality_rules, "op2_html_extraction": op2_html_extraction,
           "op3_url_filter": op3_url_filter, "op4_warc": op4_warc, "op5_bpe": op5_bpe, "op6_jaccard_join": op6_jaccard_join,
           "op7_suffix_dedup": op7_suffix_dedup,
           "op8_language_id": op8_language_id, "op9_license_scan": op9_license_scan, "op10_decontamination": op10_decontamination,
           "op11_token_alignment": op11_token_alignment, "op12_simhash": op12_simhash, "op13_centroids": op13_centroids}

#: DuckDB SQL where it can express the whole result.
ORACLES: dict[str, str] = {
    "op4_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
             d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
             k AS (SELECT payload_digest, max(page_id) AS keeper FROM d WHERE payload_bytes >= 1000 GROUP BY 1)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN keeper <> page_id THEN keeper END AS refers_to
        FROM d LEFT JOIN k USING (payload_digest)""",
    "op13_centroids": centroid_search.oracle(),
}
