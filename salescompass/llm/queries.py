"""The contract queries of the operators over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescompass.llm import (
    decontaminate, fingerprints, line_dedup, near_dedup, rule_quality, sharding, source_mix, spelling, substring_dedup, token_files, toxicity,
    url_filter, whitening,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", decontaminate.n_marked("removed").alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.Mix(_table(spark, sf_dir, "documents")).taken().select("doc_id", "size", "source_size", "target", "taken")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.remove_repeated_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256"))


URL_RULES = (
    url_filter.Rule("net/", url_filter.BLOCK),
    url_filter.Rule("example.net/en/", url_filter.ALLOW),
    url_filter.Rule("example.com/de/", url_filter.BLOCK),
    url_filter.Rule("org/fr/", url_filter.ALLOW),
)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(_table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, _table(spark, sf_dir, "benchmark"))
    n_hit = decontaminate.n_marked()
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, crc = sharding.row_sizes(F.col("text"))
    docs = _table(spark, sf_dir, "documents").select("doc_id", size.alias("size"), crc.alias("text_crc32"))
    return sharding.shard_rows(docs, ["doc_id"], 40).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op8_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = rule_quality.fit_rules(docs, _table(spark, sf_dir, "labels"))
    return rule_quality.scored(docs, model).select(
        "doc_id", rule_quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.NearDuplicates(_table(spark, sf_dir, "documents").select("doc_id", "text")).classes()


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit_severity(docs, _table(spark, sf_dir, "labels"))
    return toxicity.graded(docs, model).select("doc_id", "severity", "grade", "toxic")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.components_of(_table(spark, sf_dir, "embeddings"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    definition = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text()
    return token_files.write_token_files(_table(spark, sf_dir, "documents"), definition).documents()


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(spelling.count_words(_table(spark, sf_dir, "documents"), typo_every=199))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring_dedup, op2_source_mix, op3_line_dedup, op4_url_filter, op5_fingerprints, op6_decontamination,
        op7_sharding, op8_rule_quality, op9_near_dedup, op10_toxicity, op11_embedding_whitening,
        op12_token_files, op13_spelling_variants,
    )
}
