"""The registered queries of the text operators: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, decontaminate, interpolation, langid, media, mixing, quality, ranked_search, records, secret_ledger, simhash, substrings, toxicity
from .common import table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def op2_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.token_records(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))


def op5_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = interpolation.score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", (F.col("fold") == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        F.size("near_ids").cast("long").alias("n_near"),
        F.sha2(F.array_join("near_ids", ","), 256).alias("near_sha256"),
    )


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents").select("doc_id", "text"), width=4, radius=4, seed=42)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_gif(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_features(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_ledger.scan_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [r.kind for r in secret_ledger.BASE_RULES]
    count = lambda kind: F.size(F.filter("findings", lambda m: m["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in base),
        F.sha2(secret_ledger.spans_text(F.filter("findings", lambda m: m["kind"].isin(base))), 256).alias("base_sha256"),
        secret_ledger.spans_text(F.col("findings")).alias("spans"),
    )


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "quality"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mixing,
        op2_token_records,
        op3_substring_dedup,
        op4_toxicity,
        op5_interpolation,
        op6_decontamination,
        op7_language,
        op8_simhash,
        op9_gif,
        op10_secrets,
        op11_search,
        op12_collocations,
        op13_quality,
    )
}
