"""Registered queries of the training-data operators, and the SQL some of them must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldcatch.llm import (
    best_fit, group_matrix, html_density, language_codes, license_index, merkle_proofs, permuterm, pivot_index,
    pseudonyms, rule_cascade, secret_index, source_mix, twins, va_file,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (session, folder of tables), with its SQL twin if it has one."""
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_language_codes")
def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    marked = docs.withColumn("held_out", language_codes.held_out())
    model = language_codes.fit(marked.filter(~F.col("held_out")))
    return language_codes.predict(marked.select("doc_id", "text", "held_out"), model).select(
        "doc_id", "held_out", "lang_pred", "score", "ambiguous"
    )


@query("op2_source_mix")
def mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return source_mix.mix_counts(docs).select("doc_id", "size", "source_size", "target", "taken", "source")


@query("op3_secret_scan", twins.SECRETS)
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_index.digest(secret_index.find_secrets(docs))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


@query("op4_va_file", twins.TOP_K)
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return va_file.top_k(rows, F.col("vec_id") % 50 == 0)


@query("op5_group_matrix")
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_matrix.jaccard_join(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op6_license_scan", twins.LICENSES)
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_index.find_licenses(docs).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


@query("op7_pseudonyms")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.hide(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op8_main_text")
def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_density.extract(pages)


@query("op9_quality_cascade", twins.QUALITY)
def quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rule_cascade.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.col("base_failed"), "kept",
    )


@query("op10_best_fit")
def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    capacity = best_fit.Capacity()
    return best_fit.pack(best_fit.pieces(docs, capacity.longest), capacity)


@query("op11_pivot_index", twins.NEAR_VECTORS)
def near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_index.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query("op12_permuterm", twins.VARIANTS)
def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permuterm.variants(permuterm.words(table(spark, sf_dir, "documents").select("doc_id", "text")))


@query("op13_merkle_proofs", twins.MANIFEST)
def dataset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*merkle_proofs.FIELDS)
    return merkle_proofs.verify(
        merkle_proofs.manifest(docs, merkle_proofs.tampered(F.col("text"), F.col("doc_id")))
    )
