"""Queries of this subpackage over the driver's tables; each maps a table to an operator and its rows back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granero.llm.byte_bpe import encode_and_decode
from granero.llm.collocations import mine_phrases
from granero.llm.dialogues import rotate_perspectives
from granero.llm.filter_audit import audit_filters
from granero.llm.license_scan import scan_templates
from granero.llm.lm_scoring import score_against_target
from granero.llm.near_copies import near_copy_groups
from granero.llm.oracle import ORACLE  # noqa: F401
from granero.llm.ordered_packing import pack_in_order
from granero.llm.packing import pack_texts
from granero.llm.quality_rules import quality_verdicts
from granero.llm.series_search import nearest_series
from granero.llm.toxicity import score_toxicity
from granero.llm.warc import archive_pages


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _incidents(spark: SparkSession, folder: str) -> DataFrame:
    """`documents` as incidents: the document id is the folio, its text the description."""
    return _table(spark, folder, "documents").select(
        F.col("doc_id").alias("ln_folio_incidencia"), F.col("text").alias("descripcion"), F.col("lang").alias("idioma"))


def op1_warc_archive(spark: SparkSession, folder: str) -> DataFrame:
    chunks = archive_pages(_table(spark, folder, "pages"))
    return chunks.filter("is_last").select(
        F.col("record_id").cast("long").alias("page_id"), "payload_bytes", F.col("digest_so_far").alias("payload_digest"),
        "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_templates(_incidents(spark, folder)).withColumnRenamed("ln_folio_incidencia", "doc_id")


def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return encode_and_decode(_incidents(spark, folder), with_ids=False).drop("ids").withColumnRenamed(
        "ln_folio_incidencia", "doc_id")


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    def held_out(key: str):
        return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(5)) == 0

    reports = _table(spark, folder, "documents").select(F.col("doc_id").alias("hash_respuesta"), F.col("text").alias("observaciones"))
    labels = _table(spark, folder, "labels").filter(~held_out("doc_id")).select(
        F.col("doc_id").alias("hash_respuesta"), F.col("toxic").alias("toxica"))
    return score_toxicity(reports, labels).select(
        F.col("hash_respuesta").alias("doc_id"), held_out("hash_respuesta").alias("held_out"), "score", "predicted",
        "toxic_loglik", "ordinary_loglik", "ratio")


def op5_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    """Components become floor(64 * x); vectors with a null or non-finite one take no part."""
    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    series = _table(spark, folder, "embeddings").filter(F.forall("embedding", finite)).select(
        F.col("vec_id").alias("id_ceda_agricultura"), (F.col("vec_id") % 20 == 0).alias("es_consulta"),
        F.transform("embedding", lambda x: F.floor(64 * x.cast("double")).cast("long")).alias("serie"))
    return nearest_series(series, k=20).select(
        F.col("query").alias("query_id"), "rank", F.col("neighbour").alias("vec_id"), "score")


def op6_chat_perspectives(spark: SparkSession, folder: str) -> DataFrame:
    reports = _table(spark, folder, "conversations").select(
        F.col("conv_id").alias("id_ceda_agricultura"), F.col("turn").alias("fecha_y_hora"),
        F.col("role").alias("quien_reporta"), F.col("text").alias("observaciones"))
    return rotate_perspectives(reports).withColumnsRenamed({
        "id_ceda_agricultura": "conv_id", "fecha_y_hora": "turn", "quien_reporta": "speaker"})


def op7_bestfit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_texts(_incidents(spark, folder)).withColumnRenamed("ln_folio_incidencia", "doc_id")


def op8_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return near_copy_groups(_incidents(spark, folder)).withColumnRenamed("ln_folio_incidencia", "doc_id")


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_verdicts(_incidents(spark, folder)).select(
        F.col("ln_folio_incidencia").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept")


def op10_cross_entropy_difference(spark: SparkSession, folder: str) -> DataFrame:
    """Target: the documents labelled as good; background: all of them. Only ids are joined."""
    good = _table(spark, folder, "labels").filter("quality = 1").select("doc_id")
    return score_against_target(_incidents(spark, folder), targets=good).withColumnRenamed("ln_folio_incidencia", "doc_id")


def op11_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The documents' language is the kind of incident."""
    incidents = _table(spark, folder, "documents").select(
        F.col("text").alias("descripcion"), F.col("lang").alias("tipo_incidente"))
    return mine_phrases(incidents).withColumnRenamed("tipo_incidente", "lang")


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """The documents' source is who is responsible for the incident; labels say which documents are good or toxic."""
    incidents = _table(spark, folder, "documents").select(
        F.col("doc_id").alias("ln_folio_incidencia"), F.col("text").alias("descripcion"), F.col("source").alias("responsable_cdf"))
    labels = _table(spark, folder, "labels").select(
        F.col("doc_id").alias("ln_folio_incidencia"), F.col("quality").alias("validada"), F.col("toxic").alias("toxica"))
    return audit_filters(incidents, labels)


def op13_ordered_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_in_order(_incidents(spark, folder)).withColumnRenamed("ln_folio_incidencia", "doc_id")


QUERIES = {f.__name__: f for f in (
    op1_warc_archive, op2_license_scan, op3_byte_bpe, op4_toxicity, op5_exact_topk, op6_chat_perspectives,
    op7_bestfit_packing, op8_ngram_jaccard, op9_quality_rules, op10_cross_entropy_difference,
    op11_phrase_collocations, op12_filter_audit, op13_ordered_packing)}
