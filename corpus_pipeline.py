"""Corpus pipeline over `documents`: quality rules, toxicity, near copies, packing; each stage is one text operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granero.llm.common import put_aside, release, workspace
from granero.llm.near_copies import near_copy_groups
from granero.llm.packing import pack_texts
from granero.llm.quality_rules import keep_good
from granero.llm.toxicity import drop_toxic

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


NEAR_SHINGLE, NEAR_PERCENT = 5, 80  # near copies of the pipeline; the contract of op8 has its own


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, held against fixed references of the languages; map-only."""
    return keep_good(docs, "text", "lang")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic; the classifier learns from the labelled documents still there. Map-only once it has."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"), "doc_id", "text", "toxic")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the least id, of those without an id the first.

    The documents are stored with a number for each row, so a decision hits the row it was made on, whatever the ids. The
    rows to leave out are a few numbers; Spark broadcasts them while they are small and shuffles both sides beyond that.
    """
    with workspace() as keep:
        numbered = keep(put_aside(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered"))
        groups = put_aside(near_copy_groups(numbered, "_row", "text", shingle=NEAR_SHINGLE, percent=NEAR_PERCENT), "groups")
        several = groups.filter("_row <> component_id").select("component_id").distinct()
        members = put_aside(groups.join(several, "component_id").select("_row", "component_id").join(
            numbered.select("_row", "doc_id"), "_row"), "members")
        first = members.groupBy("component_id").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "_row")).alias("_first")).select(
            "component_id", F.col("_first._row").alias("_kept"))
        rejected = keep(put_aside(members.join(first, "component_id").filter("_row <> _kept").select("_row"), "rejected"))
    return numbered.join(rejected, "_row", "left_anti").drop("_row")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents left, with their sequence and place."""
    return pack_texts(docs, "doc_id", "text")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality), ("toxicity", toxicity), ("near_copies", near_copies), ("packing", packing)]
ORACLE_SQL = None  # the classifier and the search for few sequences are not SQL; tests hold both against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in STAGES:
        with workspace() as keep:
            stored = keep(put_aside(stage(spark, docs, sf_dir), name))
        release(docs)  # recovery needs the last stored stage only
        docs = stored
    return docs
