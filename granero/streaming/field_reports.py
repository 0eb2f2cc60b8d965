"""Incremental ingest of field reports: only reports not stored yet are added, so reruns change nothing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from granero.functions.text import normalize_report_text, row_hash
from granero.sources.sinks import balanced, overwrite_table

DAY, HASH = "fecha_registro", "hash_respuesta"


def clean_reports(raw: DataFrame, time: str = "fecha_y_hora", key: str = "id_ceda_agricultura") -> DataFrame:
    """Rows with a time, text normalised, with their day and hash; equal rows of a batch once."""
    clean = normalize_report_text(raw.filter(F.col(time).isNotNull()), key)
    marked = clean.withColumns({HASH: row_hash(clean.columns), DAY: F.to_date(time)})
    return marked.dropDuplicates([DAY, HASH])


def table_schema(raw: DataFrame) -> T.StructType:
    """Layout of the stored table: the report, its hash, and the day that partitions the table."""
    return T.StructType(list(raw.schema.fields) + [T.StructField(HASH, T.StringType()), T.StructField(DAY, T.DateType())])


def unseen_reports(clean: DataFrame, stored: DataFrame, days: Sequence[dt.date]) -> DataFrame:
    """K9: reports whose hash is not stored. Equal hashes share their day, so only the batch's own days are compared:
    one report with an old date opens that day's partition and none between."""
    near = stored.filter(F.col(DAY).isin(list(days))).select(DAY, HASH)
    return clean.join(near, [DAY, HASH], "left_anti").select(clean.columns)


def append_reports(raw: DataFrame, table: str) -> None:
    """K9: batch form of the ingest; `table` is a Parquet folder partitioned by day."""
    schema = table_schema(raw)
    spark = raw.sparkSession
    spark.createDataFrame([], schema).write.mode("ignore").parquet(table)
    clean = clean_reports(raw).persist()  # read for its days and for its rows; a lost part is worked out again
    try:
        days = [r[0] for r in clean.select(DAY).distinct().collect()]  # as many as the calendar has at most
        if days:
            stored = spark.read.schema(schema).parquet(table)
            balanced(unseen_reports(clean, stored, days), DAY).write.mode("append").partitionBy(DAY).parquet(table)
    finally:
        clean.unpersist()


def start_ingest(reports: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Every micro-batch of a streaming frame goes through `append_reports`, until the source is used up.

    State is the checkpoint and the table itself: a batch that is run again finds its rows stored already.
    """
    return (reports.writeStream.foreachBatch(lambda batch, _: append_reports(batch, table))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def replace_reports(raw: DataFrame, table: str) -> None:
    """R2: the variant that reloads everything."""
    overwrite_table(clean_reports(raw), table, [DAY])


def read_reports(raw: DataFrame, table: str) -> DataFrame:
    """The stored reports."""
    return raw.sparkSession.read.schema(table_schema(raw)).parquet(table)
