"""Reading landed extracts and stored tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_text_csv(spark: SparkSession, path: str | Sequence[str], encoding: str = "UTF-8", sep: str = ",",
                  mask: str | None = None, multi_line: bool = False) -> DataFrame:
    """Header CSV, every column as text so that leading zeros survive.

    `multi_line` accepts line breaks inside quotes, at the price that a file is no longer split between tasks.
    """
    reader = (spark.read.option("header", True).option("encoding", encoding).option("sep", sep)
              .option("quote", '"').option("escape", '"').option("multiLine", multi_line))
    if mask:
        reader = reader.option("pathGlobFilter", mask)
    return reader.csv(path if isinstance(path, str) else list(path))


def read_many(spark: SparkSession, paths: Sequence[str], **options: str) -> DataFrame:
    """Union of files by column name, missing columns NULL.

    One read over several CSV paths matches by position, so files are grouped by their header line and each distinct
    header is one read: the plan has as many branches as there are layouts, not files. The headers come from one job.
    """
    paths = sorted(paths)
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
                                          F.monotonically_increasing_id().alias("line"), "value")
    heads = lines.filter("start = 0").groupBy("path").agg(F.min_by("value", "line").alias("head"))
    layouts: dict[str, list[str]] = {}
    for row in sorted(heads.collect()):  # one short row per file
        layouts.setdefault(row["head"], []).append(row["path"])
    frames = [read_text_csv(spark, group, **options) for group in layouts.values()] or [read_text_csv(spark, paths, **options)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def tag_source_file(df: DataFrame, column: str = "archivo") -> DataFrame:
    """S3: base name of the file each row came from."""
    return df.withColumn(column, F.col("_metadata.file_name"))


def select_files(df: DataFrame, exclude: Sequence[str]) -> DataFrame:
    """Leave out rows whose file name contains one of the given parts (side outputs of a load)."""
    name = F.lower(F.col("_metadata.file_name"))
    return df.filter(~reduce(lambda a, b: a | b, [name.contains(p.lower()) for p in exclude], F.lit(False)))


def with_file_order(df: DataFrame, column: str = "orden_archivo") -> DataFrame:
    """Position of a row in its source: file path, block start, then row order inside the block.

    One sortable struct, so "keep first" and "keep last" are plain min and max.
    """
    return df.withColumn(column, F.struct(
        F.col("_metadata.file_path").alias("archivo"),
        F.col("_metadata.file_block_start").alias("bloque"),
        F.monotonically_increasing_id().alias("fila"),
    ))


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stored table as a whole."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def table_for_year(df: DataFrame, year: int) -> DataFrame:
    """One year of a table partitioned by `anio`; the scan reads only that partition."""
    return df.filter(F.col("anio") == year)
