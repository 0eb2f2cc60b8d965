"""L1, L2 over a stored order: a table is sorted once per version, then any page reads the one or two parts that hold it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granero.operators.filters import clamp_page, order_sql_style
from granero.operators.positions import ROW_BITS
from granero.sources.sinks import drop_stored

PART, PLACE = "_parte", "_lugar"


def store_sorted(df: DataFrame, path: str, *order: str) -> None:
    """Write the table in the given order (`-name` descends), split by ranges of it; beside it, how many rows each part has.

    `order` should end in a unique column, so that a leading value with very many rows spreads over several parts.
    """
    spark, by = df.sparkSession, order_sql_style(*order)
    drop_stored(spark, path)
    number = F.monotonically_increasing_id()
    rows = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(PLACE, number)
    rows.withColumns({PART: F.shiftright(PLACE, ROW_BITS).cast("int"), PLACE: F.col(PLACE).bitwiseAND((1 << ROW_BITS) - 1)}).write.partitionBy(
        PART).parquet(f"{path}/filas")
    df.limit(0).withColumns({PLACE: F.lit(0).cast("bigint"), PART: F.lit(0)}).write.parquet(f"{path}/forma")  # the layout, for a table without rows
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    sizes = _rows(spark, path).groupBy(PART).agg(F.count("*").alias("filas"))
    sizes.select(PART, "filas", F.coalesce(F.sum("filas").over(before), F.lit(0)).alias("antes")).coalesce(1).write.parquet(f"{path}/partes")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(spark.read.parquet(f"{path}/forma").schema).parquet(f"{path}/filas")


def places_of_page(parts: list[tuple[int, int, int]], number: int, size: int) -> list[tuple[int, int, int]]:
    """(part, first place, place after the last) of a page, given (part, rows, rows before it) of every part."""
    start = (clamp_page(number, size, sum(rows for _, rows, _ in parts)) - 1) * size
    spans = [(part, max(start - before, 0), min(start + size - before, rows)) for part, rows, before in parts]
    return [(part, low, high) for part, low, high in spans if low < high]


def sorted_page(spark: SparkSession, path: str, number: int, size: int) -> DataFrame:
    """L2: one page of the stored order, in order; page numbers outside the range go to the nearest page.

    The counts, one row per part, say which parts hold the page; no other part is read and nothing of the table is sorted.
    """
    inside = F.lit(False)
    for part, low, high in places_of_page([tuple(r) for r in spark.read.parquet(f"{path}/partes").select(PART, "filas", "antes").collect()], number, size):
        inside = inside | ((F.col(PART) == part) & (F.col(PLACE) >= low) & (F.col(PLACE) < high))
    return _rows(spark, path).filter(inside).orderBy(PART, PLACE).drop(PART, PLACE)
