"""Global row positions, and splits of a table into parts, without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granero.session import shared_folder

ROW_BITS = 33  # monotonically_increasing_id keeps the partition number above the low 33 bits


def _laid_out(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Rows range-partitioned and sorted, with their partition and place in it.

    The layout is checkpointed, so a lost executor cannot change it between the passes that use it.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint()
    return sorted_rows.withColumn("_pos", F.monotonically_increasing_id()).withColumn(
        "_part", F.shiftright("_pos", ROW_BITS))


def _offsets(rows: DataFrame, weight: Column) -> DataFrame:
    """One row per partition: the weight before it, and the whole weight."""
    sizes = rows.groupBy("_part").agg(F.sum(weight).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
                        F.sum("_n").over(Window.partitionBy()).alias("total"))


def number_rows(df: DataFrame, order: Sequence[str | Column], column: str = "id") -> DataFrame:
    """1..n in `order`, plus `total`.

    A row's number is its place inside its partition plus the rows of the partitions before it. `order` should end in
    a unique column: then even a leading value held by a third of the rows spreads over several partitions.
    """
    rows = _laid_out(df, order)
    in_part = F.col("_pos").bitwiseAND((1 << ROW_BITS) - 1)
    return (rows.join(F.broadcast(_offsets(rows, F.lit(1))), "_part")  # one row per partition
            .select(*df.columns, (F.col("_offset") + in_part + 1).alias(column), "total"))


def exact_quantile(df: DataFrame, value: str, q: float) -> DataFrame:
    """A11 over a whole table: exact quantile with linear interpolation, as one row `cuantil`.

    Equal values are counted first, so copies cost nothing; the distinct values are sorted across partitions, and only
    the two values around the quantile come out. The built-in exact percentile holds all values in one task.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("v")).agg(
        F.count("*").alias("_w"))
    rows = _laid_out(counted, ["v"])
    upto = Window.partitionBy("_part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = rows.withColumn("_upto", F.sum("_w").over(upto)).join(F.broadcast(_offsets(rows, F.col("_w"))), "_part")
    last = F.col("_offset") + F.col("_upto")  # rows up to and with this value
    place = (F.col("total") - 1) * F.lit(q)
    low, high = F.floor(place), F.ceil(place)

    def at(index: Column) -> Column:
        return F.max(F.when((index < last) & (index >= last - F.col("_w")), F.col("v")))

    found = ranked.agg(at(low).alias("lo"), at(high).alias("hi"), F.max(place - low).alias("f"))
    return found.select((F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("f")).alias("cuantil"))


def _even_part(n: Column, total: Column, parts: int) -> Column:
    small = F.floor(total / parts)
    extra = F.pmod(total, F.lit(parts))
    head = extra * (small + 1)  # rows in the parts that carry one extra row
    in_head = F.floor((n - 1) / (small + 1))
    in_tail = extra + F.floor(F.try_divide(n - 1 - head, small))
    return F.when(n <= head, in_head).otherwise(in_tail).cast("int") + 1


def split_even(df: DataFrame, order: Sequence[str], parts: int, column: str = "parte") -> DataFrame:
    """K3, K5: contiguous parts, the remainder spread over the first ones."""
    numbered = number_rows(df, order, "_n")
    return numbered.select(*df.columns, _even_part(F.col("_n"), F.col("total"), parts).alias(column))


def split_halves(df: DataFrame, order: Sequence[str], column: str = "parte") -> DataFrame:
    """K4: the first half has `n // 2` rows, an odd row goes to the second."""
    numbered = number_rows(df, order, "_n")
    half = F.floor(F.col("total") / 2)
    return numbered.select(*df.columns, F.when(F.col("_n") <= half, 1).otherwise(2).alias(column))
