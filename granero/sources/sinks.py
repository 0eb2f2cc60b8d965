"""Writing tables and exports, and the row sets that a load writes beside its table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granero.session import scratch_path

BOM = "﻿"


def balanced(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of a folder together in few, even files; adaptive execution splits the keys that hold very many rows."""
    return df.hint("rebalance", *[F.col(k) for k in keys])


def export_csv(df: DataFrame, path: str, bom: bool = True, mode: str = "errorifexists") -> str:
    """K1: header CSV; with `bom` the first header carries U+FEFF, so spreadsheets read UTF-8."""
    out = df.withColumnRenamed(df.columns[0], BOM + df.columns[0]) if bom else df
    out.write.mode(mode).option("header", True).csv(path)
    return path


def drop_stored(spark: SparkSession, path: str) -> None:
    """Remove a stored table or export; nothing happens when it is not there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stored_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def export_split_by(df: DataFrame, key: Column, path: str, fmt: str = "csv") -> str:
    """K2: one folder per value of `key`, all of them written in one job."""
    (balanced(df.withColumn("particion", key), "particion").write.mode("errorifexists").option("header", True)
     .partitionBy("particion").format(fmt).save(path))
    return path


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """K6: replace the table, or with `partition_by` only the partitions present in `df`.

    Rejecting a bad load before calling this keeps the old rows: Spark commits the new files as a whole.
    """
    if not partition_by:
        df.write.mode("overwrite").parquet(path)
        return
    (balanced(df, *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def replace_partitions(spark: SparkSession, fresh: str, path: str, places: Sequence[str]) -> None:
    """K6 for partitions that lie complete under `fresh`: each takes the place of the one under `path`.

    One that is no longer under `fresh` has taken its place already, so a run that broke off can be taken up.
    """
    make = spark._jvm.org.apache.hadoop.fs.Path
    system = make(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for place in places:
        source, target = make(f"{fresh}/{place}"), make(f"{path}/{place}")
        if not system.exists(source):
            continue
        system.delete(target, True)
        system.mkdirs(target.getParent())
        if not system.rename(source, target):
            raise OSError(f"{source} cannot take the place of {target}")
    spark.catalog.refreshByPath(path)


def upsert(existing: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """K7: rows of `incoming` (one per key) replace those of `existing`."""
    return existing.join(incoming.select(*key), list(key), "left_anti").select(existing.columns).unionByName(incoming)


BUCKET = "cubeta"


def merge_into(incoming: DataFrame, path: str, key: str, buckets: int) -> None:
    """K7 as a job: rows of `incoming` (one per key) replace or join those stored at `path`.

    The table is partitioned by a hash bucket of the key. Only the buckets that the incoming rows touch are read, merged
    and overwritten; the merge is stored beside the table first, since a path that is read cannot be overwritten.
    """
    spark = incoming.sparkSession
    rows = incoming.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    if stored_exists(spark, path):
        touched = [r[0] for r in rows.select(BUCKET).distinct().collect()]  # at most `buckets` numbers
        held = spark.read.parquet(path).filter(F.col(BUCKET).isin(touched))
        staged = scratch_path(spark, "mezcla")
        upsert(held.select(rows.columns), rows, [key]).write.parquet(staged)
        rows = spark.read.parquet(staged)
    overwrite_table(rows, path, [BUCKET])


def new_rows(existing: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """K8: rows of `incoming` whose key is not stored yet; append the result."""
    return incoming.join(existing.select(*key), list(key), "left_anti").select(incoming.columns)


def replace_where(existing: DataFrame, doomed: Column, fresh: DataFrame) -> DataFrame:
    """Drop the rows that match `doomed` (NULL does not match), add the regenerated ones."""
    return existing.filter(~F.coalesce(doomed, F.lit(False))).unionByName(fresh)


def rejects(df: DataFrame, key: str, checks: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """One row per failed check as (tipo, columna, clave, valor, motivo).

    `checks` holds (kind, column name, reason column that is NULL when fine); all are tested in one scan.
    """
    entries = F.array(*[
        F.struct(F.lit(kind).alias("tipo"), F.lit(column).alias("columna"),
                 F.col(column).cast("string").alias("valor"), reason.alias("motivo"))
        for kind, column, reason in checks
    ])
    failed = F.filter(entries, lambda e: e["motivo"].isNotNull())
    return (df.select(F.col(key).cast("string").alias("clave"), F.explode(failed).alias("r"))
            .select("r.tipo", "r.columna", "clave", "r.valor", "r.motivo"))


def load_summary(df: DataFrame, file_col: str, incident: Column) -> DataFrame:
    """Rows, rows with incidents and a flag per source file."""
    return df.groupBy(F.col(file_col).alias("archivo")).agg(
        F.count("*").alias("registros"),
        F.count_if(incident).alias("incidencias"),
        F.bool_or(incident).alias("con_incidencias"),
    )


def duplicate_rows(df: DataFrame, key: str) -> DataFrame:
    """Every row whose key occurs more than once.

    The keys are counted first (combined before the shuffle), then joined back.
    """
    repeated = df.groupBy(key).agg(F.count("*").alias("veces")).filter(F.col("veces") > 1)
    return df.join(repeated.select(key), key, "left_semi").select(df.columns)


def empty_key_rows(df: DataFrame, key: str) -> DataFrame:
    """Rows with a NULL or blank key."""
    return df.filter(F.trim(F.coalesce(F.col(key).cast("string"), F.lit(""))) == "")


def align_to_schema(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """C4: columns of `schema` in its order; missing ones NULL, extra ones dropped. `strict`: a missing one refuses the load."""
    have = set(df.columns)
    if strict and (missing := [f.name for f in schema.fields if f.name not in have]):
        raise ValueError(f"load refused, missing columns {', '.join(missing)}")
    return df.select([
        (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ])
