"""Tables laid out by receipt: joins and one-row-per-receipt steps over them need no shuffle."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from granero.operators.dedupe import first_per_key
from granero.session import scratch_path
from granero.sources.sinks import drop_stored, stored_exists, upsert

RECEIPT = "acuse_estatal"


def _table_name(path: str) -> str:
    """Catalogue name of the table at a place; the catalogue of a session only points there."""
    return f"por_acuse_{hashlib.sha256(path.encode()).hexdigest()[:16]}"


def store_by_receipt(df: DataFrame, path: str, buckets: int, key: str = RECEIPT) -> DataFrame:
    """Write the table in `buckets` files sorted by receipt, over what is there, and read it back.

    Rows are dealt by Spark's own hash first, so each bucket is one sorted file. Tables that meet must have one bucket
    count; choose it so that a bucket fits a task (rows of the largest table / some 128 MB).
    """
    spark, name = df.sparkSession, _table_name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    drop_stored(spark, path)
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet").option("path", path).saveAsTable(name))
    spark.createDataFrame([(buckets, key)], "cubetas int, clave string").coalesce(1).write.mode("overwrite").json(f"{path}.forma")
    return read_by_receipt(spark, path)


def read_by_receipt(spark: SparkSession, path: str) -> DataFrame:
    """The table at `path` with its layout, in this or a later session."""
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        shape = spark.read.schema("cubetas int, clave string").json(f"{path}.forma").first()
        schema = spark.read.parquet(path).schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{shape['clave']}`) SORTED BY (`{shape['clave']}`) "
                  f"INTO {shape['cubetas']} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def merge_by_receipt(incoming: DataFrame, path: str, buckets: int, key: str = RECEIPT) -> DataFrame:
    """K7 on such a table: rows of `incoming` (the first per receipt) replace or join the stored ones.

    Stored and new rows meet bucket by bucket: only the new rows travel. The result is complete beside the table before
    it takes its place, since a table that is read cannot be overwritten.
    """
    spark = incoming.sparkSession
    rows = first_per_key(incoming, [key])
    if stored_exists(spark, path):
        staged = scratch_path(spark, "por-acuse")
        stored = read_by_receipt(spark, path)
        store_by_receipt(upsert(stored, rows.select(stored.columns), [key]), staged, buckets, key)
        rows = read_by_receipt(spark, staged)
    return store_by_receipt(rows, path, buckets, key)
