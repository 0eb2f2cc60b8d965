"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import re
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import granero
from granero.session import scratch_path
from granero.sources.sinks import drop_stored

WORD = re.compile(r"[^\x20\x09-\x0D]+")  # a word is a run of anything but ASCII white space


def put_aside(df: DataFrame, name: str) -> DataFrame:
    """`df` written once as Parquet in the shared folder and read back: lineage is cut, lost executors change nothing."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    _PLACES[stored] = path
    if _WORKSPACES:
        _WORKSPACES[-1].append(stored)
    return stored


_PLACES: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()  # folders of the frames that are put aside
_WORKSPACES: list[list[DataFrame]] = []  # open ones, the innermost last


def release(*stored: DataFrame) -> None:
    """Remove what `put_aside` wrote for these frames, once nothing reads them any more."""
    for df in stored:
        path = _PLACES.pop(df, None)
        if path is not None:
            drop_stored(df.sparkSession, path)


@contextmanager
def workspace() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """What is put aside inside goes when the block ends, but for the frames that the given function was called with.

    A result that is still to be computed may read kept frames only. The driver then collects its garbage, upon which
    Spark removes the shuffle files of the frames that are gone.
    """
    kept: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df)
        return df

    _WORKSPACES.append([])
    try:
        yield keep
    finally:
        held = _WORKSPACES.pop()
        outer = _WORKSPACES[-1] if _WORKSPACES else []
        for df in held:
            if any(df is k for k in kept):
                outer.append(df)
            else:
                release(df)
        if held:
            session = held[0].sparkSession
            del held
            gc.collect()
            session._jvm.System.gc()


def bucket_of(key: Column, buckets: int) -> Column:
    """Even bucket 0..buckets-1 of a key; null keys share one."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}  # by application; each folder goes when the driver ends


def ship_package(spark: SparkSession) -> None:
    """Hand this library to the executors once per application; Spark copies the archive to each of them."""
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    root = Path(granero.__file__).parent
    _SHIPPED[application] = folder = tempfile.TemporaryDirectory(prefix="granero-")
    archive = Path(folder.name, "granero-package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))


def map_arrow(df: DataFrame, task: Callable, schema) -> DataFrame:
    """`mapInArrow` with this library at hand on the executors."""
    ship_package(df.sparkSession)
    return df.mapInArrow(task, schema)
