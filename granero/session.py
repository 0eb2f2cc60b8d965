"""Session set-up shared by the tests, the benchmark and the daily batch."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "granero", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution on and UTC times; `conf` entries use `__` for `.`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # a checkpoint goes with the last frame that reads it
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_TEST_FOLDERS: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from `spark.checkpoint.dir`.

    Only a local session that names none (tests on one machine) gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if not _TEST_FOLDERS:
            _TEST_FOLDERS.append(tempfile.mkdtemp(prefix="granero-"))
        folder = _TEST_FOLDERS[0]
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the application's own folder in the shared one; nothing is created or removed."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"


def release_scratch(spark: SparkSession) -> None:
    """Remove what this application has put into the shared folder.

    For the owner of the run to call when its results are stored: frames that still read from there are lost.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
