"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIR: dict[str, str] = {}
_OWNED: list[list[str]] = []


def local_session(cpus: str | int = "*", name: str = "sitecast") -> SparkSession:
    """A single-machine session for tests and the benchmark.

    A cluster job brings its own session; nothing in the library sets
    configuration on it.
    """
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", os.environ.get("SITECAST_PARTITIONS", "8"))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SITECAST_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local session may go without: it gets one temporary folder of its
    own.  A cluster session that names no folder is an error, because a
    machine-local path would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIR:
        _LOCAL_DIR[app] = tempfile.mkdtemp(prefix="sitecast-")
    return _LOCAL_DIR[app]


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The stored copy fixes values that must not change when a lost executor
    recomputes its part (row ids), and gives Catalyst exact sizes, so a small
    side is broadcast and a large one is not.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/sitecast-{uuid.uuid4().hex}"
    if _OWNED:
        _OWNED[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def stage_tables(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that ``materialize`` stores inside, once the job is done with them.

    For jobs that write their results elsewhere: a DataFrame built on such a table
    cannot be read afterwards.  Without it stage tables stay in the shared folder.
    """
    mine: list[str] = []
    _OWNED.append(mine)
    try:
        yield
    finally:
        _OWNED.pop()
        for path in mine:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
