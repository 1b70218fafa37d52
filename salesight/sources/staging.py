"""Written intermediate tables in the cluster's shared checkpoint folder.

A staged table cuts lineage: a lost executor costs a re-read of files, not a
re-run of the upstream joins. It also fixes what later passes see, which the
multi-pass operators (global ranks, quantiles, model training) rely on.

Staged tables live as long as the session's JVM, which removes the application's
folder when it ends; ``release`` removes one earlier, ``release_all`` all of them.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple
from urllib.parse import urlparse

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
_marked: set[str] = set()
_mounted: dict[tuple[str, str], bool] = {}

#: Set to true where a ``file:`` folder is mounted on every machine of a cluster, to have
#: it taken without a trial.
SHARED_FILES = "salesight.staging.sharedFiles"
#: Spark's setting that shuffle files of a query are removed when it has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Spark's setting of the folders a task may write to at once before it sorts its rows by folder.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
#: Tasks that write to a ``file:`` folder to try whether all machines share it.
PROBES = 64


class Staged(NamedTuple):
    frame: DataFrame
    path: str


def _file_system(spark: SparkSession, path: str):
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there, there.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _is_local(spark: SparkSession) -> bool:
    return spark.conf.get("spark.master", "").startswith("local")


def _is_one_process(spark: SparkSession) -> bool:
    return _is_local(spark) and not spark.conf.get("spark.master").startswith("local-cluster")


def _shared_folder(spark: SparkSession) -> str | None:
    """The checkpoint folder of the settings or of the context, else the warehouse if executors
    run on their own, which share it too; None if none of them is set."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    context = getattr(spark, "sparkContext", None)
    if not found and context is not None:
        found = context.getCheckpointDir()
    if not found and not _is_one_process(spark):
        found = spark.conf.get("spark.sql.warehouse.dir", None)
    return found


def _is_mounted(spark: SparkSession, folder: str) -> bool:
    """Whether the driver finds in a folder what tasks on all executors have written to it.

    Without a session to try it with, it counts as one machine's.
    """
    if not hasattr(spark, "range"):
        return False
    key = (spark.conf.get("spark.app.id", "app"), folder)
    if key not in _mounted:
        path = f"{folder.rstrip('/')}/salesight-probe-{uuid.uuid4().hex}"
        try:
            spark.range(0, PROBES, 1, PROBES).write.parquet(path)
            _mounted[key] = spark.read.schema("id bigint").parquet(path).count() == PROBES
        except (PySparkException, Py4JError):
            _mounted[key] = False
        release(spark, path)
    return _mounted[key]


def staging_root(spark: SparkSession) -> str:
    """Folder for staged tables: ``spark.checkpoint.dir``, in a subfolder per application.

    Where that is unset, the context's checkpoint folder or else the warehouse is taken, and
    a local-mode session gets a temporary folder of its own. On a cluster all executors must
    share the folder: a missing one is refused, and so is one on a machine's own disk, which
    a trial tells from a disk that every machine mounts.
    """
    app = spark.conf.get("spark.app.id", "app")
    shared = _shared_folder(spark)
    if not _is_local(spark):
        if not shared:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        mounted = spark.conf.get(SHARED_FILES, "false") == "true"
        scheme = urlparse(shared).scheme or _file_system(spark, shared)[1].getScheme()
        if not mounted and scheme == "file" and not _is_mounted(spark, shared):
            raise RuntimeError(
                f"spark.checkpoint.dir {shared} is on one machine's disk; if every machine "
                f"mounts it, set {SHARED_FILES} to true"
            )
    if shared:
        return f"{shared.rstrip('/')}/salesight-{app}"
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="salesight-")
    return _local_roots[app]


def staged_path(spark: SparkSession, name: str) -> str:
    """A new path under the staging root, which goes when the session's JVM ends."""
    root = staging_root(spark)
    if root not in _marked:
        there, files = _file_system(spark, root)
        files.mkdirs(there)
        files.deleteOnExit(there)
        _marked.add(root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def release(spark: SparkSession, path: str) -> None:
    """Remove a staged table; frames that read it must not be used again."""
    there, files = _file_system(spark, path)
    files.delete(there, True)


def release_all(spark: SparkSession) -> None:
    """Remove every table that this application has staged."""
    root = staging_root(spark)
    release(spark, root)
    _marked.discard(root)
    _local_roots.pop(spark.conf.get("spark.app.id", "app"), None)


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Settings of the session for the time of a block."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def stage_by(df: DataFrame, column: str, name: str = "frame") -> Staged:
    """Write ``df`` once, in a folder for each of the few values of a column, so that a reader of
    one value reads no others. The write's shuffle files go at its end."""
    spark, path = df.sparkSession, staged_path(df.sparkSession, name)
    with settings(spark, **{SHUFFLE_CLEANUP: "true", OPEN_FILES: "16"}):
        df.write.partitionBy(column).option("compression", "zstd").parquet(path)
    return Staged(spark.read.schema(df.schema).parquet(path), path)


def stage(df: DataFrame, name: str = "frame") -> Staged:
    """Write ``df`` once as parquet; the frame reads it back."""
    path = staged_path(df.sparkSession, name)
    df.write.parquet(path)
    return Staged(df.sparkSession.read.schema(df.schema).parquet(path), path)


def settle(df: DataFrame | Staged, name: str = "frame") -> Staged:
    """Stage a DataFrame unless it is staged already."""
    return df if isinstance(df, Staged) else stage(df, name)
