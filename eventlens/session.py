"""Session settings the plans rely on, and the shared folder for cut lineage."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Only what results or memory safety depend on. Shuffle partition counts belong
# to the cluster, so they are never set here.
REQUIRED = {
    # windows, week starts and ISO text are defined in UTC
    "spark.sql.session.timeZone": "UTC",
}
PREFERRED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
# Keyed streaming state outgrows the heap long before the disk, and state with timers needs it.
STREAMING = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a running session; preferred ones only if unset."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    for key, value in {**PREFERRED, **STREAMING}.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "eventlens", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED, **PREFERRED, **STREAMING, **(conf or {})}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The cluster's reliable folder, from ``spark.checkpoint.dir``.

    Data that must outlive an executor (cut lineage, stream checkpoints, model
    artefacts) goes below it. Only a session that is a single process (``local[...]``) and
    has no such setting gets a temporary folder, one for its lifetime; on a cluster, also one
    of local processes, a missing setting is an error, because a machine-local path would be
    invisible to the other machines. The session's settings are not changed.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if sc.applicationId not in _local:
        _local[sc.applicationId] = tempfile.mkdtemp(prefix="eventlens-")
    return _local[sc.applicationId]


#: Temporary folders of single-process sessions, by application.
_local: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below :func:`shared_dir`, never used before."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it from there.

    Later reads see the same rows whatever happens to an executor, read only the
    columns they need, and the planner knows the size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "cut")
    if _passing():
        _passing()[-1].append((spark, path))
    df.write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found._cut_path = path
    return found


_open = threading.local()


def _passing() -> list[list[tuple[SparkSession, str]]]:
    """The tables of the open :func:`passing_tables` of this thread, the innermost last."""
    if not hasattr(_open, "scopes"):
        _open.scopes = []
    return _open.scopes


@contextmanager
def passing_tables() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete at the end the tables that :func:`cut_lineage` wrote inside, so that steps of a job do
    not add up on disk. Gives ``keep(table)``, which leaves a table to the scope outside, if any.

    Whatever leaves the scope must be such a table, or written: a frame that still has to read one
    of the others would miss it.
    """
    scopes = _passing()
    own: list[tuple[SparkSession, str]] = []
    scopes.append(own)

    def keep(table: DataFrame) -> DataFrame:
        held = [t for t in own if t[1] == getattr(table, "_cut_path", None)]
        for t in held:
            own.remove(t)
            if len(scopes) > 1:
                scopes[-2].append(t)
        return table
    try:
        yield keep
    finally:
        scopes.pop()
        for spark, path in own:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage_in_place(df: DataFrame) -> DataFrame:
    """As :func:`cut_lineage`, but each partition keeps its rows and their order."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def ship_package(spark: SparkSession, archive: str) -> None:
    """Put a zip or wheel of Python code on every worker's path, before user models run."""
    spark.sparkContext.addPyFile(archive)


def ship_archive(spark: SparkSession, archive: str, name: str) -> None:
    """Unpack an archive (a model's files) on every worker under ``name``."""
    spark.sparkContext.addArchive(f"{archive}#{name}")
