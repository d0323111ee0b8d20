"""Session settings the jobs rely on, and the shared folder for cut points."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Stored times carry no zone. They are read as UTC, so that a difference of two
# of them never crosses a daylight-saving jump.
TIME_ZONE = "UTC"


def build_session(app: str = "visitlake", master: str | None = None, **conf) -> SparkSession:
    """A session for scripts and tests; on a cluster the submitter's session is used."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": TIME_ZONE,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
        # no call-site capture per column expression; building a report is twice as fast
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session zone; everything else is left as the submitter set it."""
    if spark.conf.get("spark.sql.session.timeZone") != TIME_ZONE:
        spark.conf.set("spark.sql.session.timeZone", TIME_ZONE)
    return spark


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """A write inside leaves no shuffle files behind.

    Spark else keeps them until the driver collects garbage, so that the disk of a session
    of many writes holds the shuffles of all. The submitter's setting comes back at the end.
    Nothing but a write belongs inside: ``toLocalIterator`` of a frame made here would still
    be reading when its shuffle goes, and in local mode silently miss rows.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers started from now on import this library.

    On a cluster it is installed on the executors or shipped with the job, and a folder
    that they do not have is passed over.
    """
    root = str(Path(__file__).resolve().parent.parent)
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset,
    as in a local test, a fresh folder is made.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    known = spark.sparkContext.getCheckpointDir()
    if known:
        return known
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="visitlake-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable in this session."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new sub-folder name in the shared folder; nothing is created yet."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
