"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(app: str = "tidewell", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with adaptive execution on; cluster sizing stays with spark-submit."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # the scores cost more per byte than a scan: let small stages use more than one core
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only where the setting is absent (a bare local session) a temporary folder is made, and it is
    registered with the context so that ``DataFrame.checkpoint`` uses the same place.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if root:
        if current is None:
            spark.sparkContext.setCheckpointDir(root)
        return root.rstrip("/")
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidewell-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def new_workspace(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared root, so that no two runs touch each other's files."""
    return f"{shared_root(spark)}/tidewell/{label}-{uuid.uuid4().hex}"


def at_once(*jobs: Callable[[], object]) -> list:
    """Run jobs that do not need one another side by side, so that small ones do not leave the cluster idle."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [running.result() for running in [pool.submit(job) for job in jobs]]


def ship(spark: SparkSession) -> None:
    """Makes the package importable for the Python workers of a session that was started elsewhere: its source goes to
    the session once, and Spark brings it to each executor."""
    context = spark.sparkContext
    if getattr(context, "_tidewell_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tidewell-code-")) / "tidewell.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._tidewell_shipped = True
