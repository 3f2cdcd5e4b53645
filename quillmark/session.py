"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

_made: ContextVar[list[str] | None] = ContextVar("_made", default=None)


def local_session(app: str = "quillmark", cpus: int | None = None) -> SparkSession:
    """Session for tests and benchmarks; a cluster brings its own.

    Its workers run this process's Python unless ``PYSPARK_PYTHON`` names another: PySpark
    itself takes the first ``python3`` of the path, which may be of another version.
    """
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    cpus = cpus or os.cpu_count() or 8
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of the machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not folder:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
            folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        context.setCheckpointDir(folder)
    return (folder or context.getCheckpointDir()).rstrip("/")


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one; never reused. Within ``scratch`` it is dropped at the block's end."""
    path, made = f"{shared_dir(spark)}/quillmark/{label}-{uuid.uuid4().hex}", _made.get()
    if made is not None:
        made.append(path)
    return path


def drop_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder of ``run_dir`` and what is in it; one that was never written is none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Folders that ``run_dir`` names within the block are dropped at its end, also after an error.

    So what is to last is written within the block to a folder named before it. Blocks may be nested; a
    folder belongs to the innermost one. A driver that is killed leaves its folders.
    """
    made: list[str] = []
    outer = _made.set(made)
    try:
        yield
    finally:
        _made.reset(outer)
        for path in made:
            drop_dir(spark, path)
