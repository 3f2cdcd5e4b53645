"""Folders of files: whole-text scans and sizes."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from urllib.parse import urlparse

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.functions.text import strip
from quillmark.session import run_dir

BYTES_PER_GB, ENTRIES = 1024**3, 100_000


def scan_text_files(
    spark: SparkSession, folder: str, index_pattern: str = r"_(\d+)\.txt$", recursive: bool = False, ordered: bool = True
) -> DataFrame:
    """One row per file: ``file_index, text, source``, in numeric order if ``ordered``.

    The order takes a shuffle of all texts and a second read; inside a pipeline leave it off.
    The index comes out of the file's path; texts are stripped and empty ones left out.
    """
    reader = spark.read.option("recursiveFileLookup", recursive)
    files = reader.text(folder, wholetext=True).select(
        F.regexp_extract(F.col("_metadata.file_path"), index_pattern, 1).try_cast("bigint").alias("file_index"),
        strip(F.col("value")).alias("text"),
        F.col("_metadata.file_name").alias("source"),
    )
    found = files.where(F.col("text") != "")
    return found.orderBy("file_index", "source") if ordered else found


CHECKSUMS = r"^\..*\.crc$"


WALK = "artifact string, path string, n_files long, n_bytes long"


def _walker(leave_out: str | None, entries: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Files and bytes below each folder, and the folders that are left to other tasks.

    Of a folder's tree, so many entries are seen here; the folders not opened by then are rows with
    a ``path``. Links to files or folders are not followed or counted.
    """

    def walk(batches):
        import os
        import re

        for folders in batches:
            for name, path in zip(folders["artifact"], folders["path"]):
                open_, seen, n, size = [path], 0, 0, 0
                while open_ and seen < entries:
                    with os.scandir(open_.pop()) as found:
                        for entry in found:
                            seen += 1
                            if entry.is_symlink():
                                continue
                            if entry.is_dir():
                                open_.append(entry.path)
                            elif not (leave_out and re.search(leave_out, entry.name)):
                                n, size = n + 1, size + entry.stat().st_size
                yield pd.DataFrame([(name, None, n, size)] + [(name, p, 0, 0) for p in open_], columns=["artifact", "path", "n_files", "n_bytes"])

    return walk


def _walked(folders: DataFrame, leave_out: str | None, entries: int) -> DataFrame:
    """``artifact, n_files, n_bytes``, a row for each walk; in rounds, as each deals out the folders the last one left."""
    spark, done = folders.sparkSession, None
    while True:
        path = run_dir(spark, "walk")
        folders.mapInPandas(_walker(leave_out, entries), WALK).write.parquet(path)
        found = spark.read.schema(WALK).parquet(path)
        sums = found.where("path is null").select("artifact", "n_files", "n_bytes")
        done = sums if done is None else done.unionByName(sums)
        left = found.where("path is not null").select("artifact", "path")
        if left.isEmpty():
            return done
        folders = left.repartition("path")


def artifact_sizes(spark: SparkSession, root: str, leave_out: str | None = None, entries: int = ENTRIES) -> DataFrame:
    """Files, bytes and gigabytes of every folder directly below ``root``; a folder without files has 0.

    Only listings are read. The driver lists the folders; what lies below them is walked in
    tasks on a file system: a task opens folders until it has seen ``entries`` files and
    folders, the rest is dealt out again. Other stores, which have no links, are listed by Spark; there, files whose names start with a dot or an underscore are left out. Files whose
    names match ``leave_out`` do not count: ``CHECKSUMS`` are those Spark writes beside its own.
    """
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    folders = [s.getPath() for s in fs.listStatus(path) if s.isDirectory()]
    on_disk = fs.getUri().getScheme() == "file"
    if on_disk:
        import os

        plain = [(f.getName(), f.toUri().getPath()) for f in folders if not os.path.islink(f.toUri().getPath())]
        listed = spark.createDataFrame(plain, "artifact string, path string").repartition(max(len(plain), 1))
        walked = _walked(listed, leave_out, entries)
        sizes = walked.groupBy("artifact").agg(F.sum("n_files").alias("n_files"), F.sum("n_bytes").alias("n_bytes"))
    else:
        listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        base = urlparse(root).path.rstrip("/")
        below: Column = F.regexp_extract("path", f"{re.escape(base)}/([^/]+)/", 1)
        sized = listing.select(below.alias("artifact"), "length").where(F.col("artifact") != "")
        sizes = sized.groupBy("artifact").agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"))
    return sizes.withColumn("gb", F.round(F.col("n_bytes") / F.lit(BYTES_PER_GB), 6))
