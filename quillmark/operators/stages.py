"""Stages of a job whose output is written, counted while it is written, and resumed after a stop.

A stage is a function of a table and a ``Watch``. What it counts is observed by the job that
writes its rows, so nothing is read again to know how many were kept, failed or unreadable.

With ``parts`` a stage's input is dealt into parts by a hash of the ids, once, and each part's output
is committed on its own: first the rows, then the counts, last the ids it answered. A run that
is stopped leaves committed parts; the next one asks only for ids that no committed part has,
also for those that came to the input in between. What a stop left uncommitted is never read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quillmark.operators.inference import pending
from quillmark.session import run_dir, scratch


class Watch:
    """Counts of one write job."""

    def __init__(self):
        self._seen: list[Observation] = []

    def __call__(self, df: DataFrame, **counts: Column) -> DataFrame:
        """The same rows, counted as they pass by; each count is a sum or a count over them."""
        seen = Observation(uuid.uuid4().hex)
        self._seen.append(seen)
        return df.observe(seen, *[c.alias(name) for name, c in counts.items()])

    def totals(self) -> dict[str, int]:
        """After the write. A sum over no rows is 0."""
        return {name: int(n or 0) for seen in self._seen for name, n in seen.get.items()}


Stage = Callable[[DataFrame, Watch], DataFrame]


@dataclass
class Run:
    """Written rows and what was counted on the way."""

    data: DataFrame
    totals: dict[str, int] = field(default_factory=dict)

    @property
    def counts(self) -> DataFrame:
        """The counts as a table of one row."""
        return self.data.sparkSession.createDataFrame([tuple(self.totals.values())], ", ".join(f"{c} long" for c in self.totals))


def _store(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def committed(spark: SparkSession, path: str) -> list[str]:
    """Names of a stage's committed parts."""
    fs, place = _store(spark, f"{path}/done")
    if not fs.exists(place):
        return []
    folder = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(s.getPath().getName() for s in fs.listStatus(place) if fs.exists(folder(s.getPath(), "_SUCCESS")))


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, place = _store(spark, path)
    out = fs.create(place, True)
    out.write(bytearray(text.encode()))
    out.close()


def _dealt(rows: DataFrame, ids: Sequence[str], parts: int) -> list[DataFrame]:
    """The rows in parts, without empty ones, written once: a part reads its own rows, not the whole input.

    Rows are rebalanced by part, so that each has files of a good size whatever the input's partitions;
    adaptive execution splits a part over tasks.
    """
    spark, path, name = rows.sparkSession, run_dir(rows.sparkSession, "dealt"), "_part"
    while name.lower() in {c.lower() for c in rows.columns}:
        name += "_"
    part = F.pmod(F.xxhash64(*ids), F.lit(parts)).cast("int")
    rows.withColumn(name, part).hint("rebalance", name).write.partitionBy(name).parquet(path)
    fs, _ = _store(spark, path)
    folder = spark._jvm.org.apache.hadoop.fs.Path
    places = [f"{path}/{name}={k}" for k in range(parts)]
    return [spark.read.schema(rows.schema).parquet(p) for p in places if fs.exists(folder(p))]


def staged(rows: DataFrame, ids: Sequence[str], stage: Stage, path: str, parts: int | None = None) -> Run:
    """The stage's output, written below ``path`` and read back, with its counts.

    Without ``parts`` it is one write. With it, rows of one id are answered together; ids need
    not be unique and may be null. Parts run one after the other, each on the whole cluster, so
    they should be large. The input is read once to deal it, into a scratch folder that the run drops at its end; a
    rerun deals what is left. The caller names a new path when the model or its prompts change.
    """
    spark = rows.sparkSession
    if parts is None:
        watch = Watch()
        made = stage(rows, watch)
        made.write.parquet(f"{path}/data")
        return Run(spark.read.schema(made.schema).parquet(f"{path}/data"), watch.totals())
    done = committed(spark, path)
    left = rows
    if done:
        left = pending(rows, spark.read.parquet(*[f"{path}/done/{d}" for d in done]), ids)
    schema = stage(rows, Watch()).schema
    with scratch(spark):
        shares = _dealt(left, ids, parts)
        for share in shares if shares or done else [rows.limit(0)]:
            name, watch = f"part-{uuid.uuid4().hex}", Watch()
            stage(share, watch).write.parquet(f"{path}/data/{name}")
            _write_text(spark, f"{path}/counts/{name}.json", json.dumps(watch.totals()))
            share.select(*ids).write.parquet(f"{path}/done/{name}")
    names = committed(spark, path)
    totals: dict[str, int] = {}
    for line in spark.read.text([f"{path}/counts/{n}.json" for n in names]).collect():  # a line for each part
        for name, n in json.loads(line["value"]).items():
            totals[name] = totals.get(name, 0) + n
    return Run(spark.read.schema(schema).parquet(*[f"{path}/data/{n}" for n in names]), totals)
