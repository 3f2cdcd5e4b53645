"""Writers: records, CSV, splits, JSON lines, published versions."""

from __future__ import annotations

import os
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.operators.sampling import order_key

FILE_ROWS = 100_000


def record_name(number: Column) -> Column:
    return F.concat(F.lit("doc_"), number.cast("string"), F.lit(".txt"))


def write_records(df: DataFrame, number: str, text: str, path: str) -> None:
    """Named records as one parquet table; a file per record would not scale."""
    df.select(record_name(F.col(number)).alias("source"), F.col(text).alias("text")).write.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header for texts with quotes, line breaks and outer blanks.

    Such files are read back by one task each, so their row count is bounded.
    """
    writer = df.write.option("header", True).option("quoteAll", True).option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.option("maxRecordsPerFile", FILE_ROWS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Reads what ``write_csv`` wrote. Empty text comes back as null."""
    reader = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"')
    return reader.csv(path)


def write_splits(df: DataFrame, path: str) -> None:
    """One folder per split, so that loading a split reads only its files."""
    df.write.partitionBy("split").parquet(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.json(path)


def write_json_arrays(df: DataFrame, path: str) -> None:
    """One text file per partition with a JSON array of its rows, one per line between the brackets.

    A file is read back by one task, so the caller bounds its rows by the partitions; an empty
    partition gives no array. Rows go out one by one: no array is held.
    """
    lines = df.select(F.to_json(F.struct(*df.columns)).alias("value"))

    def bracket(batches):
        first = True
        for batch in batches:
            values = batch["value"].tolist()
            if values:
                batch = pd.DataFrame({"value": [("[" if first and i == 0 else ",") + v for i, v in enumerate(values)]})
                first = False
                yield batch
        if not first:
            yield pd.DataFrame({"value": ["]"]})

    lines.mapInPandas(bracket, "value string").write.text(path)


def shuffled(df: DataFrame, id_col: str, seed: int, partitions: int | None = None) -> DataFrame:
    """Seeded order for writing.

    The key is a uniform hash, so its leading digits name the partition directly. A range
    sort would run the input twice, once only to sample bounds.
    """
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("_key", order_key(F.col(id_col), seed))
    leading = F.conv(F.substring("_key", 1, 8), 16, 10).cast("double") / F.lit(float(16**8))
    placed = keyed.repartitionById(parts, F.floor(leading * parts).cast("int"))
    return placed.sortWithinPartitions("_key").drop("_key")


def _claim(spark: SparkSession, base: str, version: int, name: str) -> bool:
    """Make the pointer of a version to a folder of files; False if it was there already.

    The pointer comes into being whole and never replaces another: by a link on a file system of
    this machine, elsewhere by a rename, which must not overwrite, as in HDFS.
    """
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{base}/versions")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(folder)
    made = jvm.org.apache.hadoop.fs.Path(folder, f"_{uuid.uuid4().hex}")
    out = fs.create(made, True)
    out.write(bytearray(name.encode()))
    out.close()
    if fs.getUri().getScheme() == "file":
        plain = made.toUri().getPath()
        try:
            os.link(plain, os.path.join(os.path.dirname(plain), str(version)))
            return True
        except FileExistsError:
            return False
    target = jvm.org.apache.hadoop.fs.Path(folder, str(version))
    return not fs.exists(target) and bool(fs.rename(made, target))


def latest_version(spark: SparkSession, base: str) -> int:
    """The highest published version below ``base``, 0 if there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/versions")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return max((int(n) for n in names if n.isdigit()), default=0)


def read_published(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """The rows of a version, by default of the latest."""
    number = latest_version(spark, base) if version is None else version
    pointer = spark.read.text(f"{base}/versions/{number}", wholetext=True).first()["value"]
    return spark.read.parquet(f"{base}/{pointer.strip()}")


def merge(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    """All rows of both; different columns are an error."""
    return new if existing is None else existing.unionByName(new)


def _check_ids(ids: DataFrame, what: str) -> None:
    """An error if an id is null or occurs twice; only ids are read and shuffled."""
    odd = ids.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or id is null").limit(5).collect()
    if odd:
        raise ValueError(f"ids {what} are null or repeat: {[r['id'] for r in odd]}")


def publish(
    df: DataFrame, base: str, id_col: str, merging: bool = False, seed: int = 42, partitions: int | None = None, clash: str = "error"
) -> int:
    """Write the next version and return its number: the new rows or, with ``merging``, old and new ones reshuffled.

    Rows go to a folder of their own; the version exists once its pointer does, which only one of
    several publishers can make. The others go on with the next number, with ``merging`` after
    merging with the version that was first. Old versions stay, and what a crash leaves is never read.

    Ids must be unique and not null. ``clash`` says what happens to an id that the old version has as well:
    ``error`` publishes nothing, ``new`` replaces the old row, ``old`` leaves the new one out.
    ``partitions`` is the number of files of a merged version, which adaptive execution cannot
    change; by default the session's number of shuffle partitions.
    """
    if clash not in ("error", "new", "old"):
        raise ValueError(f"unknown rule {clash}")
    spark = df.sparkSession
    _check_ids(df.select(F.col(id_col).alias("id")), "of the new rows")
    while True:
        version = latest_version(spark, base)
        rows = df
        if merging and version:
            old = read_published(spark, base, version)
            if clash == "error":
                both = old.select(F.col(id_col).alias("id")).unionByName(df.select(F.col(id_col).alias("id")))
                _check_ids(both, "of old and new rows")
                rows = merge(old, df)
            elif clash == "new":
                rows = merge(old.join(df.select(id_col), id_col, "left_anti").select(*old.columns), df)
            else:
                rows = merge(old, df.join(old.select(id_col), id_col, "left_anti").select(*df.columns))
            rows = shuffled(rows, id_col, seed, partitions)
        name = f"files/{uuid.uuid4().hex}"
        rows.write.parquet(f"{base}/{name}")
        claimed = version + 1
        while not _claim(spark, base, claimed, name):
            if merging:
                claimed = 0
                break
            claimed = latest_version(spark, base) + 1
        if claimed:
            return claimed
