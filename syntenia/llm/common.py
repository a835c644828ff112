"""Pieces that several training-data operators share."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the contracts define it: space and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir; one of our own where a local session sets none."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir names no shared folder for intermediate tables")
        return "/tmp/checkpoints/syntenia"
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/syntenia-{uuid.uuid4().hex}/{name}"


def hadoop_path(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def drop_path(spark: SparkSession, path: str) -> None:
    p, fs = hadoop_path(spark, path)
    fs.delete(p, True)


class Scratch:
    """Tables written to the shared folder, to cut lineage.

    A lost executor costs a re-read, not a recomputation. Each table is one
    Parquet folder; ``drop`` deletes one that no later plan reads, ``keep`` all
    but those that a result reads.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = scratch_path(spark, "").rstrip("/")
        self._n = 0
        self._tables: list[tuple[DataFrame, str]] = []

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self._n += 1
        path = f"{self.root}/{self._n:03d}-{name}"
        with lean(self.spark):
            df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._tables.append((out, path))
        return out

    def drop(self, df: DataFrame) -> None:
        self.keep(*(t for t, _ in self._tables if t is not df))

    def keep(self, *tables: DataFrame) -> None:
        """Deletes all tables but these, which are all that a result still reads."""
        held = []
        for table, path in self._tables:
            if any(table is t for t in tables):
                held.append((table, path))
            else:
                drop_path(self.spark, path)
        self._tables = held


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def n_words(text: Column) -> Column:
    """Words as runs of anything but ASCII white space; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_interval(*cols: Column) -> Column:
    """A repeatable number in (0, 1) from the values of ``cols``."""
    bits = F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 53))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bytes and rows of an Arrow batch while a scratch table is written.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 4000


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold inside."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def lean(spark: SparkSession):
    """Arrow batches of bounded bytes, and shuffle files that go when their query ends."""
    return settings(
        spark,
        {
            "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES),
            "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
            "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
        },
    )


def few(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """Narrow rows, marked for broadcast only while they are few."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def row_key() -> Column:
    """A hash that names rows by doc_id and text; either may be null."""
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), F.col("doc_id").isNull(), text_or_empty())


#: A key is hot when it holds more than one in this many rows; so there are at most as many hot keys.
HOT_SHARE = 1000


def join_table(rows: DataFrame, weighted: DataFrame, on: list[str], total: int, share: int = HOT_SHARE) -> DataFrame:
    """``rows`` with the columns of ``weighted``, which has one row for each key and counts the rows of it in ``weight``.

    Keys of more than one in ``share`` of ``total`` rows are fewer than ``share``, whatever the
    input's size: these are broadcast. The others are joined by a shuffle that no key can skew.
    """
    heavy = F.col("weight") * share > total
    hot = F.broadcast(weighted.where(heavy))
    return rows.join(hot, on).unionByName(rows.join(hot.select(*on), on, "left_anti").join(weighted.where(~heavy), on))
