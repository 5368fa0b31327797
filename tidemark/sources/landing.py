"""Tables landed in order of event time, for streams that close their windows on the way.

The files of a table say nothing about the time of their rows, so a stream over them has to
wait for the whole table: its disorder is the time that the table spans. A landed table is
cut into slices of event time, and its files are as old as their slice is early. A file
stream takes the oldest files first, so a row is never more than one slice behind the
newest one before it, whatever the table spans, and windows and timers come out, and leave
the state, while the table is still being read.

Landing is one shuffle by range of (slice, hash of the row): a slice with more rows than a
file should have becomes several files of different tasks, so no task depends on how many
rows share a time. Where the file system does not keep the times it is given, the slices
are appended to a second folder one after the other instead.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from time import time

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.durations import bucket
from tidemark.session import fresh_path

SLICE = "landed_slice"
#: Of rows without a time, which are read first.
TIMELESS = -(2**62)
ROWS_PER_FILE = 5_000_000
#: Milliseconds between the files of one slice and the next.
APART = 1000


@dataclass(frozen=True)
class Landed:
    """A folder of files in order of event time, ``width`` of it in a slice."""

    path: str
    schema: T.StructType
    width: str
    slices: int
    most_files: int

    def stream(self, spark: SparkSession, slices_per_batch: int = 1) -> DataFrame:
        """The rows as a stream, about so many slices in a micro-batch.

        A watermark delay of ``width`` loses no row, however files fall into batches.
        """
        return (
            spark.readStream.schema(self.schema)
            .option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", str(slices_per_batch * self.most_files))
            .parquet(self.path)
        )


def land(df: DataFrame, ts: str, width: str, rows_per_file: int = ROWS_PER_FILE, path: str | None = None) -> Landed:
    """Write ``df`` in slices of ``width`` of the time ``ts`` to a folder of its own."""
    spark = df.sparkSession
    path = path or fresh_path(spark, "landed")
    rows = df.withColumn(SLICE, F.coalesce(bucket(F.col(ts).cast("timestamp"), width), F.lit(TIMELESS)))
    rows.repartitionByRange(SLICE, F.xxhash64(*df.columns)).write.partitionBy(SLICE).option(
        "maxRecordsPerFile", rows_per_file
    ).parquet(path)
    files = _files(spark, path)
    slices = sorted({number for number, _ in files})
    if files and not _date(spark, files, slices):
        path = _appended(spark, path, slices, df.schema)
    return Landed(path, df.schema, width, len(slices), max(Counter(n for n, _ in files).values(), default=1))


def _file_system(spark: SparkSession, path: str):
    """The file system of a folder, and how it calls paths."""
    of = spark._jvm.org.apache.hadoop.fs.Path
    return of(path).getFileSystem(spark._jsc.hadoopConfiguration()), of


def _files(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(slice, file) of every data file below the folder."""
    system, of = _file_system(spark, path)
    found, listing = [], system.listFiles(of(path), True)
    while listing.hasNext():
        file = listing.next().getPath()
        folder = file.getParent().getName()
        if folder.startswith(f"{SLICE}=") and not file.getName().startswith((".", "_")):
            found.append((int(folder.split("=")[1]), file.toString()))
    return found


def _date(spark: SparkSession, files: list[tuple[int, str]], slices: list[int]) -> bool:
    """Make files as old as their slice is early; False where the file system keeps no such times."""
    system, of = _file_system(spark, files[0][1])
    first = int(time()) * 1000 - APART * len(slices)
    at = {number: first + APART * i for i, number in enumerate(slices)}
    for number, file in files:
        system.setTimes(of(file), at[number], -1)
    return all(system.getFileStatus(of(file)).getModificationTime() == at[number] for number, file in files[:1] + files[-1:])


def _appended(spark: SparkSession, path: str, slices: list[int], schema: T.StructType) -> str:
    """The same slices in a folder where they were written one after the other."""
    inbox = fresh_path(spark, "landed")
    for number in slices:
        spark.read.schema(schema).parquet(f"{path}/{SLICE}={number}").write.mode("append").parquet(inbox)
    return inbox
