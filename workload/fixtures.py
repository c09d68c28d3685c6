"""Derived inputs on disk.

The operators start from stored tables and files, so the inputs that Spark
derives from the test tables are written once per session and read by every
query that needs them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duoscope.sources.shared import shared_folder

_PATHS: dict[tuple[str, str, str], str] = {}


def stored_files(spark: SparkSession, sf_dir: str, label: str, write: Callable[[str], None]) -> str:
    """Path of files that ``write`` puts there on first use."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _PATHS:
        path = shared_folder(spark, label)
        write(path)
        _PATHS[key] = path
    return _PATHS[key]


def stored(spark: SparkSession, sf_dir: str, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A derived table as Parquet, built on first use."""
    path = stored_files(spark, sf_dir, label, lambda where: build().write.parquet(where))
    return spark.read.parquet(path)


def write_files(lines: DataFrame, path: str, header: str | None = None, folders: bool = True) -> None:
    """Lines with their file's ``name`` as text, in the folders of ``partitionBy("name")``; rows come by name.

    Each file begins with the ``header``, if one is given. Without ``folders`` the files of a task lie in
    one folder, under their names: whoever lists them need not know as many folders as files.

    Many small files: Spark's writer needs some 10 ms for each on a disk of the machine, where it starts
    a process for every permission, and its driver then moves them one after the other.
    Tasks write them here themselves, a repeated one the same files. Where Arrow does not know the file
    system, Spark's writer does it.
    """
    call = uuid.uuid4().hex
    try:
        FileSystem.from_uri(path)
    except (ValueError, OSError):
        columns = [F.col("value") if header is None else F.col("value").alias(header)]
        writer = lines.select("name", *columns).write.mode("append").partitionBy("name")
        if header is None:
            writer.text(path)
        else:  # whole lines: nothing in them is quoted or escaped
            writer.options(header="true", sep="\x01", quote="", escape="").csv(path)
        return

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        disk, root = FileSystem.from_uri(path)
        part, name, out = TaskContext.get().partitionId(), "", None
        for batch in batches:
            for of, line in zip(*(column.to_pylist() for column in batch.columns)):
                if out is None or of != name:
                    if out is not None:
                        out.close()
                    name, place, piece = of, f"name={of or '__HIVE_DEFAULT_PARTITION__'}", f"part-{part:05d}-{call}"
                    folder, file = (place, f"{piece}.txt") if folders else (piece, place)
                    disk.create_dir(f"{root}/{folder}")
                    out = disk.open_output_stream(f"{root}/{folder}/{file}")
                    if header is not None:
                        out.write(f"{header}\n".encode())
                out.write(f"{line}\n".encode())
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_pylist([], schema=pa.schema([("n", pa.int64())]))

    lines.select("name", "value").mapInArrow(put, "n long").write.format("noop").mode("overwrite").save()
