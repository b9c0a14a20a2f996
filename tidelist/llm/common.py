"""What the operators share: tables in the cluster's folder, files on it, Arrow helpers."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from pathlib import Path
from tempfile import mkdtemp
from uuid import uuid4
from zipfile import ZipFile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import tidelist
from tidelist.session import shared_folder

# Rows per Arrow batch: texts of 100 KB then make batches of 50 MB.
BATCH_ROWS = 500
PACKAGE = "tidelist.zip"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, as ``--py-files`` would, once per application."""
    context = spark.sparkContext
    if PACKAGE not in context._python_includes:
        root = Path(tidelist.__file__).parent
        packed = Path(mkdtemp(prefix="py-files-")) / PACKAGE
        with ZipFile(packed, "w") as archive:
            for source in sorted(root.rglob("*.py")):
                archive.write(source, Path(root.name) / source.relative_to(root))
        context.addPyFile(str(packed))


def prepare(spark: SparkSession) -> SparkSession:
    """Ship the package; keep Arrow batches of texts small, whatever the length of the texts."""
    ship(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") != str(BATCH_ROWS):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder, reached by every executor."""
    return f"{shared_folder(spark)}/llm-{name}-{uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read again: cuts its lineage."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Remove tables that :func:`written` gave, once whatever was made of them is written itself."""
    for table in tables:
        spark = table.sparkSession
        for folder in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
            if folder.rsplit("/", 1)[1].startswith("llm-"):
                path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(rows: DataFrame, *columns: str) -> DataFrame:
    """Small rows that stand for much work (files, blocks) over about as many tasks as rows.

    The number is given, so adaptive execution does not merge the tasks for the rows' size.
    """
    tasks = min(max(rows.count(), 1), 4096)
    return rows.repartition(tasks, *columns)


def fresh(name: str, columns: list[str]) -> str:
    """The name, with underscores before it as long as a column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def file_system(uri: str):
    """(file system, path) of a URI, for tasks that write or read files themselves."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


def lean(task: Callable) -> Callable:
    """A task over Arrow batches that hands free memory back to the system when it ends.

    Python workers are used again for later tasks, and what they keep counts against their
    executor meanwhile.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
        if trim:
            trim(0)

    return run


def byte_texts(column) -> list[bytes | None]:
    """A string column of an Arrow batch as UTF-8 bytes."""
    return column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()


def batches(rows: dict[str, list], schema: pa.Schema, size: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Columns as record batches of at most ``size`` rows."""
    n = len(next(iter(rows.values())))
    for i in range(0, n, size):
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[f.name][i : i + size], f.type) for f in schema], schema=schema
        )


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers (xorshift-multiply)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))
