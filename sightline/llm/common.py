"""Helpers that the operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship

#: Rows of one Arrow batch; with texts of up to 100 KB each a batch stays near 25 MB.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Send the package to the executors, and hold Arrow batches to `rows` rows, so that long texts fit a worker."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def text_remainder(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo `modulus`; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % modulus


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir.

    Only where that setting is absent and Spark runs in one process is a temporary folder set; on a
    cluster without the setting this raises, as files of one machine would be lost to the others.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir", None)
    if named is None and context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return named or context.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage of `df` with files in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a Parquet table of its own in the shared folder, read again."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def over_batches(df: DataFrame, columns: list[str], function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply `function` to Arrow batches of the named columns only; other columns never leave the JVM."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return df.select(*columns).mapInArrow(run, schema)


def sorted_runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[np.ndarray | pa.Array]]:
    """Split a stream sorted by its first `keys` columns into the runs of equal keys.

    Each run is the list of its columns. One run is held at a time.
    """
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        change = np.zeros(batch.num_rows, dtype=bool)
        for column in columns:
            change[1:] |= column[1:] != column[:-1]
        first = tuple(column[0] for column in columns)
        change[0] = last is not None and first != last
        at = 0
        for cut in np.flatnonzero(change):
            if cut > at:
                held.append(batch.slice(at, cut - at))
            if held:
                yield _joined(held)
                held = []
            at = cut
        held.append(batch.slice(at))
        last = tuple(column[-1] for column in columns)
    if held:
        yield _joined(held)


def _joined(batches: list[pa.RecordBatch]) -> list[pa.Array]:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0].columns


class Labels:
    """Smallest-index labels of the components of 0..n-1 under pairs that arrive in blocks."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        a, b = label[a], label[b]
        while True:
            a, b = label[a], label[b]
            apart = a != b
            if not apart.any():
                break
            a, b = a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            self._flatten()

    def _flatten(self) -> None:
        while not np.array_equal(up := self.label[self.label], self.label):
            self.label[:] = up

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Each index that is not its component's smallest, and that smallest index."""
        below = np.flatnonzero(self.label != np.arange(len(self.label)))
        return below, self.label[below]
