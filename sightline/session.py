"""What a session needs before Python functions of this package run on executors."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's source to the executors, once for each application.

    The driver serves the archive; nothing is read from a folder that executors would have to share.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    home = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="spark-")) / f"{home.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(home.rglob("*.py")):
            out.write(path, path.relative_to(home.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


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


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a Parquet table of its own in the shared folder, read again."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
