"""What jobs need on a cluster: the package on the Python workers, and tables in the folder that all machines share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_sent: set[str] = set()

#: Bytes of an Arrow batch: long texts come in small batches, so a worker's memory follows this and not the rows' number.
BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Add the package's source to the session's Python files, once an application.

    Workers then import it wherever the driver found it; a cluster that has it installed isn't harmed.
    """
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="soundgrid-")) / "soundgrid.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as packed:
        for source in sorted(root.rglob("*.py")):
            packed.write(source, source.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(path))
    _sent.add(app)


def mapped(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with the package at hand in the workers, in batches of ``BATCH_BYTES`` unless the session sets another size."""
    ship(df.sparkSession)
    if df.sparkSession.conf.get(_BATCH_SETTING, None) is None:
        df.sparkSession.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    return df.mapInArrow(function, schema)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, named by ``spark.checkpoint.dir``.

    A local session without the setting (tests, notebooks) gets a temporary folder of its own. A cluster
    without it is an error: a machine's own folder would not be seen by the other machines.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    folder = tempfile.mkdtemp(prefix="soundgrid-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back, which cuts its lineage.

    What is read back does not change when an executor is lost or a task runs twice, so a random or
    order-dependent step that precedes it is decided once.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/soundgrid/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete what ``written`` wrote, once nothing reads it any more: what followed from it must itself be written by then."""
    for table in tables:
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
