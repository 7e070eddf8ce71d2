"""Tables that cut lineage, in the folder that driver and executors share.

Tables that queries write on their way belong to the job() that is open around them, a folder of its own that goes
with the job; outside any job they belong to the application and go when the process ends. So nothing deletes what
another result still reads.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

#: Folders of the open jobs, the innermost last.
_jobs: ContextVar[tuple[str, ...]] = ContextVar("jobs", default=())
#: The application's own folder, and the shared folder of a local session that names none.
_own: dict[str, str] = {}
_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only a local session may go without the setting; it gets a temporary folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if context.applicationId not in _local:
        _local[context.applicationId] = f"file://{tempfile.mkdtemp(prefix='folioframe-')}"
    return _local[context.applicationId]


def _application_folder(spark: SparkSession) -> str:
    key = spark.sparkContext.applicationId
    if key not in _own:
        _own[key] = f"{shared_dir(spark)}/folioframe/{key}-{uuid.uuid4().hex}"
        atexit.register(_end, key)
    return _own[key]


def _end(key: str) -> None:
    """Delete an application's folder, if it still runs."""
    context = SparkContext._active_spark_context
    if context is not None and context.applicationId == key:
        _delete(context, _own.pop(key))


@contextmanager
def job(spark: SparkSession) -> Iterator[str]:
    """A folder for the tables that are written inside; at the end it is deleted, so results must be stored before, or be
    written with kept=True, which puts them into the folder around this one."""
    folder = f"{_application_folder(spark)}/job-{uuid.uuid4().hex}"
    token = _jobs.set((*_jobs.get(), folder))
    try:
        yield folder
    finally:
        _jobs.reset(token)
        _delete(spark.sparkContext, folder)


def fresh_path(spark: SparkSession, name: str, kept: bool = False) -> str:
    """A new path in the folder of the open job; kept: in the one around it."""
    folders = (_application_folder(spark), *_jobs.get())
    return f"{folders[max(0, len(folders) - 1 - kept)]}/{name}-{uuid.uuid4().hex}"


def written(spark: SparkSession, df: DataFrame, name: str, kept: bool = False) -> DataFrame:
    """df as a table in the shared folder, read back: lineage ends there, and a lost executor loses nothing."""
    path = fresh_path(spark, name, kept)
    df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.written_path = path
    return back


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables of written() that nothing to come reads."""
    for t in tables:
        _delete(spark.sparkContext, t.written_path)


def _delete(context: SparkContext, path: str) -> None:
    at = context._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)
