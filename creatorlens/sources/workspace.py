"""Shared-folder scratch space: where intermediate tables of one run are written.

The folder is the one the cluster names in ``spark.checkpoint.dir``, reachable
from every executor, so a lost executor never loses an intermediate result.
"""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    application = context.applicationId
    if application not in _local_roots:
        _local_roots[application] = tempfile.mkdtemp(prefix="creatorlens-")
        context.setCheckpointDir(_local_roots[application])
    return _local_roots[application]


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/creatorlens/{spark.sparkContext.applicationId}"


_within: contextvars.ContextVar[str] = contextvars.ContextVar("within", default="")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path of this application that nothing was written to before."""
    return f"{_application_folder(spark)}/{_within.get()}{label}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def gathered(spark: SparkSession, label: str) -> Iterator[str]:
    """Fresh folders made meanwhile lie in one folder, which can be discarded as a whole."""
    path = fresh_folder(spark, label)
    token = _within.set(path.removeprefix(_application_folder(spark) + "/") + "/")
    try:
        yield path
    finally:
        _within.reset(token)


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    place, files = _file_system(spark, path)
    return files.exists(place)


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new small file; False, and nothing done, if there is one already."""
    place, files = _file_system(spark, path)
    try:
        out = files.create(place, False)
    except Py4JJavaError as error:
        if files.exists(place):
            return False
        raise error
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def read_file(spark: SparkSession, path: str) -> str:
    place, files = _file_system(spark, path)
    source = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def listed_names(spark: SparkSession, path: str) -> dict[str, float]:
    """Names in a folder with the seconds since 1970 at which they changed; none if it doesn't exist."""
    place, files = _file_system(spark, path)
    if not files.exists(place):
        return {}
    return {f.getPath().getName(): f.getModificationTime() / 1000 for f in files.listStatus(place)}


def remove_folder(spark: SparkSession, path: str) -> None:
    place, files = _file_system(spark, path)
    files.delete(place, True)


def replace_folder(spark: SparkSession, staged: str, path: str) -> None:
    """Rename ``staged`` to ``path``; what was there is kept under another name until then."""
    new, files = _file_system(spark, staged)
    place, _ = _file_system(spark, path)
    old, _ = _file_system(spark, f"{staged}-replaced")
    files.mkdirs(place.getParent())
    had = files.exists(place)
    if had and not files.rename(place, old):
        raise OSError(f"cannot move {path}")
    if not files.rename(new, place):
        if had:
            files.rename(old, place)
        raise OSError(f"cannot publish {path}")
    if had:
        files.delete(old, True)


def discard(spark: SparkSession, path: str | None = None) -> None:
    """Remove one scratch folder of this application, or all of them at the end of a run."""
    own = _application_folder(spark)
    path = path or own
    if path != own and not path.startswith(own + "/"):
        raise ValueError(f"not a scratch folder of this application: {path}")
    place, files = _file_system(spark, path)
    files.delete(place, True)


def read_parquet(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def materialize(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the files."""
    path = fresh_folder(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return read_parquet(df.sparkSession, path, df.schema)
