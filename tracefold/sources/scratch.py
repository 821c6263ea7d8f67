"""Scratch paths in the folder that a cluster shares."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

_own: dict[str, str] = {}
#: For each passing() that is open in this context, the paths made in it.
_passing: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("passing", default=())


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir or set as checkpoint folder; a temporary one only on a local master, as in tests."""
    sc = spark.sparkContext
    if named := sc.getConf().get("spark.checkpoint.dir"):
        return named.rstrip("/")
    if (given := sc._jsc.sc().getCheckpointDir()).isDefined():
        return given.get().rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and the executors share")
    if sc.applicationId not in _own:
        _own[sc.applicationId] = "file://" + tempfile.mkdtemp(prefix="spark-tracefold-")
    return _own[sc.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the application ends."""
    path = f"{shared_dir(spark)}/tracefold/{name}-{uuid.uuid4().hex[:12]}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    for made in _passing.get()[-1:]:
        made.append(path)
    return path


@contextlib.contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Scratch paths made inside are deleted at its end: what is read later must be written elsewhere by then."""
    made: list[str] = []
    token = _passing.set((*_passing.get(), made))
    try:
        yield
    finally:
        _passing.reset(token)
        for path in made:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
