"""Written intermediate tables: cut lineage and survive the loss of executors.

A frame that is read several times, or whose row positions must not change between two reads, is
written once as Parquet to the shared folder the session names in `spark.checkpoint.dir` and read
back. Reading it back also gives the optimizer real file sizes, so a small table is broadcast by
`spark.sql.autoBroadcastJoinThreshold` and a large one is not.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_written: dict[str, list[str]] = {}  # application id -> folders, in the order they were written
_losses: dict[str, int] = {}  # application id -> how often written tables went
_tried: dict[tuple[str, str], bool] = {}  # application id, folder -> whether executors share it
_lean_write = threading.Lock()


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the session names; without one, or if executors do not share it, a folder in its warehouse."""
    named, warehouse = spark.conf.get(_SETTING, None), spark.conf.get("spark.sql.warehouse.dir")
    folders = [folder.rstrip("/") for folder in (named, f"{warehouse.rstrip('/')}/checkpoints") if folder]
    for folder in folders:
        if _shared(spark, folder):
            return folder
    raise RuntimeError(f"executors do not share {' or '.join(folders)}; {_SETTING} must name a folder that they share")


def _shared(spark: SparkSession, folder: str) -> bool:
    """Whether all machines see one folder there.

    On a cluster, a path on the machine's own file system may be mounted by all machines, or be another folder on
    each: rows are written there by executors and read back, once per application and folder.
    """
    if spark.sparkContext.master.startswith("local") or _place(spark, folder)[0].getUri().getScheme() != "file":
        return True
    key = spark.sparkContext.applicationId, folder
    if key not in _tried:
        rows, path = 4 * spark.sparkContext.defaultParallelism, f"{folder}/tradewinds-{key[0]}/{uuid.uuid4().hex}"
        try:
            spark.range(rows, numPartitions=rows).write.parquet(path)
            _tried[key] = spark.read.schema("id long").parquet(path).count() == rows
            _delete(spark, path)
        except (Py4JJavaError, PySparkException):
            _tried[key] = False
    return _tried[key]


def run_folder(spark: SparkSession) -> str:
    """Where this application writes; `release` drops it."""
    return f"{checkpoint_folder(spark)}/tradewinds-{spark.sparkContext.applicationId}"


def prepare_checkpoints(spark: SparkSession) -> None:
    """Give iterative training a folder to cut its lineage in, unless the session has one."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_folder(spark))


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What runs inside leaves no shuffle files, which else stay until the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def materialise(df: DataFrame, *, lean: bool = False) -> DataFrame:
    """Write the frame once and return a scan of what was written.

    `lean` keeps the disk small: the write's shuffle files go as soon as it ends, the table is packed closer, and
    threads wait for each other, so that the shuffles of one such write at a time lie on the disks.
    """
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{uuid.uuid4().hex}"
    if lean:
        with _lean_write, _shuffles_dropped(spark):
            df.write.option("compression", "zstd").parquet(path)
    else:
        df.write.parquet(path)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def _place(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _delete(spark: SparkSession, folder: str) -> None:
    files, path = _place(spark, folder)
    files.delete(path, True)


def losses(spark: SparkSession) -> int:
    """How often written tables have gone, by `release` or because another emptied the folder between two queries.

    What is kept of a table from before the last loss may no longer be readable.
    """
    application = spark.sparkContext.applicationId
    written = _written.get(application, [])
    there = [folder for folder in written if (place := _place(spark, folder))[0].exists(place[1])]
    if len(there) < len(written):
        written[:] = there
        _losses[application] = _losses.get(application, 0) + 1
    return _losses.get(application, 0)


def discard(df: DataFrame) -> None:
    """Delete the table that `materialise` wrote for this frame, which can then no longer be read."""
    spark = df.sparkSession
    written = _written.get(spark.sparkContext.applicationId, [])
    names = {name.rsplit("/", 2)[-2] for name in df.inputFiles()}
    for path in [p for p in written if p.rsplit("/", 1)[1] in names]:
        _delete(spark, path)
        written.remove(path)


class Scope:
    """Deletes, at its end, the tables written inside it; `keep` those that the result still reads.

        with Scope(spark) as scope:
            narrow = materialise(...)
            result = scope.keep(materialise(f(narrow)))
    """

    def __init__(self, spark: SparkSession):
        self.spark, self._kept = spark, set()

    def __enter__(self) -> Scope:
        self._mine = _written.setdefault(self.spark.sparkContext.applicationId, [])
        self._start = len(self._mine)
        return self

    def keep(self, df: DataFrame) -> DataFrame:
        """The table written last stays, as does what scopes inside this one have kept."""
        self._kept.add(self._mine[-1])
        return df

    def __exit__(self, *failure) -> None:
        for path in self._mine[self._start:]:
            if path not in self._kept:
                _delete(self.spark, path)
        self._mine[self._start:] = [p for p in self._mine[self._start:] if p in self._kept]


def release(spark: SparkSession) -> None:
    """Drop every intermediate table this application has written."""
    application = spark.sparkContext.applicationId
    _delete(spark, run_folder(spark))
    _written.pop(application, None)
    _losses[application] = _losses.get(application, 0) + 1
