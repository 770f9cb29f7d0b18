"""Session, table and shared-folder helpers used by every other module."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(app: str = "corpusloom", cores: int | str = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it in ``spark.checkpoint.dir``.

    Where the setting is absent, a local master gets a temporary folder of its own
    (removed when the process ends); any other master is refused, because a
    machine-local folder would lose data with the machine.
    """
    sc = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF)
    if named:
        return named
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="corpusloom-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.conf.set(CHECKPOINT_CONF, f"file://{own}")
    return f"file://{own}"


def stash_path(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_dir(spark), "corpusloom", f"{name}-{uuid.uuid4().hex}")


_stashed: list[tuple[SparkSession, str]] = []


def release() -> None:
    """Remove all that has been stashed so far, where no result that reads it is needed any more.

    An application that runs many queries calls it between them; without it, intermediates
    stay until the application ends.
    """
    for spark, path in _stashed:
        drop_path(spark, path)
    _stashed.clear()


def _clear() -> None:
    """Remove what this application stashed, when it ends."""
    for spark, path in _stashed:
        if path.startswith(("file:", "/")):
            shutil.rmtree(path.removeprefix("file:").replace("//", "/", 1), ignore_errors=True)
        elif SparkSession.getActiveSession() is spark:
            drop_path(spark, path)


atexit.register(_clear)


def temporary_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that is removed when the application ends."""
    path = stash_path(spark, name)
    _stashed.append((spark, path))
    return path


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and gives Catalyst the real
    size of an intermediate, so that it broadcasts only what is below its threshold.
    """
    spark = df.sparkSession
    path = temporary_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a stashed folder, on whatever file system it lies."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _file(spark: SparkSession, path: str):  # noqa: ANN202
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def qualified(spark: SparkSession, path: str) -> str:
    """The full address of a path, with the file system Spark resolves it on."""
    fs, target = _file(spark, path)
    return fs.makeQualified(target).toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder lies at ``path``, on whatever file system."""
    fs, target = _file(spark, path)
    return fs.exists(target)


def file_size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder."""
    fs, target = _file(spark, path)
    return fs.getContentSummary(target).getLength()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file as it is, or None where there is none."""
    fs, target = _file(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file, overwriting ``path``; folders are made."""
    fs, target = _file(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the executors, once per application, so that it need not be installed there."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="corpusloom-zip-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "corpusloom-package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, Path(root.name) / file.relative_to(root))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def load(spark: SparkSession, sf_dir: str, table: str, spread: bool = False) -> DataFrame:
    """A table of the folder.

    ``spread``: for work that is heavy per row. A file of few row groups is read by few tasks;
    where these would leave most cores idle, its rows are dealt out to all of them first.
    Tables with a task for every third core or more, and so all large ones, are left as they are.
    """
    ship(spark)
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    if spread:
        cores = spark.sparkContext.defaultParallelism
        if df._jdf.queryExecution().toRdd().getNumPartitions() * 3 < cores:
            return df.repartition(cores)
    return df
