"""Path checks and the shared scratch folder, through Spark's file systems."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


#: How files of shifts and payroll are compressed: a quarter smaller than by Spark's default.
CODEC = "zstd"


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, system = _path(spark, path)
    return system.exists(where)


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` ran to its end."""
    return exists(spark, f"{path}/_SUCCESS")


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``."""
    where, system = _path(spark, path)
    if not system.exists(where):
        return []
    return [s.getPath().getName() for s in system.listStatus(where) if s.isDirectory()]


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of all that lies right below ``path``."""
    where, system = _path(spark, path)
    if not system.exists(where):
        return []
    return [s.getPath().getName() for s in system.listStatus(where)]


def changed_at(spark: SparkSession, path: str) -> int:
    """When ``path`` was last written to, in milliseconds."""
    where, system = _path(spark, path)
    return system.getFileStatus(where).getModificationTime()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    where, system = _path(spark, path)
    stream = system.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless there is one; whether this call made it.

    The text is written beside it first. What follows is one step that fails where the file
    exists: a hard link on local disks, else a renaming that overwrites nothing. The file
    system must do that in one step, as HDFS does.
    """
    jvm = spark.sparkContext._jvm
    where, system = _path(spark, path)
    beside = jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{uuid.uuid4().hex}")
    stream = system.create(beside)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if system.getScheme() == "file":
            local = [jvm.java.io.File(p.toUri().getPath()).toPath() for p in (where, beside)]
            jvm.java.nio.file.Files.createLink(*local)
        else:
            _rename_new(spark, beside, where)
        return True
    except Py4JJavaError as problem:
        if "FileAlreadyExistsException" in problem.java_exception.getClass().getName():
            return False
        raise
    finally:
        system.delete(beside, False)


def _rename_new(spark: SparkSession, source, target) -> None:
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs
    options = context._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    system = hadoop.FileContext.getFileContext(target.toUri(), context._jsc.hadoopConfiguration())
    system.rename(source, target, options)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Give a folder another name."""
    where, system = _path(spark, path)
    to, _ = _path(spark, target)
    system.mkdirs(to.getParent())
    if not system.rename(where, to):
        raise OSError(f"{path} was not moved to {target}")


def put_in_place(spark: SparkSession, path: str, target: str) -> None:
    """``path``, finished, instead of the folder ``target``.

    What was there is kept aside until its successor has its name, and comes back if that
    fails. Should the driver die between the two, ``recover`` brings it back.
    """
    recover(spark, target)
    aside = _aside(target)
    if exists(spark, target):
        move(spark, target, aside)
    try:
        move(spark, path, target)
    except (OSError, Py4JJavaError):
        recover(spark, target)
        raise
    remove(spark, aside)


def recover(spark: SparkSession, target: str) -> None:
    """Finish a replacement that broke off: the old folder comes back if no new one came."""
    aside = _aside(target)
    if exists(spark, aside):
        if exists(spark, target):
            remove(spark, aside)
        else:
            move(spark, aside, target)


def _aside(target: str) -> str:
    head, _, name = target.rstrip("/").rpartition("/")
    return f"{head}/_replaced_{name}"


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir.

    Where none is named, a local session uses one below its warehouse folder; on a cluster
    that may be a folder of one machine, so it is refused.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch")
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder name in the scratch folder that nothing else uses."""
    return f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage_in(rows: DataFrame, path: str, codec: str | None = None) -> DataFrame:
    """``rows`` written once to ``path`` and read back."""
    rows.write.parquet(path, compression=codec)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def stage(rows: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``rows`` written once to the scratch folder and read back.

    Later jobs start from the files, so a lost executor does not run the work
    before them again, and each reads only the columns it needs.
    """
    return stage_in(rows, new_folder(rows.sparkSession, name), codec)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a staged folder that nothing reads any more."""
    where, system = _path(spark, path)
    system.delete(where, True)
