"""Where jobs may write intermediate tables."""

import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder that every executor can reach.

    The base is the cluster's ``spark.checkpoint.dir``. A session in one process
    (master ``local`` or ``local[...]``) that does not set it uses a folder in its own
    warehouse; anything else without the setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def drop_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate files that nothing reads any more."""
    files, where = _at(spark, path)
    files.delete(where, True)


def put_mark(spark: SparkSession, path: str) -> None:
    """An empty file. Committers may leave out their ``_SUCCESS`` file; a mark of our
    own says that what stands beside it is whole."""
    files, where = _at(spark, path)
    files.create(where, True).close()


def has_path(spark: SparkSession, path: str) -> bool:
    files, where = _at(spark, path)
    return files.exists(where)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Sorted names of the entries of a folder; none when it is not there."""
    files, where = _at(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


def move_into(spark: SparkSession, path: str, folder: str) -> None:
    """Move a file or folder to ``folder``, in place of an entry of the same name. Run
    again after a loss, it goes on: the entry to move is only gone once it has moved."""
    files, where = _at(spark, path)
    _, base = _at(spark, folder)
    target = spark._jvm.org.apache.hadoop.fs.Path(base, where.getName())
    files.mkdirs(base)
    files.delete(target, True)
    if not files.rename(where, target):
        raise OSError(f"cannot move {path} into {folder}")
