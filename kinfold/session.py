"""Session settings and the shared scratch area that cuts long lineages."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "kinfold", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Sizing (shuffle partitions, executor memory) is left to the cluster; pass it as ``conf`` with
    dots written as double underscores, e.g. ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may do without it: there a temporary folder is made once and set.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors can reach")
    root = tempfile.mkdtemp(prefix="kinfold-")
    spark.conf.set(CHECKPOINT_KEY, root)
    return root


_made: list[str] = []  # scratch paths of this process, in the order they were named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the scratch root that no other run uses."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def scratch_mark() -> int:
    """A point in time for ``remove_scratch``."""
    return len(_made)


def remove_scratch(spark: SparkSession, since: int, until: int, kept: Sequence[str] = ()) -> None:
    """Delete what was written to scratch paths named between two marks, but not below ``kept``.

    For flows that know that nothing lazy reads those tables any more. Tables that the catalog knows by
    such a path are dropped.
    """
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for i in range(since, until):
        path = _made[i]
        if not path or any(f"{path.removeprefix('file:')}/" in k for k in kept):
            continue
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
        name = path.rsplit("/", 1)[1].rsplit("-", 1)[0]
        if name.startswith("scratch_"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        _made[i] = ""


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the scratch area and read it back.

    Cuts the lineage, survives lost executors, computes the input once (a reliable RDD checkpoint
    computes it twice) and gives later joins the true size of the table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def create_once(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there. Of several callers at most one gets True.

    On local disks the operating system guarantees that, elsewhere the file system's exclusive create
    (HDFS and the object stores that support conditional writes).
    """
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    fs = target.getFileSystem(conf)
    fs.mkdirs(target.getParent())
    if fs.getScheme() == "file":
        try:
            os.close(os.open(target.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY))
        except FileExistsError:
            return False
        return True
    try:
        fs.create(target, False).close()
    except Py4JJavaError as error:
        if fs.exists(target):
            return False
        raise error
    return True


def remove_file(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    target.getFileSystem(conf).delete(target, False)
