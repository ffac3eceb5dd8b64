"""A fresh folder for tables that a query writes and reads back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: For each application its folder of scratch tables, and where that is local its owner.
_folders: dict[str, str] = {}
_local: list[tempfile.TemporaryDirectory] = []


def shared_base(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder, which goes when Python ends;
    a cluster gets an error, since a folder of one machine cannot be read by the others.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        _local.append(tempfile.TemporaryDirectory(prefix="run-tallyline-"))
        return _local[-1].name
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used, in a folder that is removed when the application ends."""
    application = spark.sparkContext.applicationId
    if application not in _folders:
        folder = f"{shared_base(spark)}/tallyline-{uuid.uuid4().hex}"
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _folders[application] = folder
    return f"{_folders[application]}/{uuid.uuid4().hex}/{name}"
