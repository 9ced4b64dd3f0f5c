"""Session settings and the shared scratch folder."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app="firnline", master=None, shuffle_partitions=None):
    """A session with the settings the operators rely on; cluster defaults stay untouched."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
    )
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def scratch_dir(spark, name):
    """A fresh folder below the shared folder the cluster names in spark.checkpoint.dir.

    Only a local session may fall back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = _local_base()
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


_MADE, _LOCAL = [], []


def _local_base():
    """One temporary folder per local process, gone when it ends."""
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="firnline-"))
        atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
    return _LOCAL[0]


def clear_scratch(spark):
    """Delete what this process has put into the shared folder; call it when all results are stored."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _MADE:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        path.getFileSystem(conf).delete(path, True)
