"""Session helpers.

The library never builds a session inside an operator; callers pass one in.
``build_session`` is for tests, the bench and local runs. On a cluster the
submitting job owns the session and its configuration, including
``spark.checkpoint.dir`` (a shared folder); ``checkpoint_dir`` only reads it.
"""

from __future__ import annotations

import contextlib
import contextvars
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Settings every run of ours wants, whatever the size of the cluster.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "barwise",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    ``spark.checkpoint.dir`` comes from the cluster. Only where it is unset
    and the master is local (tests) do we make a scratch folder of our own;
    on a cluster a machine-local folder would lose data, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="barwise-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the executors (once per context).

    Functions that run in Python workers are looked up by module name there,
    so the package must be importable on every machine, wherever the job
    was started from.
    """
    sc = spark.sparkContext
    if getattr(sc, "_barwise_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="barwise-src-"), "barwise.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(root):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._barwise_shipped = True


def local_cpus(default: int = 8) -> int:
    return int(os.environ.get("BENCH_CPUS", default))


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    read it back.

    Used where a plan fans out (a table joined back to an aggregate of
    itself): without it each branch would recompute the whole upstream,
    i.e. scan and aggregate the raw input again. The written copy also cuts
    lineage (a lost executor re-reads files instead of recomputing), and
    gives the planner exact sizes for its broadcast decisions.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/barwise/{label}-{uuid.uuid4().hex}"
    own = _SCOPE.get()
    if own is not None:
        own.append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_SCOPE: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("barwise_scope", default=None)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Folders that ``materialize`` writes inside are removed at the end,
    whether the work succeeded or not. For jobs that store their result:
    frames made inside can't be read any more afterwards."""
    own: list[str] = []
    token = _SCOPE.set(own)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for name in own:
            files, path = _files(spark, name)
            files.delete(path, True)


def _files(spark: SparkSession, name: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def path_exists(spark: SparkSession, name: str) -> bool:
    """Whether a file or folder is there, in any store that Spark reads."""
    files, path = _files(spark, name)
    return files.exists(path)
